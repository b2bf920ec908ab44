"""One query per operator over its whole table, with production parameters, and
DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (
    classifier, decontam, html_text, licences, mixing, negatives, pii, quality, repeats, simhash, tokens, urls, whitening,
)
from eventide.llm.common import table

TOKEN_LIMIT = 2048


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs).drop("text")


#: The rules and their verdicts.
URL_RULES = [urls.Rule.parse(rule, verdict) for rule, verdict in (
    ("com/", urls.ALLOW), ("example.com/en/", urls.BLOCK), ("www.example.com/en/", urls.ALLOW),
    ("net/es/", urls.BLOCK), ("net/fr/", urls.BLOCK))]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.url_verdicts(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return classifier.scored(docs, model).select(
        "doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = licences.licence_scan(docs).drop("text")
    base = F.transform(F.filter("hits", lambda h: h["template"].isin(licences.base_numbers())), lambda h: h["start"])
    out = scanned.withColumn("base", base)
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"), F.array_max("base").cast("long").alias("last_word"),
        licences.labels_of(F.col("hits"), base_only=True).alias("base_labels"),
        licences.labels_of(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0)).alias("score"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_text.extracted(pages).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.leaks(docs, table(spark, sf_dir, "benchmark")).drop(decontam.TEXT_HASH)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.sampled(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.repeat_report(docs)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), name="spans")
    base = pii.of_kinds(F.col("spans"), pii.BASE)
    return found.select(
        "doc_id", *[F.size(pii.of_kinds(F.col("spans"), (k,))).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = negatives.hard_negatives(rows.withColumn("label", label), scale=256, every=100, n_positives=5, n_negatives=10, low=30, high=90)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", scale=1024, shift=100_000, components=8)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filters": op3_url_filters,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_license_scans": op5_license_scans,
    "op6_html_extraction": op6_html_extraction,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_mixing": op8_mixing,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_pii": op11_pii,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

#: The verdict does not depend on the order of the rules, so SQL needs none.
OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
wins AS (
  SELECT rid, i, array_to_string(list_slice(w, i, i + 4), ' ') AS win
  FROM d, unnest(generate_series(1, len(w) - 4)) AS u(i)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM wins) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, unnest(generate_series(0, 4)) AS u(k) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM d, unnest(string_split(t, chr(10))) AS u(line) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
f AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(lines.n, 0) AS n_lines,
         length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^a-z]+', '', 'g')) AS n_lower
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR n_upper > n_lower
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""

OP3_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

#: Index words only find the places of key phrases faster: SQL tries all places of their first words.
OP5_SQL = r"""
WITH t(label, notice, k, ofs, base) AS (VALUES
""" + ",\n".join(
    f"  ('{t.label}', string_split('{" ".join(t.words)}', ' '), string_split('{" ".join(t.key_words)}', ' '), {t.key_at}, {t.base})"
    for t in licences.TEMPLATES) + r"""),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (SELECT rid, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
c AS (SELECT rid, i, label, notice, k, ofs, base FROM p JOIN t ON p.word = t.k[1]),
s AS (SELECT c.*, d.w FROM c JOIN d USING (rid) WHERE list_slice(d.w, c.i + 1, c.i + len(c.k)) = c.k),
hits AS (
  SELECT rid, label, base, i, len(list_filter(range(0, len(notice)), lambda j: i - ofs + j >= 0
           AND coalesce(w[i - ofs + j + 1] = notice[j + 1], false))) / CAST(len(notice) AS DOUBLE) AS share
  FROM s),
a AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN a USING (rid)
"""

OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
g AS (SELECT *, CAST(floor(log2(size + 1.0::DOUBLE) * 4) AS BIGINT) AS class,
             ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)), 1, 8))::BIGINT
               % (SELECT greatest(1, CAST(ceil(count(*) / {mixing.SLICE_ROWS}.0) AS BIGINT)) FROM documents) AS slice FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, source_size * 3.0::DOUBLE AS stop,
         ([5.0::DOUBLE, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM s),
f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(stop) OVER o, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS fill
  FROM w WINDOW o AS (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(stop, coalesce(level * weight, stop)) AS target
  FROM (SELECT *, max(fill) FILTER (fill * weight <= stop) OVER () AS level FROM f)),
r AS (
  SELECT g.*, row_number() OVER (PARTITION BY source ORDER BY class, slice, size, doc_id NULLS FIRST) AS rank,
         coalesce(('0x' || substr(md5(coalesce('{mixing.SEED}:s' || source, '{mixing.SEED}:null')), 1, 8))::BIGINT, 0)
           / 4294967296.0::DOUBLE AS u
  FROM g),
c AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, u, rank,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(rate * rank + u) - floor(rate * (rank - 1) + u) AS BIGINT) * size AS taken
FROM c
"""

#: Every anchor against every row; inner products of integers this small are exact.
OP12_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid, a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.rid <> b.rid),
p AS (
  SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place
  FROM s WHERE label = own QUALIFY place <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.rid = p.rid AND s.label <> s.own
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": OP2_SQL,
    "op3_url_filters": OP3_SQL,
    "op5_license_scans": OP5_SQL,
    "op8_mixing": OP8_SQL,
    "op12_hard_negatives": OP12_SQL,
}
