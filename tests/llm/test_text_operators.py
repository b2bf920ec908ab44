"""Token counts, quality rules, classifier, licences: against the library, brute
force and held-out labels."""

from __future__ import annotations

import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from eventide.llm import classifier, licences, quality, queries, tokens
from tests.llm import cases

SPACE = "[^\x20\x09-\x0d]+"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts_equal_the_library(spark, library):
    out = tokens.token_counts(cases.documents(spark, clashing=True), public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((r["text"] or "", r["n_bytes"], r["n_tokens"]) for r in out.collect())
    expected = sorted((t, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for _, t in cases.texts())
    assert got == expected


def test_token_counts_of_odd_strings(library):
    counter, rnd = tokens.Counter(tokens.Merges(public_tokenizers.path("word_bpe_49k.json"))), random.Random(3)
    alphabet = "abc DEF's't'll 12\n\t é́Σσς\x1c\x85İ€漢🙂<|endoftext|><|startoftext|>ßﬁ½²Ⅷ _-.!'"
    for _ in range(1500):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50)))
        assert counter.tokens(t) == len(library.encode(t, add_special_tokens=False).ids), t


def repeat_words(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {
        w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    return len({i + k for i, w in enumerate(windows) if w in many for k in range(5)})


def test_quality_features(spark):
    got = {(r["doc_id"], r["text"]): r for r in quality.judged(cases.documents(spark, clashing=True)).collect()}
    for i, text, *_ in cases.ROWS:
        r, t = got[i, text], text or ""
        w = re.findall(SPACE, t)
        lines = [x for x in t.split("\n") if re.search(SPACE, x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), repeat_words(w))
        assert r["base_failed"] == (len(w) < 10 or 100 * repeat_words(w) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_window_codes_of_many_words():
    rnd = random.Random(2)
    words = [b"%d" % rnd.randrange(9000) for _ in range(9000)]
    words += words[100:140]
    assert quality.repeated_window_words(words) == repeat_words(words)


def test_rule_order_costs_but_does_not_decide(spark):
    df = cases.documents(spark)
    told = {r["rule"]: r for r in quality.measure(df, quality.RULES, sample_rows=10**6).collect()}
    assert {r.name for r in quality.RULES} == set(told) and told["few_words"]["n"] == len(cases.ROWS)
    rules = quality.ordered(df, sample_rows=10**6)
    rate = [told[r.name]["rejected"] > 0 for r in rules]
    assert rate == sorted(rate, reverse=True)  # rules that reject nothing come last
    for _, t in cases.texts():
        assert quality.accepted(quality.Features(t), rules) == quality.accepted(quality.Features(t), quality.RULES[::-1])


def test_keep_good_keeps_rows_and_columns(spark):
    df = cases.documents(spark, clashing=True)
    good = quality.keep_good(df)
    assert good.columns == df.columns
    ids = {r["doc_id"] for r in good.collect()}
    assert {1, 2, 7, 8} - {7} <= ids and not {4, 5, 6, 10, 11} & ids


def brute_licences(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    found = []
    for t in licences.TEMPLATES:
        k = t.key_words
        for i in range(len(words) - len(k) + 1):
            if words[i:i + len(k)] == k:
                right = sum(0 <= i - t.key_at + j < len(words) and words[i - t.key_at + j] == w for j, w in enumerate(t.words))
                found.append((t, i, right / len(t.words)))
    return words, found


def test_licences_against_brute_force(spark):
    rnd, rows = random.Random(4), list(cases.ROWS)
    pieces = [t.notice for t in licences.TEMPLATES] + [t.key for t in licences.TEMPLATES] + ["under the", "MIT License", "x", "CC-BY", "é"]
    for i in range(60):
        rows.append((500 + i, ", ".join(rnd.choice(pieces).title() for _ in range(rnd.randint(1, 6))), "en", "a"))
    df = cases.documents(spark, rows, clashing=True).withColumn("n", F.lit(0))
    got = sorted((r["text"] or "", r["n_words"], sorted((h["template"], h["start"], round(h["share"], 9)) for h in r["hits"]))
                 for r in licences.licence_scan(df).collect())
    expected = []
    for _, t in cases.texts(rows):
        words, found = brute_licences(t)
        expected.append((t, len(words), sorted((licences.TEMPLATES.index(x), i, round(s, 9)) for x, i, s in found)))
    assert got == sorted(expected)


def test_classifier_learns_from_its_folds_only(spark):
    out = queries.op4_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    m = out.merge(labels, on="doc_id")
    test = m[m.held_out]
    assert (test.predicted == test.quality).mean() >= 0.95
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()


def test_classifier_edge_cases(spark):
    docs = cases.documents(spark, clashing=True)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 120)] + [(1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = classifier.fit(docs, labels)
    first = {(r["doc_id"], r["text"]): r["score"] for r in classifier.scored(docs, model).collect()}
    again = classifier.fit(docs, labels)
    assert (model.gain == again.gain).all() and model.bias == again.bias
    assert first[4, None] == first[5, ""] and all(0 <= s <= 1 for s in first.values())
    none = classifier.fit(docs, labels.limit(0))
    assert not none.gain.any()
    assert classifier.scored(docs.limit(0), none).count() == 0


def test_examples_are_bounded_with_one_hot_id(spark):
    """A sampled id on many rows, of different and of equal texts: no more examples
    than rows, each one of the table's."""
    texts = [(1, f"text {i} of the hot id") for i in range(200)] + [(2, "same words")] * 50 + [(i, f"doc {i}") for i in range(3, 30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, quality int")
    known = {i for i in range(1, 30) if zlib.crc32(str(i).encode()) % 5}
    every = sorted((i, len(classifier.text_features(t))) for i, t in texts if i in known)
    for rows in (10, 100, 10000):
        got = classifier.training_rows(docs, labels, "doc_id", "text", "quality", rows).collect()
        assert len(got) <= rows and {r["id"] for r in got} <= known and all(r["y"] == r["id"] % 2 for r in got)
        again = classifier.training_rows(docs.repartition(7), labels, "doc_id", "text", "quality", rows).collect()
        assert sorted(got) == sorted(again)
    assert sorted((r["id"], len(r["rows"]) // 4) for r in got) == every


def test_score_is_the_mean_of_the_features():
    rnd = __import__("numpy").random.default_rng(1)
    model = classifier.Model(rnd.normal(size=classifier.BUCKETS + 1).astype("float32"), 0.25)
    for _, t in cases.texts():
        f = classifier.text_features(t)
        mean = sum(float(model.gain[k]) * n for k, n in f.items()) / max(1, sum(f.values()))
        assert abs(classifier.Scorer(model).score(t) - 1 / (1 + 2.718281828459045 ** -(mean + 0.25))) < 1e-6


@pytest.mark.parametrize("word", ["x", "word", "a" * 40, "a" * 41, "漢字" * 500])
def test_words_of_any_length_have_ngrams(word):
    n = len(word) + 2
    assert len(classifier.word_features(word)) == 1 + sum(n - k + 1 for k in classifier.NGRAMS if n >= k)


@pytest.mark.parametrize("build", [
    lambda d: tokens.token_counts(d, public_tokenizers.path("word_bpe_49k.json")), quality.judged, quality.keep_good, licences.licence_scan])
def test_empty_tables(spark, build):
    assert build(cases.documents(spark).limit(0)).count() == 0


def test_licence_plan_does_not_grow_with_the_templates(spark):
    """Templates are data: 400 of them give the plan of four, and every one is found."""
    rnd = random.Random(4)
    many = [licences.Template(f"l{i}", f"intro {i} words " + cases.prose(900 + i, 12) + f" clause {i}x of {i * 7} end", f"clause {i}x of {i * 7}") for i in range(400)]
    rows = [(i, "noise " * rnd.randint(0, 5) + t.notice.upper() + " tail", None, None) for i, t in enumerate(many)]
    df = cases.documents(spark, rows).select("doc_id", "text")
    few, all_ = licences.licence_scan(df, many[:4]), licences.licence_scan(df, many)
    nodes = [d._jdf.queryExecution().analyzed().toString().count("\n") for d in (few, all_)]
    calls = [d._jdf.queryExecution().analyzed().toString().count("lambdafunction") for d in (few, all_)]
    assert nodes[0] == nodes[1] and calls[0] == calls[1]
    for r in all_.collect():
        assert [(h["template"], h["share"]) for h in r["hits"]] == [(r["doc_id"], 1.0)]
    assert licences.licence_scan(df, []).where("size(hits) > 0").count() == 0


def test_licence_templates_are_whole_notices():
    labels = {t.label for t in licences.TEMPLATES}
    assert len(labels) >= 30 and sum(len(t.words) >= 12 for t in licences.TEMPLATES) >= 25
    assert [t.label for t in licences.TEMPLATES if t.base] == ["mit", "apache-2", "cc-by-nc"]
    assert all(t.words[t.key_at:t.key_at + len(t.key_words)] == t.key_words for t in licences.TEMPLATES)


def plain_train(examples, seed=classifier.SEED):
    """The classifier's steps, one example and one weight at a time."""
    import math

    import numpy as np

    rng, d = np.random.default_rng(seed), classifier.DIMENSIONS
    labels = [y for *_, y in examples]
    share = (sum(labels) + 1) / (len(labels) + 2)
    vectors = rng.uniform(-1, 1, (d, classifier.BUCKETS + 1)) / d
    out, bias = [[0.0, 0.0] for _ in range(d)], [0.0, math.log(share / (1 - share))]
    epochs, done = max(classifier.EPOCHS, math.ceil(classifier.STEPS / len(examples))), 0
    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for s in range(0, len(order), classifier.BATCH):
            batch = [examples[i] for i in order[s:s + classifier.BATCH]]
            rate = classifier.RATE * max(0.02, 1 - done / (epochs * len(examples))) / len(batch)
            step_out, step_bias, step_rows = [[0.0, 0.0] for _ in range(d)], [0.0, 0.0], {}
            for rows, counts, y in batch:
                mean = [sum(c * vectors[k, r] for r, c in zip(rows, counts, strict=True)) / sum(counts) for k in range(d)]
                logits = [sum(mean[k] * out[k][j] for k in range(d)) + bias[j] for j in (0, 1)]
                e = [math.exp(x - max(logits)) for x in logits]
                error = [e[j] / sum(e) - (j == y) for j in (0, 1)]
                for k in range(d):
                    back = error[0] * out[k][0] + error[1] * out[k][1]
                    for j in (0, 1):
                        step_out[k][j] += mean[k] * error[j]
                    for r, c in zip(rows, counts, strict=True):
                        step_rows[k, r] = step_rows.get((k, r), 0.0) + c / sum(counts) * back
                step_bias = [step_bias[j] + 0.1 * error[j] for j in (0, 1)]
            for k in range(d):
                out[k] = [out[k][j] - rate * step_out[k][j] for j in (0, 1)]
            bias = [bias[j] - rate * step_bias[j] for j in (0, 1)]
            for (k, r), g in step_rows.items():
                vectors[k, r] -= rate * g
            done += len(batch)
    return (np.array(out)[:, 1] - np.array(out)[:, 0]) @ vectors, bias[1] - bias[0]


def test_training_against_a_plain_loop(monkeypatch):
    import numpy as np

    monkeypatch.setattr(classifier, "STEPS", 200)
    rng = np.random.default_rng(3)
    examples = [(rng.choice(500, 6, replace=False).astype("i4"), rng.integers(1, 4, 6).astype(float), i % 2) for i in range(40)]
    model, (gain, bias) = classifier.train(examples), plain_train(examples)
    assert np.abs(model.gain - gain).max() < 1e-5 and abs(model.bias - bias) < 1e-9


def test_held_out_labels_do_not_matter_and_examples_are_bounded_in_bytes(spark, monkeypatch):
    import numpy as np

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    flipped = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = classifier.fit(docs, labels), classifier.fit(docs, flipped)
    assert np.array_equal(a.gain, b.gain) and a.bias == b.bias
    seen, train = [], classifier.train
    monkeypatch.setattr(classifier, "train", lambda examples, *more: seen.append(sum(r.nbytes + 4 * len(c) for r, c, _ in examples)) or train(examples, *more))
    monkeypatch.setattr(classifier, "TRAIN_BYTES", 50_000)
    classifier.fit(docs, labels)
    assert 0 < seen[0] <= 50_000
