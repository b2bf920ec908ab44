"""Near copies, repeated substrings and benchmark leaks against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import components, decontam, repeats, simhash
from tests.llm import cases

SPACE = "[^\x20\x09-\x0d]+"


def brute_print(text):
    words = re.findall(SPACE, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(values, radius):
    """Smallest index reachable from each."""
    name = list(range(len(values)))
    for i, a in enumerate(values):
        for j, b in enumerate(values):
            if (a ^ b).bit_count() <= radius and name[i] != name[j]:
                low, high = sorted((name[i], name[j]))
                name = [low if n == high else n for n in name]
    return name


def test_fingerprints():
    for _, t in cases.texts():
        assert simhash.fingerprint(t) & (1 << 64) - 1 == brute_print(t)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_find_all_components(spark, radius):
    rnd = random.Random(radius)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        v = rnd.getrandbits(64)
        for _ in range(12):
            values.add(v)
            for _ in range(rnd.randint(1, radius + 2)):
                v ^= 1 << rnd.randrange(64)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64 if v >> 63 else 0),) for v in values], "fp long")
    roots = {r["node"]: r["root"] for r in components.smallest_reachable(simhash.links(df, radius)).collect()}
    got = {}
    for v in values:
        s = v - (1 << 64 if v >> 63 else 0)
        got.setdefault(roots.get(s, s), set()).add(v)
    expected = {}
    for v, n in zip(values, groups(values, radius), strict=True):
        expected.setdefault(n, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_shards_that_go_on_over_many_batches(spark):
    """Arrow batches far smaller than a shard, and shards that end with a batch."""
    rnd = random.Random(4)
    near = [rnd.getrandbits(24) for _ in range(300)]  # the upper blocks are equal: one hot shard
    df = spark.createDataFrame([(v,) for v in sorted({*near, *[v ^ 1 for v in near[:50]], *[rnd.getrandbits(62) for _ in range(100)]})], "fp long")
    whole = {tuple(r) for r in simhash.links(df, 2).collect()}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    try:
        for n in (1, 7):
            spark.conf.set(size, n)
            assert {tuple(r) for r in simhash.links(df, 2).collect()} == whole and len(whole) >= 50
    finally:
        spark.conf.set(size, old)


def test_bk_tree_finds_all_within():
    rnd, tree = random.Random(1), simhash.BKTree()
    values = [rnd.getrandbits(10) for _ in range(300)]
    for v in values:
        tree.add(v)
    for q in range(0, 1024, 7):
        assert sorted(tree.values[i] for i in tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_near_duplicates_against_brute_force(spark):
    rnd, rows = random.Random(5), list(cases.ROWS)
    for i in range(40):
        words = cases.prose(rnd.randrange(6), 200).split()
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(200)] = "edit"
        rows.append((1000 - i, " ".join(words), "en", "a"))
    got = sorted((str(r["doc_id"]), r["fp"], str(r["component_id"]))
                 for r in simhash.near_duplicates(cases.documents(spark, rows, clashing=True)).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [brute_print(r[1] or "") for r in order]
    names = groups(prints, 2)
    expected = sorted((str(r[0]), f - (1 << 64 if f >> 63 else 0), str(order[n][0])) for r, f, n in zip(order, prints, names, strict=True))
    assert got == expected
    kept = simhash.one_of_each(cases.documents(spark, rows, clashing=True))
    assert kept.columns == cases.documents(spark, rows, clashing=True).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(order[n][0]) for n in set(names))


def brute_repeats(rows, length):
    first = {}
    for i, t in sorted(((i, (t or "").encode()) for i, t, *_ in rows if i is not None), key=lambda x: x[0]):
        for s in range(len(t) - length + 1):
            first[t[s:s + length]] = min(first.get(t[s:s + length], (i, s)), (i, s))
    out = []
    for i, t, *_ in rows:
        t = (t or "").encode()
        keep = np.ones(len(t), bool)
        for s in range(len(t) - length + 1 if i is not None else 0):
            if first[t[s:s + length]] != (i, s):
                keep[s:s + length] = False
        kept = np.frombuffer(t, np.uint8)[keep].tobytes()
        runs = int(np.count_nonzero(np.diff(np.append(True, keep).astype(np.int8)) < 0))
        out.append((i, len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [279, 280, 300, 600])
def test_repeats_of_long_strings(spark, length):
    """Fragments of more than 255 starts: the gram of smallest hash in the middle of a
    passage is that of all strings around it."""
    rnd, rows = random.Random(length), []
    shared = [cases.prose(i, 400) for i in range(4)]
    for i in range(40):
        x = rnd.choice(shared)
        at = rnd.randrange(len(x) // 2)
        rows.append((i, cases.prose(100 + i, rnd.randint(1, 60)) + x[at:at + rnd.randint(length - 5, 3 * length)] + cases.prose(200 + i, 30), "en", "a"))
    got = repeats.repeat_report(cases.documents(spark, rows), length=length).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows, length)
    with pytest.raises(ValueError, match="length must be below"):
        repeats.repeated_spans(cases.documents(spark, rows), "doc_id", "text", 1 << 20)


@pytest.mark.parametrize("hot", [0, 3, repeats.HOT_FRAGMENTS])
def test_repeats_against_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 3000)
    monkeypatch.setattr(repeats, "TRANSFORM", 5000)
    monkeypatch.setattr(repeats, "CHUNK", 200)
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    whole = repeats.repeated_spans
    monkeypatch.setattr(repeats, "repeated_spans", lambda *a: whole(*a, hot=hot))
    rnd, rows = random.Random(6), list(cases.ROWS)
    base = [cases.prose(i, 60) + " é漢🙂" * (i % 3) for i in range(8)]
    for i in range(40):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            b = rnd.choice(base)
            a = rnd.randint(0, len(b))
            parts.append(b[a:rnd.randint(a, len(b))] if rnd.random() < 0.6 else b)
        # every third id is shared by different texts
        rows.append((2000 - (i if i % 3 else 3), rnd.choice([" ", "", "-"]).join(parts), "en", "a"))
    df = cases.documents(spark, rows, clashing=True)
    got = sorted((tuple(r) for r in repeats.repeat_report(df).collect()), key=str)
    assert got == brute_repeats(rows, repeats.LENGTH)


def test_rows_that_share_an_id_keep_their_own_text(spark):
    a, b = cases.prose(70, 40), cases.prose(71, 40)
    df = cases.documents(spark, [(1, a, "en", "a"), (2, a, "en", "a"), (2, b, "en", "a"), (2, b, "en", "a")])
    kept = sorted((r["doc_id"], r["text"]) for r in repeats.without_repeats(df).collect())
    assert kept == sorted([(1, a), (2, ""), (2, b), (2, b)])
    with pytest.raises(TypeError, match="integer"):
        repeats.repeat_report(df.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_a_line_in_a_third_of_all_documents(spark):
    """Its gram is hot: no task meets all of its fragments, and nothing else changes."""
    line, rows = "this very line of some seventy bytes stands in very many documents", []
    for i in range(20_000):
        own = cases.prose(1000 + i, 24)
        rows.append((i, f"{own}\n{line}\n{cases.prose(50_000 + i, 12)}" if i % 3 == 0 else own, "en", "a"))
    rows.append((30_000, "x " + rows[0][1][40:] + " " + rows[3][1][:150], "en", "a"))
    df = cases.documents(spark, rows)
    found = repeats.hot_grams(repeats.versioned(df, "doc_id", "text"), repeats.LENGTH, repeats.HOT_FRAGMENTS)
    assert 0 < len(found) < 200
    shuffled = repeats.versioned(df, "doc_id", "text").mapInArrow(lambda b: repeats.fragment_rows(b, repeats.LENGTH, found), repeats.ROWS)
    assert shuffled.where(F.col("at") % repeats.COUNT > 0).groupBy("gram").agg(F.count_distinct("content").alias("n")).agg(F.max("n")).first()[0] < 3000
    got = sorted((tuple(r) for r in repeats.repeat_report(df).collect()), key=str)
    assert got == brute_repeats(rows, repeats.LENGTH)


def test_transform_finds_every_class_of_equal_strings():
    rnd = random.Random(3)
    for length in (24, 31, 64):
        for alphabet in ("a", "ab", "abcdefgh"):
            cut = [bytes(rnd.choice(alphabet.encode()) for _ in range(rnd.randint(length, 3 * length))) for _ in range(12)]
            cut += [c[:length + 3] + b"zz" for c in cut[:5]]
            doc, start = np.arange(len(cut))[::-1].copy(), np.full(len(cut), 7)
            got = sorted((d, s) for d, _, s in zip(*(x.tolist() for x in repeats.later_strings(doc, doc, start, cut, length)), strict=True))
            first, every = {}, []
            for d, c in sorted(zip(doc.tolist(), cut, strict=True)):
                for s in range(len(c) - length + 1):
                    if first.setdefault(c[s:s + length], (d, s)) != (d, s):
                        every.append((d, s + 7))
            assert got == sorted(every)


def test_without_repeats(spark):
    passage = cases.prose(50, 70)
    rows = [(1, "héad " + passage, "en", "a"), (2, "x " + passage + " y", "en", "a"), (3, None, "en", "a"), (3, None, "en", "a"), (None, passage, "en", "a"),
            (4, "é" * 200, "en", "a"), (5, "aé" + "é" * 198, "en", "b")]
    df = cases.documents(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    got = {(r["doc_id"], r["source"]): r for r in repeats.without_repeats(df).collect()}
    assert got[2, "a"]["text"] in ("x  y", "x y") and got[2, "a"]["n_chars"] == len(got[2, "a"]["text"])
    assert got[1, "a"]["text"] == "héad " + passage and got[3, "a"]["text"] is None
    assert got[None, "a"]["text"] == passage
    assert set(got[4, "a"]["text"]) == {"é"} and got[5, "b"]["text"].encode()


def brute_leaks(rows, items):
    def words(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())

    def shingles(w):
        return [" ".join(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) > 5 else [" ".join(w)]

    def alike(a, b):
        common = sum(min(a.count(s), b.count(s)) for s in set(a))
        return common / (len(a) + len(b) - common)

    best = {}
    for i, t, *_ in rows:
        w = words(t)
        for j, it in items:
            v = words(it)
            if not v or not w:
                continue
            sim, start = max(((alike(shingles(w[s:s + len(v)]), shingles(v)), -s) for s in range(max(1, len(w) - len(v) + 1))), default=(0, 0))
            if sim >= 0.8:
                best[i, j] = max(best.get((i, j), (0, 0)), (round(sim, 9), start))
    return best


def test_leaks_against_brute_force(spark):
    rnd = random.Random(8)
    items = [(j, cases.prose(300 + j, rnd.randint(14, 70))) for j in range(12)] + [(50, None), (51, ""), (52, "light quiet"), (0, cases.prose(300, 0))]
    rows = [r for r in cases.ROWS if r[0] != 7]
    for i in range(40):
        words = rnd.choice(items[:12])[1].split()
        for _ in range(rnd.choice([0, 0, 1, 2, 8])):
            words[rnd.randrange(len(words))] = "changed"
        cut = rnd.choice([0, 0, 2, 4])
        body = (" ".join(words[cut:])).upper() if rnd.random() < 0.3 else ", ".join(words[cut:])
        if i % 8 == 0:  # halves that have changed places
            words = words[len(words) // 2:] + words[:len(words) // 2]
        rows.append((3000 + i, rnd.choice(["", cases.prose(i, 30) + "\n"]) + body + rnd.choice(["", " " + cases.prose(i + 99, 20)]), "en", "a"))
    docs = cases.documents(spark, rows, clashing=True).withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_leaks(rows, items)
    for options in ({}, {"broadcast_bytes": 0}):  # the best of all item-sized windows, broadcast or shuffled
        got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), -r["start"]) for r in decontam.leaks(docs, bench, **options).collect()}
        assert got == expected
    clean = decontam.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r[0]) for r in rows if not any(k[0] == r[0] for k in expected))


def test_multi_index_loses_no_pair_within_the_radius(spark):
    rnd = random.Random(9)
    pairs = []
    for _ in range(400):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, decontam.RADIUS)):
            b ^= 1 << bit
        pairs.append(tuple(v - (1 << 64 if v >> 63 else 0) for v in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    shared = F.arrays_overlap(decontam.blocks(F.col("a")), decontam.blocks(F.col("b")))
    assert df.where(~shared).count() == 0


def test_empty_tables(spark):
    none = cases.documents(spark).limit(0)
    bench = spark.createDataFrame([(1, cases.COPY)], "item_id long, text string")
    for out in (simhash.near_duplicates(none), simhash.one_of_each(none), repeats.repeat_report(none), repeats.without_repeats(none),
                decontam.leaks(none, bench), decontam.without_leaks(none, bench), decontam.leaks(cases.documents(spark), bench.limit(0))):
        assert out.count() == 0
    assert decontam.without_leaks(cases.documents(spark), bench.limit(0)).count() == len(cases.ROWS)
