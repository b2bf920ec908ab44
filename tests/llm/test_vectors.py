"""Hard negatives and whitening against plain numpy on awkward vectors."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import negatives, queries, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, label int, embedding array<float>"


def vectors(n=300, d=12, seed=1):
    """Clusters, copies, ties, nulls, non-finite entries, other lengths and shared ids."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, d))
    rows = [(i, int(rnd.integers(4)), (centres[i % 6] + rnd.normal(size=d) * (0.05 if i % 3 else 1)).tolist()) for i in range(n)]
    hot = rnd.normal(size=d).tolist()
    rows += [(1000 + i, i % 3, hot) for i in range(80)]  # equal vectors, many labels
    rows += [(20, 1, rows[20][2]), (20, 1, rows[20][2]), (20, 2, rows[21][2])]  # repeated and shared ids
    rows += [(None, 1, hot), (2000, None, hot), (2010, 1, None), (2020, 1, [None] + hot[1:]), (2030, 1, [NAN] + hot[1:]),
             (2040, 1, hot[1:] + [INF]), (2050, 1, [0.0] * d), (2060, 1, hot[:3]), (2070, 2, hot[:3]), (2080, 3, hot[:3]), (-40, 1, hot), (2090, 1, [])]
    return rows


def frame(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("id", "tree", "score", "rank", "row_id", "vector", "component", "n") if clashing else ():
        df = df.withColumn(c, F.lit("extra"))
    return df


def fine(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute_negatives(rows, scale, every, n_pos, n_neg, low, high):
    rows = [(i, y, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, y, v in rows if i is not None and y is not None and fine(v)]
    out = []
    for a, (i, y, v) in enumerate(rows):
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), j, z) for b, (j, z, w) in enumerate(rows) if b != a and len(w) == len(v))
        for s, j, z in [x for x in scored if x[2] == y][:n_pos]:
            inside = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s][:n_neg]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside)]
    return Counter(out)


@pytest.mark.parametrize(("shard", "leaf", "at_once"), [(8192, 32, 1 << 15), (64, 4, 7)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, shard, leaf, at_once):
    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "LEAF", leaf)
    monkeypatch.setattr(negatives.cover_tree, "__defaults__", (leaf,))
    rows = vectors()
    got = negatives.hard_negatives(frame(spark, rows, True), every=10, n_negatives=7, anchors_at_once=at_once)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute_negatives(rows, 256, 10, 5, 7, 30, 90)
    assert Counter(map(tuple, got.collect())) == expected and len(expected) > 300


def test_hard_negatives_of_large_entries_and_empty_tables(spark):
    rnd = random.Random(2)
    for size in (40.0, 60_000.0):  # scores beyond exact float32 and float64
        rows = [(i, i % 3, [rnd.uniform(-size, size) for _ in range(8)]) for i in range(60)]
        got = Counter(map(tuple, negatives.hard_negatives(frame(spark, rows), every=4).collect()))
        assert got == brute_negatives(rows, 256, 4, 5, 10, 30, 90)
    assert negatives.hard_negatives(frame(spark, [])).count() == 0
    assert negatives.hard_negatives(frame(spark, [(1, 1, [1.0]), (3, 2, [2.0])])).count() == 0  # no anchor
    with pytest.raises(TypeError, match="integer"):
        negatives.hard_negatives(frame(spark, []).withColumn("label", F.lit("x")))


def test_cover_tree_covers_separates_and_skips():
    rnd = np.random.default_rng(3)
    points = np.floor(256 * np.concatenate([c + 0.02 * rnd.normal(size=(300, 10)) for c in rnd.normal(size=(10, 10))])).astype(np.int32)
    tree = negatives.cover_tree(points, np.arange(len(points)), np.zeros(len(points), np.int64), 8)
    unit = negatives.on_sphere(tree.points)
    assert sorted(tree.ids.tolist()) == list(range(len(points)))

    def below(i):
        if tree.leaf[i]:
            return list(range(tree.first[i], tree.last[i]))
        return [r for c in range(tree.first[i], tree.last[i]) for r in below(c)]

    for i in range(len(tree.leaf)):
        rows = below(i)
        assert tree.centre[i] in rows and negatives.angles(unit[rows], unit[tree.centre[i]]).max() <= tree.radius[i] + 1e-6
        if not tree.leaf[i]:
            centres = tree.centre[tree.first[i]:tree.last[i]]
            assert tree.centre[i] in centres  # nesting
            radius = tree.radius[tree.first[i]:tree.last[i]].max()
            away = np.arccos(np.clip(unit[centres] @ unit[centres].T, -1, 1)) + 9 * np.eye(len(centres))
            assert away.min() >= radius - 3 * negatives.ANGLE  # separation
    # a search opens few of the rows: scored rows are counted through the label look-up
    found, seen = negatives.Found(1, 5), []

    class Counted(np.ndarray):
        def __getitem__(self, rows):
            seen.append(np.size(rows))
            return np.asarray(self)[rows]

    q = tree.points[7:8]
    block = negatives.Anchors(q, np.zeros(1, np.int64), np.array([""], object), np.zeros(1, np.int64), np.array([0, 1]),
                              np.array([negatives.NONE + 1]), np.array([-negatives.NONE - 1]))
    negatives.search(tree._replace(labels=tree.labels.view(Counted)), block, found, True)
    scores = (tree.points.astype(np.int64) @ q[0].astype(np.int64))
    assert sorted(found.scores[0].tolist()) == sorted(scores.tolist())[-5:] and sum(seen) < len(points) / 4


def plain_whitening(x):
    z = x - x.mean(axis=0)
    e, w = np.linalg.eigh(z.T @ z / len(x))
    return z, e[::-1], w[:, ::-1]


def test_whitening_against_plain_numpy(spark):
    rows = [r for r in vectors(d=12) if r[0] != 2060]
    out = whitening.whitened(frame(spark, rows, True), "vec_id", "embedding", scale=1024, shift=100_000, components=8)
    got = out.toPandas()
    kept = [(i, v) for i, _, v in rows if fine(v) and len(v) == 12]
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(float)) + 100_000
    z, e, w = plain_whitening(x)
    assert len(got) == 8 * len(kept) and (got["n"] == len(kept)).all() and got["identity_error"].max() < 1e-9
    for c in range(8):
        own = got[got["component"] == c + 1]
        expected = z @ w[:, c] / np.sqrt(e[c])
        a, b = np.sort(own["whitened"].to_numpy()), np.sort(expected)
        assert min(np.abs(a - b).max(), np.abs(np.sort(-a) - b).max()) < 1e-8
        assert np.allclose(own["explained"], e[c] / e.sum(), rtol=1e-9)
    n, s = len(x), x.sum(axis=0).astype(int).tolist()
    exact = Counter((i, sum((n * int(a) - b) ** 2 for a, b in zip(r, s, strict=True))) for (i, _), r in zip(kept, x, strict=True))
    one = got[got["component"] == 1]
    assert Counter((None if i != i else int(i), int(v)) for i, v in zip(one["vec_id"], one["deviation"], strict=True)) == exact


def test_whitening_of_badly_conditioned_and_dependent_entries(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(400, 5)) * np.array([1e6, 1e4, 1e2, 1.0, 0.05])
    x = np.column_stack([base, base[:, 0] - base[:, 1], np.full(400, 3.0)])  # dependent, constant
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>")
    out = whitening.whitened(df, "vec_id", "v", scale=1 << 10, components=8).toPandas()
    exact = np.floor(x * 1024)
    assert out["component"].max() == 6 and out["identity_error"].max() < 1e-4
    e = plain_whitening(exact)[1]
    assert np.allclose(out.groupby("component")["explained"].first().to_numpy()[:4], (e / e.sum())[:4], rtol=1e-6)


def test_whitening_without_variance(spark):
    same = [(i, 1, [1.0, 2.0]) for i in range(5)]
    for rows in ([], [(1, 1, None)], [(1, 1, [])], [(1, 1, [NAN])], same[:1], same):
        assert whitening.whitened(frame(spark, rows), "vec_id", "embedding").count() == 0
    two = whitening.whitened(frame(spark, [(1, 1, [1.0]), (2, 1, [3.0])]), "vec_id", "embedding").collect()
    assert [abs(r["whitened"]) for r in two] == pytest.approx([1.0, 1.0]) and [r["deviation"] for r in two] == [4, 4]


def test_deviations_of_any_size():
    rnd = random.Random(5)
    for size, n in ((10, 3), (1 << 20, 10 ** 9), (1 << 47, 10 ** 6)):
        x = np.array([[rnd.randint(-size, size) for _ in range(6)] for _ in range(20)], np.int64)
        sums = [rnd.randint(-size * n, size * n) for _ in range(6)]
        centre = whitening.Centre(n, sums)
        expected = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
        assert whitening.deviations(x, centre, centre.whole) == expected


def test_queries(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op13_whitening(spark, sf).toPandas()
    p = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    z, e, w = plain_whitening(np.floor(1024 * np.stack(p["embedding"]).astype(float)) + 100_000)
    got = out.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    expected = z @ w[:, :8] / np.sqrt(e[:8])
    assert np.abs(got * np.sign((got * expected).sum(axis=0)) - expected).max() < 1e-9
    assert out["identity_error"].max() < 1e-9 and dict(queries.op13_whitening(spark, sf).dtypes)["deviation"] == "bigint"
