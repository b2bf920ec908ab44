"""Rolling state on streams with hot keys: any split into micro-batches gives the batch result."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import scan
from eventide.plans import catalog
from eventide.schema import EVENTS_TABLE_TYPES, Kinds
from eventide.streaming import carry
from eventide.streaming import rolling as sroll
from tests.conftest import SF0001

K = Kinds.events_table()


@pytest.fixture(scope="module")
def events(spark):
    return catalog._ev(spark, SF0001).select("seq", "user_id", "event_type").cache()


def _parts(events, seed, n=3):
    """Contiguous ranges of seq, some of them empty: arrival order is the order of seq."""
    rnd = random.Random(seed)
    top = events.agg(F.max("seq")).first()[0]
    cuts = sorted([0, top + 1, *(rnd.randint(0, top) for _ in range(n - 1))])
    cuts.insert(2, cuts[2])  # an empty micro-batch
    return [events.where((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def _feed(fn, parts, replayed=()):
    for i, p in enumerate(parts):
        fn(p, i)
        if i in replayed:
            fn(p, i)  # a repeated micro-batch changes nothing


@pytest.mark.parametrize(("seed", "width", "compact"), [(1, 40, 2), (2, 1 << 20, 32)])
def test_last5_by_type_and_running_sum_over_any_split(spark, scratch, events, seed, width, compact):
    parts = _parts(events, seed)
    fn = sroll.last_n(f"{scratch}/l5", f"{scratch}/l5s", "seq", ["event_type"], 5, "seq", "last5", width=width, compact=compact)
    _feed(fn, parts, replayed=(1,))
    cols = ["seq", "event_type", "last5"]
    assert _rows(spark.read.parquet(f"{scratch}/l5"), cols) == _rows(catalog.st_last5_type(spark, SF0001), cols)

    parity = [p.select("seq", ((F.col("seq") % 2) == 0).alias("is_even")) for p in parts]
    fn = sroll.running_sums(f"{scratch}/rs", f"{scratch}/rss", "seq", {"running_sum": F.col("seq")}, ["is_even"], width=width, compact=compact)
    _feed(fn, parity, replayed=(2,))
    cols = ["seq", "is_even", "running_sum"]
    assert _rows(spark.read.parquet(f"{scratch}/rs"), cols) == _rows(catalog.run_sum_by_key(spark, SF0001), cols)


def test_counts_pairs_and_types_by_user(spark, scratch, events):
    parts = _parts(events, 5)
    fn = sroll.running_sums(f"{scratch}/c", f"{scratch}/cs", "seq", {"n_events": F.lit(1)}, ["user_id"], width=9, compact=2)
    _feed(fn, parts, replayed=(2,))
    cols = ["seq", "user_id", "n_events"]
    assert _rows(spark.read.parquet(f"{scratch}/c"), cols) == _rows(catalog.st_count_by_user(spark, SF0001), cols)

    fn = sroll.type_counts(f"{scratch}/t", f"{scratch}/ts", "seq", ["user_id"], "event_type", EVENTS_TABLE_TYPES, width=9)
    _feed(fn, parts)
    cols = ["seq", "user_id", *[f"n_{t}" for t in EVENTS_TABLE_TYPES]]
    assert _rows(spark.read.parquet(f"{scratch}/t"), cols) == _rows(catalog.st_type_counts_by_user(spark, SF0001), cols)

    fn = sroll.last_n_per_type(f"{scratch}/p", f"{scratch}/ps", "seq", ["user_id"], "event_type",
                               {K.add: "last5_add", K.remove: "last5_remove"}, 5, "seq", width=9, compact=3)
    _feed(fn, parts, replayed=(2,))
    cols = ["seq", "user_id", "last5_add", "last5_remove"]
    assert _rows(spark.read.parquet(f"{scratch}/p"), cols) == _rows(catalog.st_last5_pair_by_user(spark, SF0001), cols)


def test_without_keys_null_keys_null_values_and_other_aggregates(spark, scratch):
    rows = [(i, None if i % 3 == 0 else i % 2, None if i % 5 == 0 else (i * 37) % 11) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, k long, v long")
    parts = [df.where((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in ((0, 7), (7, 7), (7, 40), (40, 60))]
    for keys in ([], ["k"]):
        out = f"{scratch}/{len(keys)}"
        fn = sroll.running(f"{out}/o", f"{out}/s", "seq", {"n": (F.sum, scan._plus, F.lit(1).cast("long")), "m": (F.max, F.greatest, F.col("v"))},
                           keys, width=5, compact=2)
        _feed(fn, parts, replayed=(2,))
        fn = sroll.last_n(f"{out}/lo", f"{out}/ls", "seq", keys, 3, "v", as_text=False, width=5, compact=2)
        _feed(fn, parts, replayed=(2,))
        want, lists = [], []
        for s, k, v in rows:
            so_far = [r for r in rows if r[0] <= s and (not keys or r[1] == k)]
            want.append((s, len(so_far), max((r[2] for r in so_far if r[2] is not None), default=None)))
            lists.append((s, [r[2] for r in so_far][-3:]))
        assert sorted(map(tuple, spark.read.parquet(f"{out}/o").select("seq", "n", "m").collect())) == want
        assert sorted(map(tuple, spark.read.parquet(f"{out}/lo").select("seq", "last_n").collect())) == lists


def test_later_batches_come_after_earlier_ones_whatever_their_order_values(spark, scratch):
    fn = sroll.last_n(f"{scratch}/o", f"{scratch}/s", "seq", ["k"], 3, "seq")
    for i, part in enumerate([[10, 11], [3, 4], [7]]):
        fn(spark.createDataFrame([(s, 1) for s in part], "seq long, k long"), i)
    assert sorted(map(tuple, spark.read.parquet(f"{scratch}/o").select("seq", "last_n").collect())) == [
        (3, "10,11,3"), (4, "11,3,4"), (7, "3,4,7"), (10, "10"), (11, "10,11")]


def test_a_hot_key_is_split_and_its_carry_is_a_row_of_the_scan(spark, scratch, monkeypatch):
    """A third of all rows has one key: no (key, bucket) group of the scan is near it, and
    no join meets it."""
    seen, made = [], scan.split

    def split(*args, **kwargs):
        s = made(*args, **kwargs)
        seen.append(s)
        return s

    monkeypatch.setattr(scan, "split", split)
    df = spark.range(9000).selectExpr("id as seq", "IF(id % 3 = 0, -1, id % 500) as k").repartition(4)
    fn = sroll.running_sums(f"{scratch}/o", f"{scratch}/s", "seq", {"n": F.lit(1)}, ["k"], width=300)
    for i in range(2):
        fn(df.where((F.col("seq") >= 4500 * i) & (F.col("seq") < 4500 * (i + 1))), i)
    assert spark.read.parquet(f"{scratch}/o").where("k = -1").agg(F.max("n"), F.count("*")).first() == (3000, 3000)
    for s in seen:
        assert s.any and s.df.groupBy("k", "_bkt").count().agg(F.max("count")).first()[0] < 650
    plan = seen[1].df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # the state's keys, not the rows
    state = spark.read.parquet(f"{scratch}/s/delta")
    assert state.groupBy("batch_id", "k").count().agg(F.max("count")).first()[0] == 1


def test_state_is_compacted_and_must_be_there(spark, scratch):
    fn = sroll.running_sums(f"{scratch}/o", f"{scratch}/s", "seq", {"n": F.lit(1)}, ["k"], compact=3)
    df = spark.createDataFrame([(1, 1)], "seq long, k long")
    with pytest.raises(carry.MissingCarry):
        fn(df, 2)
    for i in range(10):
        fn(df.withColumn("k", F.lit(i % 4).cast("long")), i)
    assert sorted(os.listdir(f"{scratch}/s/base")) == ["batch_id=5", "batch_id=8"]
    assert sorted(os.listdir(f"{scratch}/s/delta")) == [f"batch_id={i}" for i in (6, 7, 8, 9)]
    got = sorted((r["batch_id"], r["n"]) for r in spark.read.parquet(f"{scratch}/o").collect())
    assert got == [(i, i // 4 + 1) for i in range(10)]
    fn(df.withColumn("k", F.lit(0).cast("long")), 8)  # the last compacting micro-batch can be repeated
