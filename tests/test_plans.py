"""Physical plan shape: pushdown, pruning, and no single task over raw rows."""

from __future__ import annotations

import re

import pytest

from eventide.operators import rolling, scan
from eventide.plans import catalog
from eventide.plans.verify import plan_text
from tests.conftest import SF001


def executed(df):
    """Nodes of the plan that ran, as (depth, text), parents before children."""
    df.collect()
    tree = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    found = [re.match(r"^([\s:+\-]*)(?:\*\(\d+\) )?([A-Z]\w*.*)$", line) for line in tree.split("\n")]
    return [(len(m[1]), m[2]) for m in found if m]


def raw_exchanges(nodes):
    """Shuffles of rows that no aggregate has reduced since the last shuffle or scan."""
    raw = []
    for i, (depth, text) in enumerate(nodes):
        if not text.startswith("Exchange "):
            continue
        below = []
        for deeper, child in nodes[i + 1:]:
            if deeper <= depth or child.startswith(("Exchange ", "ReusedExchange")):
                break
            below.append(child)
        if not any("Aggregate(" in x for x in below):
            raw.append(text)
    return raw


@pytest.mark.parametrize(("name", "split"), [
    ("run_sum_by_key", True), ("ev_count_trigger", True), ("st_last5_type", True), ("ev_session_global", True),
    ("st_count_by_user", False), ("st_type_counts_by_user", False), ("st_last5_user_type", False),
    ("st_last5_pair_by_user", False), ("ev_session_by_user", False), ("ev_window_count_trigger", False)])
def test_raw_rows_move_once(spark, name, split):
    """The plan that ran has one exchange of the raw rows, whether keys are split or not."""
    nodes = executed(catalog.QUERIES[name](spark, SF001))
    assert any("_bkt" in text for _, text in nodes if text.startswith("Exchange ")) == split
    assert len(raw_exchanges(nodes)) == 1, raw_exchanges(nodes)


@pytest.mark.parametrize("width", [8, 32])
def test_split_user_keys_move_rows_once_too(spark, width):
    """Scans per user with a width that splits users: one exchange, and at most one more
    look at the input, for the totals."""
    ev = catalog._ev(spark, SF001).select("seq", "user_id", "event_type")
    sums = rolling.running_count_by_key(ev, "seq", ["user_id"], width=width)
    pair = rolling.last_n_per_type(ev, "seq", ["user_id"], "event_type", {"purchase": "a", "click": "r"}, 5, "seq", width=width)
    for df, scans in ((sums, 2), (pair, 1)):
        nodes = executed(df)
        assert any("_bkt" in text for _, text in nodes if text.startswith("Exchange "))
        assert len(raw_exchanges(nodes)) == 1, raw_exchanges(nodes)
        assert sum("FileScan" in text for _, text in nodes) <= scans


def test_default_width_takes_no_count(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def count(self):
        raise AssertionError("a second statistics job")

    monkeypatch.setattr(DataFrame, "count", count)
    assert not scan.split(_events(spark, [(1, 1)]), "seq", ["k"]).any
    with pytest.raises(AssertionError):
        scan.split(_events(spark, [(1, 1)]), "seq", ["k"], 5)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_single_partition_over_raw_rows(spark, name):
    """A single task may only take what an aggregate has reduced: bucket summaries,
    window tables, one-row results."""
    nodes = executed(catalog.QUERIES[name](spark, SF001))
    assert not [x for x in raw_exchanges(nodes) if "SinglePartition" in x]


def _events(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "k long, seq long").repartition(4).withColumn("t", F.timestamp_micros("seq"))


def _largest(s):
    from pyspark.sql import functions as F

    return s.df.groupBy("k", "_bkt").agg(F.count("*").alias("n")).agg(F.max("n"), F.count("*")).first()


@pytest.mark.parametrize("order", ["seq", "t"])
def test_buckets_are_bounded_for_any_order(spark, order):
    """Sparse ids, a burst and one outlier: the largest bucket is near the width."""
    sparse = [(1, i << 20) for i in range(8000)]
    burst = [(2, 10**12 + i) for i in range(8000)] + [(2, 5), (2, 10**15)]
    for rows in (sparse, burst):
        most, buckets = _largest(scan.split(_events(spark, rows), order, ["k"], 640))
        assert most <= 2 * 640 and buckets <= 3 * len(rows) / 640
        df = _events(spark, rows).drop("k")
        whole = scan.split(df, order, [], 640).df.groupBy("_bkt").count().agg({"count": "max"}).first()[0]
        assert whole <= 2 * 640


def test_only_hot_keys_are_split(spark):
    """Many small keys and one hot key: as many buckets as the hot key needs, and a
    carry far smaller than the input."""
    rows = [(i % 1000, i) for i in range(10000)] + [(-1, 10**6 + i) for i in range(5000)]
    s = scan.split(_events(spark, rows), "seq", ["k"], 500)
    assert s.any
    split_keys = {r["k"] for r in s.df.where("_split").select("k").distinct().collect()}
    assert split_keys == {-1}
    assert s.df.where("_split").select("k", "_bkt").distinct().count() <= 20
    small = scan.split(_events(spark, rows[:10000]), "seq", ["k"], 500)
    assert not small.any


def test_null_order_fails(spark):
    from pyspark.sql import functions as F

    df = _events(spark, [(1, 1), (1, None), (None, 3)])
    with pytest.raises(Exception, match="null in order column"):
        scan.running_sums(df, "seq", {"n": F.lit(1)}, ["k"]).collect()


def test_filter_pushdown_and_pruning(spark):
    plan = plan_text(catalog.ev_high_quantity(spark, SF001))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "EqualTo(event_type,purchase)" in pushed
    read = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "user_id" not in read and "ts" not in read


def test_window_queries_read_only_needed_columns(spark):
    plan = plan_text(catalog.ev_tumbling_count(spark, SF001))
    read = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert read == "struct<ts:timestamp_ntz,event_type:string>"


def test_sliding_window_expands_after_preaggregation(spark):
    plan = plan_text(catalog.ev_sliding_count(spark, SF001))
    # the explode (Generate) must sit above the first aggregate, not on the scan
    tree = plan.split("\n\n")[0]
    assert tree.index("Generate") < tree.rindex("HashAggregate")
    assert "Expand" not in tree
