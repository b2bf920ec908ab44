"""Properties over the whole sf0.01 events table, and the spread of a hot key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventide.operators import counting, scan, transform, windows
from eventide.schema import Kinds
from eventide.plans.tables import events_table
from tests.conftest import SF001

K = Kinds.events_table()


@pytest.fixture(scope="module")
def ev(spark):
    return events_table(spark, SF001)


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_tumbling_counts_sum_to_rows(ev):
    out = windows.window_counts(ev, "event_time", "37 minutes", K.is_registered, with_total=True)
    assert _sum(out, "n_events") == ev.count()
    assert _sum(out, "n_match") == ev.where(K.is_registered).count()


@pytest.mark.parametrize("size,slide,k", [("1 hour", "15 minutes", 4), ("3 hours", "1 hour", 3),
                                          ("50 minutes", "20 minutes", None)])
def test_sliding_counts_sum_to_k_times_rows(ev, size, slide, k):
    out = windows.window_counts(ev, "event_time", size, K.is_registered, slide=slide, with_total=True)
    total = _sum(out, "n_events")
    if k is not None:
        assert total == k * ev.count()
    else:  # size not a multiple of slide: each row is in 2 or 3 windows
        assert 2 * ev.count() <= total <= 3 * ev.count()


def test_itemized_rows_equal_positive_quantities(ev):
    items = transform.itemize(ev, K.is_add)
    assert items.count() == _sum(ev.where(K.is_add & (F.col("quantity") > 0)), "quantity")


@pytest.mark.parametrize("n", [3, 7, 10])
def test_purged_groups_bound_rows(ev, n):
    out = counting.count_trigger(ev, "seq", n, {"m": windows.count_measure(K.is_add)}, purge=True,
                                 width=997)
    groups, rows = out.count(), ev.count()
    assert groups * n <= rows < (groups + 1) * n
    assert _sum(out, "n_seen") == groups * n


def test_sessions_partition_all_rows(ev):
    out = windows.sessions(ev, "event_time", "20 minutes", {"n": windows.count_measure()}, keys=["user_id"],
                           width=50)
    assert _sum(out, "n") == ev.count()
    # sessions of one user never overlap
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("window_start")
    nxt = out.withColumn("next_start", F.lead("window_start").over(w))
    assert nxt.where(F.col("next_start") <= F.col("window_end")).count() == 0


def test_hot_key_is_spread_over_tasks(spark, ev):
    """A key with a third of all rows: the direct window puts it in one task,
    the bucketed scan spreads it over every shuffle partition."""
    hot = ev.withColumn("k", F.when(F.col("seq") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan.running_sums(hot, "seq", {"n": F.lit(1).cast("long")}, keys=["k"],
                                width=100)
        hot_rows = out.where("k = -1").groupBy(F.spark_partition_id().alias("p")).agg(
                F.count("*").alias("count"), F.max("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    n_hot = sum(r["count"] for r in hot_rows)
    assert n_hot == hot.where("k = -1").count()
    assert len(hot_rows) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in hot_rows) < 0.3 * n_hot
