"""The ready-made streaming jobs on a replay of the driver's events table."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventide.operators import best, transform
from eventide.plans import catalog
from eventide.plans.tables import EVENTS_TABLE_MAPPING
from eventide.schema import EVENTS_TABLE_TYPES, Kinds
from eventide.sources.events import read_events
from eventide.streaming import carry, jobs, replay
from eventide.streaming import windows as swin
from tests.replay_files import write_batch_file
from tests.conftest import SF0001

K = Kinds.events_table()


@pytest.fixture()
def events(spark, scratch):
    raw = spark.read.parquet(f"{SF0001}/events.parquet")
    folder = os.path.join(scratch, "raw")
    # contiguous ranges: arrival order = seq order, as in the batch answers
    for i, (lo, hi) in enumerate([(0, 300), (300, 700), (700, 10**9)]):
        write_batch_file(raw.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)), folder, i)
    return folder


def _stream(spark, folder):
    return read_events(spark, folder, EVENTS_TABLE_MAPPING, streaming=True, max_files_per_trigger=1)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _run(q):
    q.awaitTermination(600)
    assert q.exception() is None


def test_rolling_doubled_highq_last5_jobs(spark, scratch, events):
    out = lambda n: os.path.join(scratch, n)
    cp = lambda n: os.path.join(scratch, "cp-" + n)
    _run(jobs.rolling_sum_job(_stream(spark, events), out("rs"), cp("rs"), available_now=True))
    assert _rows(spark.read.parquet(out("rs")), ["seq", "running_sum"]) == \
        _rows(catalog.run_sum_by_key(spark, SF0001), ["seq", "running_sum"])

    _run(jobs.last5_type_job(_stream(spark, events), out("lt"), cp("lt"), available_now=True))
    assert _rows(spark.read.parquet(out("lt")), ["seq", "last5"]) == _rows(catalog.st_last5_type(spark, SF0001), ["seq", "last5"])
    _run(jobs.count_by_user_job(_stream(spark, events), out("cu"), cp("cu"), available_now=True))
    assert _rows(spark.read.parquet(out("cu")), ["seq", "n_events"]) == _rows(catalog.st_count_by_user(spark, SF0001), ["seq", "n_events"])
    _run(jobs.type_counts_job(_stream(spark, events), out("tc"), cp("tc"), EVENTS_TABLE_TYPES, available_now=True))
    cols = ["seq", *[f"n_{t}" for t in EVENTS_TABLE_TYPES]]
    assert _rows(spark.read.parquet(out("tc")), cols) == _rows(catalog.st_type_counts_by_user(spark, SF0001), cols)

    _run(jobs.doubled_job(_stream(spark, events), out("dbl"), cp("dbl"), available_now=True))
    assert _rows(spark.read.parquet(out("dbl")), ["seq", "doubled"]) == \
        [(s, 2 * s) for (s,) in _rows(spark.read.parquet(f"{SF0001}/events.parquet")
                                      .withColumnRenamed("event_id", "seq"), ["seq"])]

    _run(jobs.high_quantity_job(_stream(spark, events), out("hq"), cp("hq"), kinds=K, available_now=True))
    assert _rows(spark.read.parquet(out("hq")), ["sku", "quantity"]) == \
        _rows(catalog.ev_high_quantity(spark, SF0001), ["sku", "quantity"])

    _run(jobs.last5_pair_job(_stream(spark, events), out("l5"), cp("l5"), kinds=K, available_now=True))
    got = spark.read.parquet(out("l5")).withColumnRenamed("last_add", "last5_add") \
        .withColumnRenamed("last_remove", "last5_remove")
    cols = ["seq", "user_id", "last5_add", "last5_remove"]
    assert _rows(got, cols) == _rows(catalog.st_last5_pair_by_user(spark, SF0001), cols)


def test_best_window_trigger_time_and_fizzbuzz_jobs(spark, scratch, events):
    raw = spark.read.parquet(f"{SF0001}/events.parquet")
    sent = replay.sentinel_row(raw, "ts", event_id=10**9, event_type="sentinel", user_id=-1, value=0.0)
    write_batch_file(sent, events, 9)
    out, cp = os.path.join(scratch, "bw"), os.path.join(scratch, "cp-bw")
    _run(jobs.best_window_job(_stream(spark, events), out, cp, kinds=K, size="2 hours", delay="0 seconds",
                              available_now=True))
    got = spark.read.parquet(os.path.join(out, "best")).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("best_start").cast("timestamp_ntz").alias("best_start"), "best_net")
    exp = best.best_so_far(catalog.ev_net_tumbling(spark, SF0001))
    cols = ["window_start", "best_start", "best_net"]
    assert _rows(got, cols) == _rows(exp, cols)

    jobs.best_window_replay(read_events(spark, events, EVENTS_TABLE_MAPPING).where("event_type <> 'sentinel'"), os.path.join(scratch, "bwr"), kinds=K,
                            size="2 hours")
    assert _rows(spark.read.parquet(os.path.join(scratch, "bwr", "best")), cols) == _rows(exp, cols)

    pt = os.path.join(scratch, "ptjob")
    _run(jobs.processing_time_job(_stream(spark, events), pt, os.path.join(scratch, "cp-pt"), kinds=K,
                                  available_now=True))
    last = swin.latest_windows(spark.read.parquet(pt))
    assert sum(r.n_match for r in last.collect()) == raw.where("event_type = 'purchase'").count()

    fz = os.path.join(scratch, "fz")
    _run(jobs.fizzbuzz_job(_stream(spark, events), fz, os.path.join(scratch, "cp-fz"), available_now=True))
    tags = spark.read.text(os.path.join(fz, "batch_id=*", "route=fizz_and_buzz"))
    replayed = spark.read.parquet(events)  # includes the sentinel row
    exp_n = transform.fizzbuzz_routes(replayed.withColumnRenamed("event_id", "seq"), "seq") \
        .where("route = 'fizz_and_buzz'").count()
    assert tags.count() == exp_n


@pytest.mark.parametrize(("n", "purge"), [(3, False), (7, True)])
def test_window_count_trigger_over_micro_batches(spark, scratch, purge, n):
    """Exact fires of windows that go on over micro-batches, with many buckets in each."""
    rows = [(i, 0 if i < 140 else 1, i % 5 < 2) for i in range(200)]
    parts, start = [rows[:50], rows[50:53], [], rows[53:140], rows[140:141], rows[141:200]], dt.datetime(2024, 1, 1)
    fn = carry.window_count_trigger(f"{scratch}/out", f"{scratch}/carry", "seq", n, F.col("m"), purge=purge, width=9)
    for i, part in enumerate(parts):
        df = spark.createDataFrame([(s, start + dt.timedelta(hours=w), start + dt.timedelta(hours=w + 1), m) for s, w, m in part],
                                   "seq long, window_start timestamp, window_end timestamp, m boolean")
        fn(df, i)
        if i == 3:
            fn(df, i)  # a replay changes nothing
    got = sorted((r.window_start.hour, r.fire, r.n_seen, r.n_match) for r in spark.read.parquet(f"{scratch}/out").collect())
    exp = []
    for w in (0, 1):
        own = [m for _, x, m in rows if x == w]
        for k in range(1, len(own) // n + 1):
            exp.append((w, k, n, sum(own[(k - 1) * n:k * n])) if purge else (w, k, k * n, sum(own[:k * n])))
    assert got == sorted(exp)


def test_missing_carry_fails(spark, scratch):
    fn = carry.global_count_trigger(f"{scratch}/out", f"{scratch}/carry", "seq", 2, F.lit(True))
    df = spark.range(5).withColumnRenamed("id", "seq")
    with pytest.raises(carry.MissingCarry):
        fn(df, 3)
    fn(df, 0)
    fn(df, 1)
    with pytest.raises(carry.MissingCarry):
        fn(df, 3)


def test_old_carries_are_deleted(spark, scratch):
    store = carry.CarryStore(f"{scratch}/carry", keep=3)
    for i in range(8):
        store.write(spark.range(1).select(F.lit(i).alias("x")), i)
    assert sorted(os.listdir(f"{scratch}/carry")) == ["batch_id=5", "batch_id=6", "batch_id=7"]
    assert store.before(spark, 8) == {"x": 7}
