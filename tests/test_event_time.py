"""Streams under event time: global sessions, per-event watermarks, timers, sliding windows,
initial state.  Each equals the batch operator."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import counting, watermarks, windows
from eventide.plans import catalog
from eventide.schema import EVENTS_TABLE_TYPES, Kinds
from eventide.streaming import carry, event_time, monitor, replay, sinks, stateful
from eventide.streaming import windows as swin
from tests.conftest import SF0001
from tests.replay_files import write_batch_file

K = Kinds.events_table()
START = dt.datetime(2024, 1, 1)


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def _cuts(df, order, seed, n=3):
    rnd = random.Random(seed)
    top = df.agg(F.max(order)).first()[0]
    cuts = sorted([0, top + 1, *(rnd.randint(0, top) for _ in range(n - 1))])
    cuts.insert(1, cuts[1])  # an empty micro-batch
    return [df.where((F.col(order) >= a) & (F.col(order) < b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _feed(fn, parts, replayed=()):
    for i, p in enumerate(parts):
        fn(p, i)
        if i in replayed:
            fn(p, i)


def _sentinel(df, **values):
    """One event far in the future, which closes everything."""
    row = df.orderBy("seq").limit(1)
    for c, v in {"event_time": F.lit(dt.datetime(2100, 1, 1)).cast(df.schema["event_time"].dataType), **values}.items():
        row = row.withColumn(c, v if not isinstance(v, int) else F.lit(v).cast(df.schema[c].dataType))
    return row


@pytest.mark.parametrize("seed", [1])
def test_global_sessions_equal_the_batch(spark, scratch, seed):
    ev = catalog._ev(spark, SF0001).select("seq", "event_time", "event_type")
    # half an hour: sf0.001 has an event every 43 minutes, so sessions of one and of many
    measures = {"n_match": windows.count_measure(K.is_registered), "n_events": windows.count_measure()}
    fn = event_time.global_sessions(f"{scratch}/o", f"{scratch}/c", "seq", "event_time", "30 minutes", measures,
                                    watermarks.bounded("event_time", "0 seconds"), width=50)
    parts = [*_cuts(ev, "seq", seed), _sentinel(ev, seq=10 ** 9)]
    _feed(fn, parts, replayed=(0, 2))
    cols = ["window_start", "window_end", "n_match", "n_events"]
    got = spark.read.parquet(f"{scratch}/o/sessions").where("window_start < timestamp_ntz'2099-01-01'")
    expected = windows.sessions(ev, "event_time", "30 minutes", measures)
    assert _rows(got, cols) == _rows(expected, cols) and 100 < expected.count() < ev.count() - 100
    assert spark.read.parquet(f"{scratch}/o/late").count() == 0


@pytest.mark.parametrize("seed", [3])
def test_global_sessions_out_of_order_do_not_depend_on_the_cut(spark, scratch, seed):
    rnd = random.Random(9)
    rows = [(i, START + dt.timedelta(seconds=3 * i + rnd.choice([0, 0, -30, 15, 40]))) for i in range(300)]
    ev = spark.createDataFrame(rows, "seq long, event_time timestamp_ntz")
    fn = event_time.global_sessions(f"{scratch}/o", f"{scratch}/c", "seq", "event_time", "4 seconds", {"n": windows.count_measure()},
                                    watermarks.bounded("event_time", "20 seconds"), width=20)
    _feed(fn, [*_cuts(ev, "seq", seed, 5), _sentinel(ev, seq=10 ** 9)], replayed=(1,))
    mark, kept = None, []
    for s, t in rows:
        if mark is None or mark < t:
            kept.append((s, t))
        e = t - dt.timedelta(seconds=20)
        mark = e if mark is None else max(mark, e)
    assert 0 < len(kept) < len(rows)
    expected = windows.sessions(spark.createDataFrame(kept, ev.schema), "event_time", "4 seconds", {"n": windows.count_measure()})
    got = spark.read.parquet(f"{scratch}/o/sessions").where("window_start < timestamp_ntz'2099-01-01'")
    assert _rows(got, ["window_start", "window_end", "n"]) == _rows(expected, ["window_start", "window_end", "n"])
    assert spark.read.parquet(f"{scratch}/o/late").count() == len(rows) - len(kept)


@pytest.mark.parametrize("keys", [[], ["event_type"]])
def test_windows_under_a_per_event_watermark(spark, scratch, keys):
    ev = catalog._arriving(spark, SF0001)
    emitted = watermarks.bounded("event_time", "40 minutes")
    measures = {"n_match": windows.count_measure(K.is_registered), "n_events": windows.count_measure()}
    fn = event_time.on_time_windows(f"{scratch}/o", f"{scratch}/c", "arrival", "event_time", "1 hour", measures, emitted, keys, width=50)
    parts = [*_cuts(ev, "arrival", 5), _sentinel(ev, arrival=10 ** 9)]
    _feed(fn, parts, replayed=(2,))
    expected = watermarks.on_time_sums(ev, "event_time", "arrival", "1 hour", measures, emitted, keys=keys)
    cols = ["window_start", "window_end", *keys, "n_match", "n_events"]
    assert _rows(spark.read.parquet(f"{scratch}/o/windows").where("window_start < timestamp_ntz'2099-01-01'"), cols) == _rows(expected, cols)
    late = watermarks.late_rows(ev, "event_time", "arrival", "1 hour", emitted)
    assert _rows(spark.read.parquet(f"{scratch}/o/late"), ["seq", "watermark"]) == _rows(late, ["seq", "watermark"]) != []
    with pytest.raises(carry.MissingCarry):
        fn(parts[0], 99)


def _replay(spark, scratch, ev, parts=3, sentinel=True):
    folder = os.path.join(scratch, "in")
    n = ev.count()
    for i in range(parts):
        write_batch_file(ev.where((F.col("seq") >= i * n // parts) & (F.col("seq") < (i + 1) * n // parts)), folder, i)
    if sentinel:
        write_batch_file(_sentinel(ev, seq=10 ** 9), folder, parts)
    return replay.replay_stream(spark, folder, ev.schema)


def _run(df, scratch, name):
    q = sinks.start(df, os.path.join(scratch, f"cp-{name}"), fmt="memory", query_name=name, available_now=True)
    q.awaitTermination(600)
    return q


def _instants(spark):
    return spark.read.parquet(f"{SF0001}/events.parquet").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("event_time"), "event_type", "user_id")


def test_sliding_windows_without_expansion(spark, scratch):
    st = _replay(spark, scratch, _instants(spark))
    slid = swin.stream_sliding_sums(st, "event_time", "1 hour", "15 minutes", {"n_match": windows.count_measure(K.is_registered)}, "0 seconds")
    q = _run(slid, scratch, "slid2")
    got = spark.table("slid2").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_match").where("window_start < timestamp_ntz'2099-01-01'")
    assert _rows(got, ["window_start", "n_match"]) == _rows(catalog.ev_sliding_count(spark, SF0001), ["window_start", "n_match"])
    updated = [sum(o["numRowsUpdated"] for o in p["stateOperators"]) for p in q.recentProgress]
    first = [p["stateOperators"][-1]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"] > 100]
    assert first and max(first) <= 340 and sum(updated) > 0  # one state row per slide with events, not one per event and window
    with pytest.raises(ValueError, match="divide"):
        swin.stream_sliding_sums(st, "event_time", "1 hour", "25 minutes", {}, "0 seconds")


@pytest.mark.parametrize("purge", [False, True])
def test_window_count_trigger_drops_the_state_of_closed_windows(spark, scratch, purge):
    log = monitor.attach(spark)
    ev = _instants(spark)
    st = swin.with_watermark(_replay(spark, scratch, ev), "event_time", "1 hour")
    w = stateful.in_windows(st.withColumn("is_add", F.col("event_type") == K.add), "event_time", "6 hours")
    out = stateful.apply_stateful(w, ["window_start", "window_end"], stateful.WindowCountTrigger(["window_start", "window_end"], "seq", 3, "is_add", purge=purge),
                                  "window_start timestamp, window_end timestamp, fire long, n_seen long, n_match long", event_time=True)
    q = _run(out, scratch, f"timers{int(purge)}")
    batch = counting.window_count_trigger(ev, "event_time", "6 hours", "seq", 3, {"n_match": windows.count_measure(K.is_add)}, purge=purge)
    cols = ["window_start", "fire", "n_seen", "n_match"]
    assert _rows(spark.table(f"timers{int(purge)}"), cols) == _rows(batch, cols)
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress]
    most = ev.select(F.window("event_time", "6 hours")).distinct().count()
    assert max(held) < 2.5 * most and held[-1] <= 3  # the sentinel's window (and its timer) are left
    assert log is not None
    with pytest.raises(ValueError, match="processing time"):
        stateful.apply_stateful(w, ["window_start"], stateful.RunningSum(["window_start"], "seq", None, "n"), "n long", ttl_ms=5, event_time=True)


PROCESSORS = {
    "sum": (lambda: stateful.RunningSum(["user_id"], "seq", "seq", "n"), "user_id long, seq long, n long"),
    "types": (lambda: stateful.TypeCounts(["user_id"], "seq", "event_type", EVENTS_TABLE_TYPES),
              "user_id long, seq long, " + ", ".join(f"n_{t} long" for t in EVENTS_TABLE_TYPES)),
    "last": (lambda: stateful.LastN(["user_id"], "seq", "seq", 4), "user_id long, seq long, last_n string"),
    "pairs": (lambda: stateful.LastNPerType(["user_id"], "seq", "event_type", "seq", {K.add: "a", K.remove: "r"}, 3),
              "user_id long, seq long, a string, r string"),
    "pages": (lambda: stateful.HistoryPages(["user_id"], "seq", "seq", 7), "user_id long, seq long, position long, page long, history string"),
}


@pytest.mark.parametrize("name", sorted(PROCESSORS))
def test_a_stream_goes_on_where_a_batch_has_ended(spark, scratch, name):
    """Batch to event k, stream from k: as the uninterrupted run."""
    make, schema = PROCESSORS[name]
    ev, k = _instants(spark).select("seq", "event_time", "event_type", "user_id"), 600
    whole = stateful.apply_stateful(ev, ["user_id"], make(), schema).where(F.col("seq") >= k)
    initial = make().state_of(ev.where(F.col("seq") < k))
    assert initial.count() == ev.where(F.col("seq") < k).select("user_id").distinct().count()
    folder = os.path.join(scratch, "rest")
    write_batch_file(ev.where((F.col("seq") >= k) & (F.col("seq") < 800)), folder, 0)
    write_batch_file(ev.where(F.col("seq") >= 800), folder, 1)
    st = replay.replay_stream(spark, folder, ev.schema)
    _run(stateful.apply_stateful(st, ["user_id"], make(), schema, initial=initial), scratch, f"go_on_{name}")
    got, cols = spark.table(f"go_on_{name}"), [c.split()[0] for c in schema.split(", ")]
    if name == "pages":  # the text so far comes with a page's last row in a micro-batch or call
        cols = cols[:-1]
        full = got.where("history IS NOT NULL").groupBy("user_id", "page").agg(F.max_by("history", "seq").alias("h"))
        want = make().state_of(ev).select("user_id", (F.col("pos") / 7).cast("long").alias("page"), F.array_join("page", ",").alias("h")).where("h <> ''")
        assert set(_rows(want, ["user_id", "page", "h"])) <= set(_rows(full, ["user_id", "page", "h"])) | set(_rows(initial.select("user_id", (F.col("pos") / 7).cast("long").alias("page"), F.array_join("page", ",").alias("h")), ["user_id", "page", "h"]))
    assert _rows(got, cols) == _rows(whole, cols)
    if name == "sum":  # the state store holds what a batch says
        held = spark.read.format("statestore").option("stateVarName", "total").load(os.path.join(scratch, f"cp-go_on_{name}"))
        state = held.select(F.col("key.user_id").alias("user_id"), F.col("value.total").alias("total"))
        assert _rows(state, ["user_id", "total"]) == _rows(make().state_of(ev), ["user_id", "total"])
