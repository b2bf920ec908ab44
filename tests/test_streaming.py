"""Streams: replay with and without sentinel, late data, stateful processors
(stream = batch), foreachBatch carries, recovery from a checkpoint, sinks."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators import best, counting, rolling, windows
from eventide.plans import catalog
from eventide.plans.tables import EVENTS_TABLE_MAPPING
from eventide.schema import Kinds
from eventide.streaming import carry, monitor, replay, sinks, stateful
from eventide.streaming import windows as swin
from tests.replay_files import write_batch_file
from tests.conftest import SF0001
from tests.fixtures import BASE, SERVER_EVENTS, SERVER_SCHEMA, secs, server_events

K = Kinds.domain()
KE = Kinds.events_table()


def _server_rows(spark, items, seq0=1):
    rows = [(seq0 + i, BASE + dt.timedelta(seconds=s), k, p, p, None) for i, (s, k, p) in enumerate(items)]
    return spark.createDataFrame(rows, SERVER_SCHEMA)


def _replay_server(spark, folder, batches, sentinel=True):
    seq = 1
    for i, items in enumerate(batches):
        write_batch_file(_server_rows(spark, items, seq), folder, i)
        seq += len(items)
    if sentinel:
        s = replay.sentinel_row(server_events(spark), "event_time", seq=10_000, event_type="Sentinel",
                                player_id="-")
        write_batch_file(s, folder, len(batches))


def _run(stream_df, scratch, name, mode="append", foreach_batch=None):
    q = sinks.start(stream_df, os.path.join(scratch, f"cp-{name}"), fmt="memory", query_name=name,
                    output_mode=mode, available_now=True, foreach_batch=foreach_batch)
    q.awaitTermination(600)
    return q


def _tumbling3(spark, folder):
    st = replay.replay_stream(spark, folder, SERVER_SCHEMA)
    return swin.stream_window_counts(st, "event_time", "3 seconds", K.is_registered, "1 second")


def _starts(spark, name, col="n_match"):
    return {secs(r.window_start): r[col] for r in spark.table(name).collect()}


def test_replay_without_sentinel_leaves_last_windows_open(spark, scratch):
    folder = os.path.join(scratch, "in")
    threes = [SERVER_EVENTS[i:i + 3] for i in range(0, 18, 3)]
    _replay_server(spark, folder, threes, sentinel=False)
    _run(_tumbling3(spark, folder), scratch, "nosent")
    assert _starts(spark, "nosent") == {0: 1, 3: 3, 6: 2}


def test_replay_with_sentinel_equals_batch(spark, scratch):
    folder = os.path.join(scratch, "in")
    threes = [SERVER_EVENTS[i:i + 3] for i in range(0, 18, 3)]
    _replay_server(spark, folder, threes)
    _run(_tumbling3(spark, folder), scratch, "sent")
    batch = windows.window_counts(server_events(spark), "event_time", "3 seconds", K.is_registered)
    assert _starts(spark, "sent") == {secs(r.window_start): r.n_match for r in batch.collect()}


def test_stream_session_constant_key(spark, scratch):
    folder = os.path.join(scratch, "in")
    _replay_server(spark, folder, [SERVER_EVENTS[i:i + 3] for i in range(0, 18, 3)])
    st = replay.replay_stream(spark, folder, SERVER_SCHEMA)
    st = st.withColumn("one", F.lit(1))
    out = swin.stream_sessions(st, "event_time", "1 second",
                               {"n_match": windows.count_measure(K.is_registered)}, "1 second", keys=["one"])
    _run(out, scratch, "sess")
    got = {(secs(r.window_start), secs(r.window_end)): r.n_match for r in spark.table("sess").collect()}
    assert got == {(2, 5): 4, (6, 13): 2}


def _late(spark, scratch, name, batches):
    log = monitor.attach(spark, keep=1)
    folder = os.path.join(scratch, "in")
    _replay_server(spark, folder, [[(s, K.registered, f"p{s}") for s in b] for b in batches])
    _run(_tumbling3(spark, folder), scratch, name)
    for _ in range(100):
        if log.totals.get(name, {}).get("batches", 0) > len(batches):
            break
        time.sleep(0.1)
    assert len(log.events) == 1  # bounded, whatever the number of micro-batches
    return _starts(spark, name), log.dropped(name)


def test_late_row_in_same_batch_is_kept(spark, scratch):
    got, dropped = _late(spark, scratch, "late0", [[20, 2]])
    assert got == {0: 1, 18: 1} and dropped == 0


def test_late_row_one_batch_later_is_kept(spark, scratch):
    got, dropped = _late(spark, scratch, "late1", [[2, 20], [3], [19]])
    assert got == {0: 1, 3: 1, 18: 2} and dropped == 0


def test_late_row_two_batches_later_is_dropped(spark, scratch):
    got, dropped = _late(spark, scratch, "late2", [[2, 20], [3], [4, 19]])
    assert got[3] == 1 and dropped == 1


def _events_replay(spark, scratch, parts=4):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("event_time"),
        "event_type", "user_id")
    folder = os.path.join(scratch, "events")
    n = ev.count()
    for i in range(parts):
        lo, hi = i * n // parts, (i + 1) * n // parts
        write_batch_file(ev.where((F.col("seq") >= lo) & (F.col("seq") < hi)), folder, i)
    return ev, folder


def _same_rows(a, b, cols):
    ra = sorted(tuple(r[c] for c in cols) for r in a.collect())
    rb = sorted(tuple(r[c] for c in cols) for r in b.collect())
    assert ra == rb


def test_stateful_running_count_equals_batch(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    out = stateful.apply_stateful(st, ["user_id"], stateful.RunningSum(["user_id"], "seq", None, "n_events"),
                                  "user_id long, seq long, n_events long")
    _run(out, scratch, "cnt")
    _same_rows(spark.table("cnt"), catalog.st_count_by_user(spark, SF0001), ["seq", "user_id", "n_events"])


def test_stateful_type_counts_and_last5_equal_batch(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    types = list(catalog.EVENTS_TABLE_TYPES)
    tc = stateful.apply_stateful(
        st, ["user_id"], stateful.TypeCounts(["user_id"], "seq", "event_type", types),
        "user_id long, seq long, " + ", ".join(f"n_{t} long" for t in types))
    _run(tc, scratch, "tc")
    _same_rows(spark.table("tc"), catalog.st_type_counts_by_user(spark, SF0001),
               ["seq", "user_id", *[f"n_{t}" for t in types]])

    st2 = replay.replay_stream(spark, folder, ev.schema)
    l5 = stateful.apply_stateful(
        st2, ["user_id", "event_type"], stateful.LastN(["user_id", "event_type"], "seq", "seq", 5, "last5"),
        "user_id long, event_type string, seq long, last5 string")
    _run(l5, scratch, "l5")
    _same_rows(spark.table("l5"), catalog.st_last5_user_type(spark, SF0001), ["seq", "user_id", "last5"])

    st3 = replay.replay_stream(spark, folder, ev.schema)
    pair = stateful.apply_stateful(
        st3, ["user_id"], stateful.LastNPerType(["user_id"], "seq", "event_type", "seq",
                                                {KE.add: "last5_add", KE.remove: "last5_remove"}, 5),
        "user_id long, seq long, last5_add string, last5_remove string")
    _run(pair, scratch, "pair")
    _same_rows(spark.table("pair"), catalog.st_last5_pair_by_user(spark, SF0001),
               ["seq", "user_id", "last5_add", "last5_remove"])


@pytest.mark.parametrize("purge", [False, True])
def test_stateful_window_count_trigger_equals_batch(spark, scratch, purge):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    w = (st.withColumn("_w", F.window("event_time", "6 hours"))
           .select("seq", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                   (F.col("event_type") == KE.add).alias("is_add")))
    out = stateful.apply_stateful(
        w, ["window_start", "window_end"],
        stateful.CountTrigger(["window_start", "window_end"], "seq", 3, "is_add", purge=purge),
        "window_start timestamp, window_end timestamp, fire long, n_seen long, n_match long")
    _run(out, scratch, f"wct{int(purge)}")
    batch = counting.window_count_trigger(ev, "event_time", "6 hours", "seq", 3,
                                          {"n_match": windows.count_measure(KE.is_add)}, purge=purge)
    _same_rows(spark.table(f"wct{int(purge)}"), batch, ["window_start", "fire", "n_seen", "n_match"])


def test_history_pages_stream(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    out = stateful.apply_stateful(st, ["user_id"], stateful.HistoryPages(["user_id"], "seq", "seq", 10),
                                  "user_id long, seq long, position long, page long, history string")
    _run(out, scratch, "hist")
    got = spark.table("hist")
    # the last row of every full page is that page of the batch history
    full = got.where(F.col("position") % 10 == 0).select("user_id", "page", "history")
    batch = rolling.history_pages(ev, "seq", ["user_id"], "seq", page_size=10).where("n_events = 10")
    _same_rows(full, batch, ["user_id", "page", "history"])


def test_restart_from_checkpoint_continues_state(spark, scratch):
    ev, folder = _events_replay(spark, scratch, parts=4)
    live = os.path.join(scratch, "live")
    os.makedirs(live)
    files = sorted(os.listdir(folder))
    out_dir, cp = os.path.join(scratch, "out"), os.path.join(scratch, "cp-restart")

    def run_once():
        st = replay.replay_stream(spark, live, ev.schema)
        out = stateful.apply_stateful(st, ["user_id"], stateful.RunningSum(["user_id"], "seq", None, "n_events"),
                                      "user_id long, seq long, n_events long")
        q = sinks.start(out, cp, fmt="parquet", path=out_dir, available_now=True)
        q.awaitTermination(600)

    for f in files[:2]:
        os.link(os.path.join(folder, f), os.path.join(live, f))
    run_once()
    for f in files[2:]:
        os.link(os.path.join(folder, f), os.path.join(live, f))
    run_once()  # new query, same checkpoint: resumes offsets and keyed state
    _same_rows(spark.read.parquet(out_dir), catalog.st_count_by_user(spark, SF0001),
               ["seq", "user_id", "n_events"])


def test_foreach_batch_global_count_trigger(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    out_path, carry_path = os.path.join(scratch, "gct"), os.path.join(scratch, "gct-carry")
    fn = carry.global_count_trigger(out_path, carry_path, "seq", 10, F.col("event_type") == KE.registered)
    _run(st, scratch, "gct", foreach_batch=fn)
    got = spark.read.parquet(out_path).drop("batch_id")
    _same_rows(got, catalog.ev_count_trigger(spark, SF0001), ["fire", "n_seen", "n_match"])


def test_foreach_batch_best_so_far(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    sent = replay.sentinel_row(ev, "event_time", seq=10**9, event_type="sentinel", user_id=-1)
    write_batch_file(sent, folder, 99)
    st = replay.replay_stream(spark, folder, ev.schema)
    net = swin.stream_net_change(st, "event_time", "2 hours", KE.is_online, KE.is_offline, "0 seconds")
    out_path, carry_path = os.path.join(scratch, "bsf"), os.path.join(scratch, "bsf-carry")
    _run(net, scratch, "bsf", foreach_batch=carry.best_window_so_far(out_path, carry_path))
    got = spark.read.parquet(out_path).drop("batch_id")
    batch = best.best_so_far(catalog.ev_net_tumbling(spark, SF0001))
    got = got.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                     F.col("best_start").cast("timestamp_ntz").alias("best_start"), "best_net")
    _same_rows(got, batch, ["window_start", "best_start", "best_net"])


def test_route_writer_and_text_sink(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    three, five = (F.col("seq") % 3) == 0, (F.col("seq") % 5) == 0
    rts = {"fizz": (three, F.lit("fizz")), "buzz": (five, F.lit("buzz"))}
    base = os.path.join(scratch, "routes")
    _run(st, scratch, "routes", foreach_batch=sinks.route_writer(rts, base))
    n_fizz = spark.read.text(os.path.join(base, "batch_id=*", "route=fizz")).count()
    n_buzz = spark.read.text(os.path.join(base, "batch_id=*", "route=buzz")).count()
    assert (n_fizz, n_buzz) == (ev.where(three).count(), ev.where(five).count())

    txt = os.path.join(scratch, "text")
    sinks.write_text(ev.where(three), txt, "seq", single_file=True)
    assert len(glob.glob(os.path.join(txt, "part-*"))) == 1
    back = sorted(int(r.value) for r in spark.read.text(txt).collect())
    assert back == sorted(r.seq for r in ev.where(three).select("seq").collect())

    stream_txt = os.path.join(scratch, "stext")
    q = sinks.stream_text(replay.replay_stream(spark, folder, ev.schema), stream_txt,
                          os.path.join(scratch, "cp-stext"), "seq", trigger={"availableNow": True})
    q.awaitTermination(600)
    assert spark.read.text(stream_txt).count() == ev.count()


def test_progress_listener_and_processing_time(spark, scratch):
    log = monitor.attach(spark)
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    out = swin.processing_time_windows(st, "3 seconds", {"n": windows.count_measure()})
    _run(out, scratch, "ptime", mode="complete")
    assert sum(r.n for r in spark.table("ptime").collect()) == ev.count()
    for _ in range(50):
        if len(log.for_query("ptime")) >= 4:
            break
        time.sleep(0.2)
    evs = log.for_query("ptime")
    assert sum(e["input_rows"] for e in evs) == ev.count()
    assert [e["batch_id"] for e in evs][:4] == [0, 1, 2, 3]


@pytest.mark.parametrize("n_files", [1, 5])
def test_replay_invariance(spark, scratch, n_files):
    """Any split of in-order data into micro-batches gives the batch answer."""
    ev = spark.read.parquet(f"{SF0001}/events.parquet").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("event_time"), "event_type")
    folder = os.path.join(scratch, "inv")
    n = ev.count()
    for i in range(n_files):
        lo, hi = i * n // n_files, (i + 1) * n // n_files
        write_batch_file(ev.where((F.col("seq") >= lo) & (F.col("seq") < hi)), folder, i)
    write_batch_file(replay.sentinel_row(ev, "event_time", seq=10**9, event_type="x"), folder, n_files)
    st = replay.replay_stream(spark, folder, ev.schema)
    out = swin.stream_window_counts(st, "event_time", "1 hour", KE.is_registered, "0 seconds")
    _run(out, scratch, f"inv{n_files}")
    batch = catalog.ev_tumbling_count(spark, SF0001)
    got = spark.table(f"inv{n_files}").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                              "n_match")
    _same_rows(got, batch, ["window_start", "n_match"])


def test_rolling_sum_stream_with_ttl_and_sliding_windows(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema).withColumn("is_even", (F.col("seq") % 2) == 0)
    out = stateful.apply_stateful(st, ["is_even"], stateful.RunningSum(["is_even"], "seq", "seq", "running_sum"),
                                  "is_even boolean, seq long, running_sum long", ttl_ms=3_600_000)
    # TTL needs processing-time mode, which keeps a query alive for expiry, so
    # it runs on a continuous trigger: process what is there, then stop.
    q = sinks.start(out, os.path.join(scratch, "cp-rsum"), fmt="memory", query_name="rsum",
                    interval="1 second")
    try:
        deadline = time.time() + 240
        while time.time() < deadline and spark.table("rsum").count() < ev.count():
            time.sleep(1)
    finally:
        q.stop()
    _same_rows(spark.table("rsum"), catalog.run_sum_by_key(spark, SF0001), ["seq", "is_even", "running_sum"])

    write_batch_file(replay.sentinel_row(ev, "event_time", seq=10**9, event_type="x"), folder, 50)
    st2 = replay.replay_stream(spark, folder, ev.schema)
    slid = swin.stream_window_counts(st2, "event_time", "1 hour", KE.is_registered, "0 seconds", slide="15 minutes")
    _run(slid, scratch, "slid")
    got = spark.table("slid").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_match")
    _same_rows(got, catalog.ev_sliding_count(spark, SF0001), ["window_start", "n_match"])


def test_foreach_batch_replay_is_idempotent(spark, scratch):
    """A micro-batch run again after a failure (same batch_id) rewrites the
    same output and carry: the final result equals a single clean run."""
    ev = spark.read.parquet(f"{SF0001}/events.parquet").select(
        F.col("event_id").alias("seq"), "event_type")
    out_path, carry_path = os.path.join(scratch, "o"), os.path.join(scratch, "c")
    fn = carry.global_count_trigger(out_path, carry_path, "seq", 10, F.col("event_type") == KE.registered)
    parts = [ev.where((F.col("seq") >= lo) & (F.col("seq") < lo + 250)) for lo in range(0, 1000, 250)]
    fn(parts[0], 0)
    fn(parts[1], 1)
    fn(parts[1], 1)  # replay of batch 1 (e.g. the driver died before the commit)
    fn(parts[2], 2)
    fn(parts[3], 3)
    fn(parts[3], 3)
    got = spark.read.parquet(out_path).drop("batch_id")
    _same_rows(got, catalog.ev_count_trigger(spark, SF0001), ["fire", "n_seen", "n_match"])


def test_processing_time_count_trigger(spark, scratch):
    from eventide.streaming import jobs
    ev, folder = _events_replay(spark, scratch)
    out = os.path.join(scratch, "ptct")
    q = jobs.count_trigger_job(replay.replay_stream(spark, folder, ev.schema), out, os.path.join(scratch, "cp-ptct"), kinds=KE, size="1 day",
                               n=3, available_now=True)
    q.awaitTermination(600)
    rows = spark.read.parquet(out).collect()
    per = {}
    for r in rows:
        per.setdefault(r.window_start, []).append((r.fire, r.n_seen, r.n_match))
    # a day's window goes on over the micro-batches (two windows if midnight passed)
    assert sum(map(len, per.values())) in {ev.count() // 3, ev.count() // 3 - 1}
    for fires in per.values():
        fires.sort()
        assert [f[:2] for f in fires] == [(k, 3 * k) for k in range(1, len(fires) + 1)]
        assert [f[2] for f in fires] == sorted(f[2] for f in fires)


def test_list_state_of_structs_and_strings(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    both = F.struct(F.col("seq").alias("a"), F.col("event_type").alias("b"))
    out = stateful.apply_stateful(st.select("user_id", "seq", both.alias("v")), ["user_id"],
                                  stateful.LastN(["user_id"], "seq", "v", 2, value_type="struct<a:bigint,b:string>"),
                                  "user_id long, seq long, last_n string")
    _run(out, scratch, "structs")
    text = F.array_join(F.transform("l", lambda x: F.concat_ws(":", x["a"].cast("string"), x["b"])), ",").alias("last_n")
    w = Window.partitionBy("user_id").orderBy("seq").rowsBetween(-1, 0)
    exp = ev.select("user_id", "seq", F.collect_list(both).over(w).alias("l")).select("user_id", "seq", text)
    _same_rows(spark.table("structs"), exp, ["user_id", "seq", "last_n"])


def test_read_events_stream_and_console(spark, scratch, capsys):
    from eventide.sources.events import read_events
    folder = os.path.join(scratch, "raw")
    raw = spark.read.parquet(f"{SF0001}/events.parquet")
    for i in range(2):
        write_batch_file(raw.where((F.col("event_id") % 2) == i), folder, i)
    st = read_events(spark, folder, EVENTS_TABLE_MAPPING, streaming=True, max_files_per_trigger=1)
    assert dict(st.dtypes)["event_time"] == "timestamp"  # watermark-ready
    out = swin.stream_window_counts(st, "event_time", "1 day", KE.is_registered, "0 seconds", with_total=True)
    q = sinks.start(out, os.path.join(scratch, "cp-console"), fmt="console", output_mode="update",
                    available_now=True)
    q.awaitTermination(600)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [
        raw.where("event_id % 2 = 0").count(), raw.where("event_id % 2 = 1").count()]


def test_running_totals_update_mode(spark, scratch):
    ev, folder = _events_replay(spark, scratch)
    st = replay.replay_stream(spark, folder, ev.schema)
    out = swin.running_totals(st, ["user_id"], {"n": F.lit(1), "s": F.col("seq")})
    q = _run(out, scratch, "rtot", mode="update")
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 4
    # the memory sink keeps every update; the last one per key is the total
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy(F.desc("n"))
    final = spark.table("rtot").withColumn("r", F.row_number().over(w)).where("r = 1")
    exp = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("s"))
    _same_rows(final, exp, ["user_id", "n", "s"])
