"""Known answers on the 18 server events, the 1..100 sequence and small cart lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import best, counting, rolling, transform, windows
from eventide.schema import Kinds
from eventide.sources.events import number_sequence
from tests.fixtures import ADD, BASE_MS, REMOVE, cart_events, secs, server_events

K = Kinds.domain()


def _by_start(df, col="n_match"):
    return {secs(r[windows.START]): r[col] for r in df.collect()}


def test_tumbling_registrations(spark):
    out = windows.window_counts(server_events(spark), "event_time", "3 seconds", K.is_registered)
    assert _by_start(out) == {0: 1, 3: 3, 6: 2, 9: 0, 12: 0}


def test_tumbling_report_matches_reference_format(spark):
    out = windows.with_report(
        windows.window_counts(server_events(spark), "event_time", "3 seconds", K.is_registered),
        "n_match", "players registered")
    reports = {r.report for r in out.collect()}
    assert f"[{BASE_MS + 3000} - {BASE_MS + 6000}] - 3 players registered" in reports


def test_sliding_registrations(spark):
    out = windows.window_counts(server_events(spark), "event_time", "3 seconds", K.is_registered,
                                slide="1 second")
    got = _by_start(out)
    assert got == dict(zip(range(0, 13), [1, 2, 4, 3, 3, 1, 2, 1, 1, 0, 0, 0, 0]))


def test_sliding_generic_path(spark):
    # size not a multiple of slide -> native sliding window(); check by brute force
    from tests.fixtures import SERVER_EVENTS
    out = windows.window_counts(server_events(spark), "event_time", "3 seconds", K.is_registered,
                                slide="2 seconds", with_total=True)
    got = {secs(r.window_start): (r.n_match, r.n_events) for r in out.collect()}
    exp = {}
    for start in range(-2, 14, 2):
        inside = [k for s, k, _ in SERVER_EVENTS if start <= s < start + 3]
        if inside:
            exp[start] = (sum(k == K.registered for k in inside), len(inside))
    assert got == exp


def test_session_registrations(spark):
    out = windows.sessions(server_events(spark), "event_time", "1 second",
                           {"n_match": windows.count_measure(K.is_registered)})
    got = {(secs(r.window_start), secs(r.window_end)): r.n_match for r in out.collect()}
    assert got == {(2, 5): 4, (6, 13): 2}


def test_session_small_buckets_same_answer(spark):
    out = windows.sessions(server_events(spark), "event_time", "1 second",
                           {"n_match": windows.count_measure(K.is_registered)}, width=2)
    got = {(secs(r.window_start), secs(r.window_end)): r.n_match for r in out.collect()}
    assert got == {(2, 5): 4, (6, 13): 2}


def test_tumbling_by_type(spark):
    out = windows.window_counts(server_events(spark), "event_time", "3 seconds", K.is_registered,
                                keys=["event_type"], with_total=True)
    got = {(secs(r.window_start), r.event_type): (r.n_match, r.n_events) for r in out.collect()}
    short = {K.registered: "Registered", K.online: "Online", K.offline: "Offline"}
    got = {(s, short[t]): v for (s, t), v in got.items()}
    assert got == {
        (0, "Online"): (0, 1), (0, "Registered"): (1, 1), (3, "Online"): (0, 1),
        (3, "Registered"): (3, 3), (6, "Offline"): (0, 2), (6, "Online"): (0, 1),
        (6, "Registered"): (2, 2), (9, "Offline"): (0, 2), (9, "Online"): (0, 3),
        (12, "Offline"): (0, 2)}


def test_net_players(spark):
    ev = server_events(spark)
    tumb = windows.net_change(ev, "event_time", "2 seconds", K.is_online, K.is_offline)
    assert _by_start(tumb, "net") == {2: 1, 4: 1, 6: 0, 8: 0, 10: 2, 12: 0}
    slid = windows.net_change(ev, "event_time", "2 seconds", K.is_online, K.is_offline, slide="1 second")
    assert _by_start(slid, "net") == dict(zip(range(1, 13), [1, 1, 1, 1, 0, 0, 0, 0, 2, 2, 0, 0]))


def test_best_window(spark):
    ev = server_events(spark)
    tumb = windows.net_change(ev, "event_time", "2 seconds", K.is_online, K.is_offline)
    b = best.best_window(tumb).collect()
    assert len(b) == 1
    r = b[0]
    assert (secs(r.window_start), secs(r.window_end), r.net) == (10, 12, 2)
    slid = windows.net_change(ev, "event_time", "2 seconds", K.is_online, K.is_offline, slide="1 second")
    assert secs(best.best_window(slid, ties="first").first().window_start) == 9
    assert secs(best.best_window(slid, ties="last").first().window_start) == 10


def test_best_so_far(spark):
    ev = server_events(spark)
    tumb = windows.net_change(ev, "event_time", "2 seconds", K.is_online, K.is_offline)
    out = best.best_so_far(tumb, width=2).orderBy("window_start").collect()
    got = [(secs(r.window_start), secs(r.best_start), r.best_net) for r in out]
    # nets 1, 1, 0, 0, 2, 0 at starts 2..12: first max wins, so 2 stays best until 10
    assert got == [(2, 2, 1), (4, 2, 1), (6, 2, 1), (8, 2, 1), (10, 10, 2), (12, 10, 2)]


def test_count_trigger_cumulative(spark):
    # small buckets (4 rows each) so the carry between buckets is exercised
    out = counting.count_trigger(server_events(spark), "seq", 2,
                                 {"n_match": windows.count_measure(K.is_registered)},
                                 width=4)
    got = [r.n_match for r in out.orderBy("fire").collect()]
    assert got == [1, 2, 4, 5, 5, 6, 6, 6, 6]


def test_count_trigger_purging(spark):
    out = counting.count_trigger(server_events(spark), "seq", 4,
                                 {"n_match": windows.count_measure(K.is_registered)}, purge=True)
    got = [(r.fire, r.n_seen, r.n_match) for r in out.orderBy("fire").collect()]
    # groups of 4 in arrival order; the tail of 2 never fires
    assert got == [(1, 4, 2), (2, 4, 3), (3, 4, 1), (4, 4, 0)]
    part = counting.count_trigger(server_events(spark), "seq", 4,
                                  {"n_match": windows.count_measure(K.is_registered)}, purge=True,
                                  emit_partial=True)
    assert part.count() == 5


def test_window_count_trigger(spark):
    # 5 s windows, fire every 3rd element inside the window
    out = counting.window_count_trigger(server_events(spark), "event_time", "5 seconds", "seq", 3,
                                        {"n_match": windows.count_measure(K.is_registered)})
    got = [(secs(r.window_start), r.n_seen, r.n_match) for r in out.orderBy("window_start", "fire").collect()]
    # window [0,5): seq 1..6 -> fires at 3 (2 regs) and 6 (4 regs); [5,10): seq 7..12 -> 3 (1), 6 (2)
    # [10,15): seq 13..18 -> 3 (0), 6 (0)
    assert got == [(0, 3, 2), (0, 6, 4), (5, 3, 1), (5, 6, 2), (10, 3, 0), (10, 6, 0)]


def test_rolling_sum_by_parity(spark):
    nums = number_sequence(spark, 1, 100).withColumn("is_even", (F.col("n") % 2) == 0)
    out = rolling.running_sum_by_key(nums, "n", ["is_even"], F.col("n"), width=7)
    rows = {r.n: r.running_sum for r in out.collect()}
    assert [rows[2], rows[4], rows[6]] == [2, 6, 12]
    assert [rows[1], rows[3], rows[5]] == [1, 4, 9]
    assert rows[100] == 2550 and rows[99] == 2500


def test_fizzbuzz_tags_and_routes(spark):
    nums = number_sequence(spark, 1, 100)
    routed = transform.fizzbuzz_routes(nums, "n", keep_cols=["n"])
    counts = {(r.route, r.tag): r["count"] for r in routed.groupBy("route", "tag").count().collect()}
    assert counts == {("fizz_and_buzz", "fizz"): 33, ("fizz_and_buzz", "buzz"): 14,
                      ("fizzbuzz", "fizzbuzz"): 6}
    doc = nums.select(transform.tag(transform.fizzbuzz_rules("n", first_match=False)).alias("t"))
    c = {r.t: r["count"] for r in doc.groupBy("t").count().collect()}
    assert c["fizzbuzz"] == 6 and c["fizz"] == 27 and c["buzz"] == 14


def test_map_filter_fanout(spark):
    nums = number_sequence(spark, 1, 5)
    assert [r.x for r in transform.scale(nums, "n", 2, "x").orderBy("n").collect()] == [2, 4, 6, 8, 10]
    assert [r.s for r in transform.prefixed(nums, "n", "n=", "s").orderBy("n").collect()][0] == "n=1"
    assert transform.keep(nums, (F.col("n") % 2) == 0).count() == 2
    fan = transform.fan_out(nums, [F.col("n"), F.col("n") * 1000], "v", keep_cols=["n"])
    assert sorted(r.v for r in fan.where("n = 2").collect()) == [2, 2000]


def test_itemize(spark):
    ev = cart_events(spark, [(ADD, "u", "iphone", 2), (ADD, "u", "cable", 3), (ADD, "u", "case", 0),
                             (REMOVE, "u", "cable", 4)])
    items = transform.itemize(ev, K.is_add, keep_cols=("seq", "sku"))
    assert sorted((r.sku, r.item, r.quantity) for r in items.collect()) == [
        ("cable", 1, 1), ("cable", 2, 1), ("cable", 3, 1), ("iphone", 1, 1), ("iphone", 2, 1)]
    skus = transform.itemize_to(ev, K.is_add, "sku")
    assert sorted(r.sku for r in skus.collect()) == ["cable", "cable", "cable", "iphone", "iphone"]


def test_high_quantity_thresholds(spark):
    ev = cart_events(spark, [(ADD, "u", "a", 0), (ADD, "u", "b", 1), (ADD, "u", "c", 3),
                             (ADD, "u", "d", 4), (REMOVE, "u", "e", 9)])
    assert sorted(r.quantity for r in transform.high_quantity(ev, K.is_add, 0).collect()) == [1, 3, 4]
    out = transform.high_quantity(ev, K.is_add, 3)
    assert [(r.sku, r.quantity) for r in out.collect()] == [("d", 4)]
    assert dict(out.dtypes)["quantity"] == "bigint"


def test_last5_lengths(spark):
    ev = cart_events(spark, [(ADD, "u", f"s{i}", 1) for i in range(1, 8)])
    out = rolling.last_n_by_key(ev, "seq", ["user_id", "event_type"], 5, "seq", "last5", as_text=False,
                                width=2)
    rows = [r.last5 for r in out.orderBy("seq").collect()]
    assert [len(x) for x in rows] == [1, 2, 3, 4, 5, 5, 5]
    assert rows[-1] == [3, 4, 5, 6, 7]


def test_last5_pair_null_for_unseen_type(spark):
    ev = cart_events(spark, [(ADD, "u", "a", 1), (ADD, "u", "b", 1), (REMOVE, "u", "c", 1),
                             (ADD, "v", "d", 1)])
    out = rolling.last_n_per_type(ev, "seq", ["user_id"], "event_type", {ADD: "adds", REMOVE: "removes"},
                                  5, "seq", width=2)
    got = [(r.seq, r.adds, r.removes) for r in out.orderBy("seq").collect()]
    assert got == [(1, "1", None), (2, "1,2", None), (3, "1,2", "3"), (4, "4", None)]


def test_type_counts_and_running_count(spark):
    ev = cart_events(spark, [(ADD, "u", "a", 1), (REMOVE, "u", "a", 1), (ADD, "u", "b", 1),
                             (ADD, "v", "c", 1)])
    out = rolling.type_counts_by_key(ev, "seq", ["user_id"], "event_type", [ADD, REMOVE], prefix="n_")
    got = [(r.seq, r[f"n_{ADD}"], r[f"n_{REMOVE}"]) for r in out.orderBy("seq").collect()]
    assert got == [(1, 1, 0), (2, 1, 1), (3, 2, 1), (4, 1, 0)]
    cnt = rolling.running_count_by_key(ev, "seq", ["user_id"])
    assert [r.n_events for r in cnt.orderBy("seq").collect()] == [1, 2, 3, 1]


def test_history_pages(spark):
    ev = cart_events(spark, [(ADD, "u", str(i), 1) for i in range(7)])
    out = rolling.history_pages(ev, "seq", ["user_id"], "seq", page_size=3).orderBy("page").collect()
    assert [r.history for r in out] == ["1,2,3", "4,5,6", "7"]
    assert [r.n_events for r in out] == [3, 3, 1]


def test_partition_map_setup_teardown(spark, scratch):
    import os

    import pyarrow.compute as pc

    marker = os.path.join(scratch, "opened")

    class Hooks:
        def __enter__(self):
            open(marker + str(os.getpid()), "w").close()

        def __exit__(self, *a):
            return False

    nums = number_sequence(spark, 1, 10)
    out = transform.partition_map(
        nums, lambda b, _: b.__class__.from_arrays([b.column(0), pc.multiply(b.column(0), 2)], names=["n", "x"]),
        "n long, x long", setup=Hooks)
    assert sorted(r.x for r in out.collect()) == [2 * i for i in range(1, 11)]
    assert any(f.startswith("opened") for f in os.listdir(scratch))


def test_player_identity_and_game_type_check(spark):
    import pytest as _pt
    from pyspark.errors import PySparkException

    from eventide.sources.events import server_events as with_identity
    ev = with_identity(server_events(spark))
    ids = {r.identity for r in ev.where("seq = 1").collect()}
    assert ids == {"player|bob|Bob"}
    lfg = ev.limit(1).withColumn("nickname", F.lit(None).cast("string"))
    assert lfg.select(__import__("eventide.functions.exprs", fromlist=["x"]).player_identity()).first()[0] \
        == "player|bob"
    bad = server_events(spark).limit(1).withColumn("game_type", F.lit("Solo"))
    with _pt.raises(PySparkException):
        with_identity(bad).collect()


def test_last_n_keeps_null_values(spark):
    from eventide.operators import scan
    ev = cart_events(spark, [(ADD, "u", f"s{i}", 1) for i in range(1, 5)]).withColumn(
        "v", F.when(F.col("seq") == 2, F.lit(None)).otherwise(F.col("seq")))
    out = scan.last_n(ev, "seq", 3, F.col("v"), "l", keys=["user_id"], width=2)
    assert [r.l for r in out.orderBy("seq").collect()] == [[1], [1, None], [1, None, 3], [None, 3, 4]]
