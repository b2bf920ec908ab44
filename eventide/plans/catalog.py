"""Registered queries over the driver tables, and their SQL oracles.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole ``events`` (or ``orders``) table.  ``ORACLE_SQL`` holds, for the same
names, an independent formulation in plain SQL (DuckDB dialect) over the raw
tables: window functions over the full order instead of bucketed scans,
``time_bucket`` instead of ``window()``, gaps and islands without buckets.
Output column names and types agree between the two.

Kinds in the events table: registered = signup, online = view,
offline = error, add = purchase, remove = click (``schema.EVENTS_TABLE_ROLES``).
The reference's seconds become hours here: the table holds about one event per
three minutes at sf0.01.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.exprs import divisible
from eventide.operators import best, counting, rolling, transform, watermarks, window_functions, windows
from eventide.schema import EVENTS_TABLE_TYPES, Kinds
from eventide.plans.tables import events_table
from eventide.sources.events import read_table

K = Kinds.events_table()

# Query parameters (the reference's 1 s event step is ~1 h of this table).
TUMBLE = "1 hour"
SLIDE_SIZE, SLIDE = "1 hour", "15 minutes"
NET_SIZE, NET_SLIDE = "2 hours", "1 hour"
USER_GAP, GLOBAL_GAP = "6 hours", "5 minutes"
COUNT_N, PURGE_N = 10, 10
WIN_TRIGGER_SIZE, WIN_TRIGGER_N, WIN_PURGE_N = "6 hours", 3, 2
LAST_N = 5
HIGH_QUANTITY = 3
HISTORY_PAGE = 1000
# Rows per bucket of a split key (see operators.scan) where a query's keys are few: far below
# the library's default, so that these keys are split at the driver's sizes too and the green
# rows cover the carries.  On larger tables the scan widens them (scan.MAX_BUCKETS).  Scans per
# user have the default width.
ORDER_WIDTH, TYPE_WIDTH, WINDOW_WIDTH = 2000, 500, 200
# Events reach the watermark queries in blocks of ids, the newest of a block first.
ARRIVAL_BLOCK, DELAY = 8, "10 minutes"
LABEL_REGISTERED = "players registered"


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    # Event times are naive UTC (as the oracle reads them); epoch values and
    # report strings derive from them through the session time zone.
    if (zone := spark.conf.get("spark.sql.session.timeZone")) not in ("UTC", "Etc/UTC", "GMT", "+00:00"):
        raise ValueError(f"the registered queries read naive UTC times: set spark.sql.session.timeZone to UTC, not {zone}")
    return events_table(spark, sf)


def ev_normalize(spark, sf):
    return _ev(spark, sf)


def ev_tumbling_count(spark, sf):
    return windows.window_counts(_ev(spark, sf), "event_time", TUMBLE, K.is_registered)


def ev_tumbling_count_only(spark, sf):
    return ev_tumbling_count(spark, sf).select("n_match")


def ev_tumbling_report(spark, sf):
    w = windows.with_report(ev_tumbling_count(spark, sf), "n_match", LABEL_REGISTERED)
    return w.select(windows.START, windows.END, "report")


def ev_tumbling_by_type(spark, sf):
    return windows.window_counts(_ev(spark, sf), "event_time", TUMBLE, K.is_registered,
                                 keys=["event_type"], with_total=True)


def ev_sliding_count(spark, sf):
    return windows.window_counts(_ev(spark, sf), "event_time", SLIDE_SIZE, K.is_registered, slide=SLIDE)


def _session_measures():
    return {"n_match": windows.count_measure(K.is_registered), "n_events": windows.count_measure()}


def ev_session_by_user(spark, sf):
    return windows.sessions(_ev(spark, sf), "event_time", USER_GAP, _session_measures(), keys=["user_id"])


def ev_session_global(spark, sf):
    return windows.sessions(_ev(spark, sf), "event_time", GLOBAL_GAP, _session_measures(), width=ORDER_WIDTH)


def ev_net_tumbling(spark, sf):
    return windows.net_change(_ev(spark, sf), "event_time", NET_SIZE, K.is_online, K.is_offline)


def ev_net_sliding(spark, sf):
    return windows.net_change(_ev(spark, sf), "event_time", NET_SIZE, K.is_online, K.is_offline,
                              slide=NET_SLIDE)


def ev_best_window(spark, sf):
    return best.best_window(ev_net_tumbling(spark, sf), "net", ties="first")


def ev_best_window_last(spark, sf):
    return best.best_window(ev_net_tumbling(spark, sf), "net", ties="last")


def ev_best_window_sliding(spark, sf):
    return best.best_window(ev_net_sliding(spark, sf), "net", ties="first")


def ev_best_so_far(spark, sf):
    return best.best_so_far(ev_net_tumbling(spark, sf), "net", ties="first", width=WINDOW_WIDTH)


def ev_count_trigger(spark, sf):
    return counting.count_trigger(_ev(spark, sf), "seq", COUNT_N,
                                  {"n_match": windows.count_measure(K.is_registered)}, width=ORDER_WIDTH)


def ev_count_purging(spark, sf):
    return counting.count_trigger(_ev(spark, sf), "seq", PURGE_N,
                                  {"n_match": windows.count_measure(K.is_registered)}, purge=True,
                                  width=ORDER_WIDTH)


def ev_window_count_trigger(spark, sf):
    return counting.window_count_trigger(_ev(spark, sf), "event_time", WIN_TRIGGER_SIZE, "seq",
                                         WIN_TRIGGER_N, {"n_match": windows.count_measure(K.is_add)})


def ev_window_count_purging(spark, sf):
    return counting.window_count_trigger(_ev(spark, sf), "event_time", WIN_TRIGGER_SIZE, "seq",
                                         WIN_PURGE_N, {"n_match": windows.count_measure(K.is_add)},
                                         purge=True)


def run_sum_by_key(spark, sf):
    d = _ev(spark, sf).select("seq", divisible("seq", 2).alias("is_even"))
    return rolling.running_sum_by_key(d, "seq", ["is_even"], F.col("seq"), "running_sum", width=ORDER_WIDTH)


def st_count_by_user(spark, sf):
    d = _ev(spark, sf).select("seq", "user_id")
    return rolling.running_count_by_key(d, "seq", ["user_id"])


def st_type_counts_by_user(spark, sf):
    d = _ev(spark, sf).select("seq", "user_id", "event_type")
    return rolling.type_counts_by_key(d, "seq", ["user_id"], "event_type", EVENTS_TABLE_TYPES)


def st_history_by_user(spark, sf):
    d = _ev(spark, sf).select("seq", "user_id")
    return rolling.history_pages(d, "seq", ["user_id"], "seq", page_size=HISTORY_PAGE)


def st_last5_user_type(spark, sf):
    d = _ev(spark, sf).select("seq", "user_id", "event_type")
    return rolling.last_n_by_key(d, "seq", ["user_id", "event_type"], LAST_N, "seq", "last5")


def st_last5_type(spark, sf):
    d = _ev(spark, sf).select("seq", "event_type")
    return rolling.last_n_by_key(d, "seq", ["event_type"], LAST_N, "seq", "last5", width=TYPE_WIDTH)


def st_last5_pair_by_user(spark, sf):
    d = _ev(spark, sf).select("seq", "user_id", "event_type")
    out = rolling.last_n_per_type(d, "seq", ["user_id"], "event_type",
                                  {K.add: "last5_add", K.remove: "last5_remove"}, LAST_N, "seq")
    return out.select("seq", "user_id", "last5_add", "last5_remove")


def _arriving(spark, sf):
    """Events with ``arrival``, an order of arrival other than that of their times."""
    block = F.col("seq") % ARRIVAL_BLOCK
    return _ev(spark, sf).select("seq", "event_time", "event_type", (F.col("seq") - block + (ARRIVAL_BLOCK - 1) - block).alias("arrival"))


def ev_late_dropped(spark, sf):
    late = watermarks.late_rows(_arriving(spark, sf), "event_time", "arrival", TUMBLE, watermarks.bounded("event_time", DELAY), width=ORDER_WIDTH)
    return late.select("seq", "arrival", "event_time", "watermark", windows.START, windows.END)


def ev_on_time_count(spark, sf):
    return watermarks.on_time_sums(_arriving(spark, sf), "event_time", "arrival", TUMBLE,
                                   {"n_match": windows.count_measure(K.is_registered), "n_events": windows.count_measure()},
                                   watermarks.bounded("event_time", DELAY), width=ORDER_WIDTH)


def ev_on_time_custom(spark, sf):
    """A generator of one's own: only registrations emit a watermark, their own time."""
    return watermarks.on_time_sums(_arriving(spark, sf), "event_time", "arrival", SLIDE_SIZE,
                                   {"n_match": windows.count_measure(K.is_registered), "n_events": windows.count_measure()},
                                   F.when(K.is_registered, F.col("event_time")), slide=SLIDE, width=ORDER_WIDTH)


class QuantityProfile:
    """How often each quantity occurs in a window: the most frequent one (the smaller of
    equals) and the lower median, from counts that merge."""

    def create(self) -> np.ndarray:
        return np.zeros(10, np.int64)

    def add(self, counts: np.ndarray, rows: pa.RecordBatch) -> np.ndarray:
        return counts + np.bincount(rows.column("quantity").to_numpy(), minlength=10)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + b

    def result(self, counts: np.ndarray) -> dict:
        return {"n_events": int(counts.sum()), "most_frequent": int(counts.argmax()),
                "median": int(np.searchsorted(2 * np.cumsum(counts), counts.sum()))}


def ev_quantity_profile(spark, sf):
    d = _ev(spark, sf).where(F.col("quantity").isNotNull())
    return window_functions.aggregate_windows(d, "event_time", TUMBLE, QuantityProfile(), {"quantity": F.col("quantity").cast("long")},
                                              "n_events long, most_frequent long, median long", keys=["event_type"])


def longest_streak(window: window_functions.Group, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The longest run of events of one type in the window, the first of equals."""
    best_run, kind, length, first = (0, None, None), None, 0, None
    for batch in batches:
        for seq, t in zip(batch.column("seq").to_pylist(), batch.column("event_type").to_pylist(), strict=True):
            if length and t == kind:
                length += 1
            else:
                kind, length, first = t, 1, seq
            if length > best_run[0]:
                best_run = (length, kind, first)
    yield {"length": best_run[0], "event_type": best_run[1], "first_seq": best_run[2]}


def ev_window_streak(spark, sf):
    d = _ev(spark, sf)
    return window_functions.apply_windows(d, "event_time", NET_SIZE, longest_streak, {"seq": F.col("seq"), "event_type": F.col("event_type")},
                                          "length long, event_type string, first_seq long", order=["seq"])


def ev_itemize(spark, sf):
    out = transform.itemize(_ev(spark, sf), K.is_add)
    return out.withColumn("item", F.col("item").cast("long"))


def ev_itemize_sku(spark, sf):
    return transform.itemize_to(_ev(spark, sf), K.is_add, "sku")


def ev_high_quantity(spark, sf):
    return transform.high_quantity(_ev(spark, sf), K.is_add, HIGH_QUANTITY)


def route_tags(spark, sf):
    return transform.fizzbuzz_routes(_ev(spark, sf), "seq", keep_cols=["seq"])


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey")


def seq_project(spark, sf):
    d = transform.scale(_orders(spark, sf), "o_orderkey", 2, "doubled")
    return transform.prefixed(d, "o_orderkey", "item ", "label")


def seq_filter(spark, sf):
    return transform.keep(_orders(spark, sf), divisible("o_orderkey", 2))


def seq_fanout(spark, sf):
    return transform.fan_out(_orders(spark, sf), [F.col("o_orderkey"), F.col("o_orderkey") * 1000],
                             "value", keep_cols=["o_orderkey"])


@contextlib.contextmanager
def _factor_table() -> Iterator[dict[str, int]]:
    """What a partition opens before its first batch and closes after its last."""
    opened = {"factor": 2}
    yield opened
    opened.clear()


def _double_batch(b: pa.RecordBatch, opened: dict[str, int]) -> pa.RecordBatch:
    keys = b.column("o_orderkey")
    return pa.RecordBatch.from_arrays([keys, pc.multiply(keys, opened["factor"])], names=["o_orderkey", "doubled"])


def seq_partition_map(spark, sf):
    """The map with set-up and tear-down: batches use what ``setup`` has opened."""
    return transform.partition_map(_orders(spark, sf), _double_batch, "o_orderkey long, doubled long", setup=_factor_table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        ev_normalize, ev_tumbling_count, ev_tumbling_count_only, ev_tumbling_report,
        ev_tumbling_by_type, ev_sliding_count, ev_session_by_user, ev_session_global,
        ev_net_tumbling, ev_net_sliding, ev_best_window, ev_best_window_last,
        ev_best_window_sliding, ev_best_so_far, ev_count_trigger, ev_count_purging,
        ev_window_count_trigger, ev_window_count_purging, run_sum_by_key, st_count_by_user,
        st_type_counts_by_user, st_history_by_user, st_last5_user_type, st_last5_type,
        st_last5_pair_by_user, ev_late_dropped, ev_on_time_count, ev_on_time_custom,
        ev_quantity_profile, ev_window_streak, ev_itemize, ev_itemize_sku, ev_high_quantity, route_tags,
        seq_project, seq_filter, seq_fanout, seq_partition_map,
    ]
}

# ---------------------------------------------------------------------------
# SQL oracles (DuckDB).  Raw tables only; full-order windows, no buckets.
# ---------------------------------------------------------------------------
_EV = """ev AS (SELECT event_id AS seq, ts AS event_time, event_type, user_id,
                CAST(floor(value) AS INTEGER) % 10 AS quantity, props AS sku FROM events)"""
_TB = "time_bucket(INTERVAL '{w}', ts, TIMESTAMP '1970-01-01')"


def _tb(w: str) -> str:
    return _TB.format(w=w)


def _net_sql(size: str, slide_minutes: int | None = None, k: int = 1) -> str:
    net = "sum(CASE WHEN event_type = 'view' THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END)"
    if slide_minutes is None:
        return f"""SELECT {_tb(size)} AS window_start, {_tb(size)} + INTERVAL '{size}' AS window_end,
                   CAST(greatest({net}, 0) AS BIGINT) AS net FROM events GROUP BY ALL"""
    start = f"{_tb(f'{slide_minutes} minutes')} - to_minutes({slide_minutes} * k.range)"
    return f"""SELECT {start} AS window_start, {start} + INTERVAL '{size}' AS window_end,
               CAST(greatest({net}, 0) AS BIGINT) AS net
               FROM events CROSS JOIN range(0, {k}) k GROUP BY ALL"""


def _session_sql(gap_us: int, partition: bool) -> str:
    part = "PARTITION BY user_id" if partition else ""
    key = "user_id, " if partition else ""
    return f"""WITH o AS (SELECT user_id, ts, event_type, event_id,
                          lag(ts) OVER ({part} ORDER BY ts, event_id) AS p FROM events),
               s AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > {gap_us}
                                        THEN 1 ELSE 0 END)
                               OVER ({part} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
                     FROM o)
               SELECT {key}min(ts) AS window_start,
                      max(ts) + to_microseconds({gap_us}) AS window_end,
                      count(*) FILTER (WHERE event_type = 'signup') AS n_match,
                      count(*) AS n_events
               FROM s GROUP BY {key}sid"""


_POS = """SELECT event_id, event_type, ts,
          row_number() OVER (ORDER BY event_id) AS pos,
          sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
              OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS m
          FROM events"""

_WPOS = f"""SELECT ws, pos, m, event_type FROM (
             SELECT ws, event_type,
                    row_number() OVER (PARTITION BY ws ORDER BY event_id) AS pos,
                    sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
                        OVER (PARTITION BY ws ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS m
             FROM (SELECT *, {_tb(WIN_TRIGGER_SIZE)} AS ws FROM events))"""


def _last5(part: str) -> str:
    return (f"array_to_string(list(event_id) OVER (PARTITION BY {part} ORDER BY event_id "
            f"ROWS BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW), ',')")


_ARRIVING = f"""SELECT *, event_id AS seq, ts AS event_time,
    event_id // {ARRIVAL_BLOCK} * {ARRIVAL_BLOCK} + {ARRIVAL_BLOCK - 1} - event_id % {ARRIVAL_BLOCK} AS arrival FROM events"""
_LATE = f"""WITH a AS ({_ARRIVING}),
    w AS (SELECT *, max(ts) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '{DELAY}' AS watermark,
                 {_tb(TUMBLE)} AS window_start FROM a),
    j AS (SELECT *, coalesce(watermark >= window_start + INTERVAL '{TUMBLE}' - to_microseconds(1000), false) AS late FROM w)"""

ORACLE_SQL: dict[str, str] = {
    "ev_normalize": f"WITH {_EV} SELECT * FROM ev",
    "ev_tumbling_count": f"""
        SELECT {_tb(TUMBLE)} AS window_start, {_tb(TUMBLE)} + INTERVAL '{TUMBLE}' AS window_end,
               count(*) FILTER (WHERE event_type = 'signup') AS n_match
        FROM events GROUP BY ALL""",
    "ev_tumbling_count_only": f"""
        SELECT count(*) FILTER (WHERE event_type = 'signup') AS n_match
        FROM events GROUP BY {_tb(TUMBLE)}""",
    "ev_tumbling_report": f"""
        SELECT window_start, window_end,
               format('[{{}} - {{}}] - {{}} {LABEL_REGISTERED}', epoch_ms(window_start),
                      epoch_ms(window_end), n) AS report
        FROM (SELECT {_tb(TUMBLE)} AS window_start, {_tb(TUMBLE)} + INTERVAL '{TUMBLE}' AS window_end,
                     count(*) FILTER (WHERE event_type = 'signup') AS n
              FROM events GROUP BY ALL)""",
    "ev_tumbling_by_type": f"""
        SELECT {_tb(TUMBLE)} AS window_start, {_tb(TUMBLE)} + INTERVAL '{TUMBLE}' AS window_end,
               event_type, count(*) FILTER (WHERE event_type = 'signup') AS n_match,
               count(*) AS n_events
        FROM events GROUP BY ALL""",
    "ev_sliding_count": f"""
        SELECT {_tb('15 minutes')} - to_minutes(15 * k.range) AS window_start,
               {_tb('15 minutes')} - to_minutes(15 * k.range) + INTERVAL '{SLIDE_SIZE}' AS window_end,
               count(*) FILTER (WHERE event_type = 'signup') AS n_match
        FROM events CROSS JOIN range(0, 4) k GROUP BY ALL""",
    "ev_session_by_user": _session_sql(6 * 3600 * 1_000_000, True),
    "ev_session_global": _session_sql(5 * 60 * 1_000_000, False),
    "ev_net_tumbling": _net_sql(NET_SIZE),
    "ev_net_sliding": _net_sql(NET_SIZE, 60, 2),
    "ev_best_window": f"""SELECT * FROM ({_net_sql(NET_SIZE)})
                          ORDER BY net DESC, window_start ASC LIMIT 1""",
    "ev_best_window_last": f"""SELECT * FROM ({_net_sql(NET_SIZE)})
                               ORDER BY net DESC, window_start DESC LIMIT 1""",
    "ev_best_window_sliding": f"""SELECT * FROM ({_net_sql(NET_SIZE, 60, 2)})
                                  ORDER BY net DESC, window_start ASC LIMIT 1""",
    "ev_best_so_far": f"""
        WITH w AS ({_net_sql(NET_SIZE)}),
             r AS (SELECT *, max(net) OVER (ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS rm FROM w)
        SELECT window_start, min(window_start) OVER (PARTITION BY rm) AS best_start,
               min(window_start) OVER (PARTITION BY rm) + INTERVAL '{NET_SIZE}' AS best_end,
               rm AS best_net
        FROM r""",
    "ev_count_trigger": f"""
        SELECT CAST(pos // {COUNT_N} AS BIGINT) AS fire, CAST(pos AS BIGINT) AS n_seen,
               CAST(m AS BIGINT) AS n_match
        FROM ({_POS}) WHERE pos % {COUNT_N} = 0""",
    "ev_count_purging": f"""
        SELECT CAST((pos - 1) // {PURGE_N} + 1 AS BIGINT) AS fire, count(*) AS n_seen,
               count(*) FILTER (WHERE event_type = 'signup') AS n_match
        FROM ({_POS}) GROUP BY (pos - 1) // {PURGE_N} HAVING count(*) = {PURGE_N}""",
    "ev_window_count_trigger": f"""
        SELECT ws AS window_start, ws + INTERVAL '{WIN_TRIGGER_SIZE}' AS window_end,
               CAST(pos // {WIN_TRIGGER_N} AS BIGINT) AS fire, CAST(pos AS BIGINT) AS n_seen,
               CAST(m AS BIGINT) AS n_match
        FROM ({_WPOS}) WHERE pos % {WIN_TRIGGER_N} = 0""",
    "ev_window_count_purging": f"""
        SELECT ws AS window_start, ws + INTERVAL '{WIN_TRIGGER_SIZE}' AS window_end,
               CAST((pos - 1) // {WIN_PURGE_N} + 1 AS BIGINT) AS fire, count(*) AS n_seen,
               count(*) FILTER (WHERE event_type = 'purchase') AS n_match
        FROM ({_WPOS}) GROUP BY ws, (pos - 1) // {WIN_PURGE_N} HAVING count(*) = {WIN_PURGE_N}""",
    "run_sum_by_key": """
        SELECT event_id AS seq, event_id % 2 = 0 AS is_even,
               CAST(sum(event_id) OVER (PARTITION BY event_id % 2 = 0 ORDER BY event_id
                                        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_sum
        FROM events""",
    "st_count_by_user": """
        SELECT event_id AS seq, user_id,
               count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n_events
        FROM events""",
    "st_type_counts_by_user": "SELECT event_id AS seq, user_id, event_type, " + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{t}') OVER (PARTITION BY user_id ORDER BY event_id "
        f"ROWS UNBOUNDED PRECEDING) AS n_{t}" for t in EVENTS_TABLE_TYPES) + " FROM events",
    "st_history_by_user": f"""
        SELECT user_id, CAST((rn - 1) // {HISTORY_PAGE} AS BIGINT) AS page,
               min(event_id) AS first_seq, max(event_id) AS last_seq, count(*) AS n_events,
               string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS history
        FROM (SELECT user_id, event_id,
                     row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        GROUP BY user_id, (rn - 1) // {HISTORY_PAGE}""",
    "st_last5_user_type": f"""
        SELECT event_id AS seq, user_id, event_type, {_last5('user_id, event_type')} AS last5
        FROM events""",
    "st_last5_type": f"""
        SELECT event_id AS seq, event_type, {_last5('event_type')} AS last5 FROM events""",
    "st_last5_pair_by_user": f"""
        WITH a AS (SELECT event_id, user_id, event_type, {_last5('user_id, event_type')} AS l5 FROM events)
        SELECT event_id AS seq, user_id,
               last_value(CASE WHEN event_type = 'purchase' THEN l5 END IGNORE NULLS)
                   OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last5_add,
               last_value(CASE WHEN event_type = 'click' THEN l5 END IGNORE NULLS)
                   OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last5_remove
        FROM a""",
    "ev_late_dropped": f"""
        {_LATE}
        SELECT seq, arrival, event_time, watermark, window_start, window_start + INTERVAL '{TUMBLE}' AS window_end
        FROM j WHERE late""",
    "ev_on_time_count": f"""
        {_LATE}
        SELECT window_start, window_start + INTERVAL '{TUMBLE}' AS window_end,
               count(*) FILTER (NOT late AND event_type = 'signup') AS n_match, count(*) FILTER (NOT late) AS n_events,
               count(*) FILTER (late) AS n_late
        FROM j GROUP BY ALL HAVING count(*) FILTER (NOT late) > 0""",
    "ev_on_time_custom": f"""
        WITH a AS ({_ARRIVING}),
        w AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN ts END)
                        OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM a),
        e AS (SELECT *, {_tb(SLIDE)} - to_minutes(15 * k.range) AS window_start FROM w CROSS JOIN range(0, 4) k),
        j AS (SELECT *, coalesce(watermark >= window_start + INTERVAL '{SLIDE_SIZE}' - to_microseconds(1000), false) AS late FROM e)
        SELECT window_start, window_start + INTERVAL '{SLIDE_SIZE}' AS window_end,
               count(*) FILTER (NOT late AND event_type = 'signup') AS n_match, count(*) FILTER (NOT late) AS n_events,
               count(*) FILTER (late) AS n_late
        FROM j GROUP BY ALL HAVING count(*) FILTER (NOT late) > 0""",
    "ev_quantity_profile": f"""
        WITH {_EV},
        c AS (SELECT time_bucket(INTERVAL '{TUMBLE}', event_time, TIMESTAMP '1970-01-01') AS window_start, event_type, quantity, count(*) AS n
              FROM ev WHERE quantity IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY window_start, event_type ORDER BY n DESC, quantity) AS place,
                     sum(n) OVER (PARTITION BY window_start, event_type ORDER BY quantity) AS below,
                     sum(n) OVER (PARTITION BY window_start, event_type) AS total FROM c)
        SELECT window_start, window_start + INTERVAL '{TUMBLE}' AS window_end, event_type, CAST(sum(n) AS BIGINT) AS n_events,
               CAST(max(quantity) FILTER (place = 1) AS BIGINT) AS most_frequent,
               CAST(min(quantity) FILTER (2 * below >= total) AS BIGINT) AS median
        FROM r GROUP BY window_start, event_type""",
    "ev_window_streak": f"""
        WITH o AS (SELECT {_tb(NET_SIZE)} AS window_start, event_id, event_type FROM events),
        g AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY event_id)
                        - row_number() OVER (PARTITION BY window_start, event_type ORDER BY event_id) AS run FROM o),
        s AS (SELECT window_start, event_type, count(*) AS length, min(event_id) AS first_seq FROM g GROUP BY window_start, event_type, run)
        SELECT window_start, window_start + INTERVAL '{NET_SIZE}' AS window_end, length, event_type, first_seq
        FROM s QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY length DESC, first_seq) = 1""",
    "ev_itemize": f"""
        WITH {_EV}
        SELECT seq, user_id, sku, event_time, unnest(range(1, quantity + 1)) AS item, 1 AS quantity
        FROM ev WHERE event_type = 'purchase' AND quantity > 0""",
    "ev_itemize_sku": f"""
        WITH {_EV}
        SELECT sku FROM (SELECT sku, unnest(range(quantity)) AS i FROM ev
                         WHERE event_type = 'purchase' AND quantity > 0)""",
    "ev_high_quantity": f"""
        WITH {_EV}
        SELECT sku, CAST(quantity AS BIGINT) AS quantity FROM ev
        WHERE event_type = 'purchase' AND quantity > {HIGH_QUANTITY}""",
    "route_tags": """
        SELECT event_id AS seq, 'fizz_and_buzz' AS route,
               CASE WHEN event_id % 3 = 0 THEN 'fizz' WHEN event_id % 5 = 0 THEN 'buzz' ELSE '' END AS tag
        FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 0
        UNION ALL
        SELECT event_id AS seq, 'fizzbuzz' AS route, 'fizzbuzz' AS tag
        FROM events WHERE event_id % 3 = 0 AND event_id % 5 = 0""",
    "seq_project": """
        SELECT o_orderkey, o_orderkey * 2 AS doubled, 'item ' || CAST(o_orderkey AS VARCHAR) AS label
        FROM orders""",
    "seq_filter": "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0",
    "seq_fanout": """
        SELECT o_orderkey, unnest([o_orderkey, o_orderkey * 1000]) AS value FROM orders""",
    "seq_partition_map": "SELECT o_orderkey, o_orderkey * 2 AS doubled FROM orders",
}
