"""Ready-made streaming jobs: one per runnable program of the reference.

Each function takes a streaming DataFrame of canonical events (from
``sources.events.read_events(..., streaming=True)``), an output folder and a
checkpoint folder on shared storage, and returns the started
``StreamingQuery``.  Options default to the reference's settings (window
sizes, n, thresholds).  ``available_now=True`` processes what is there and stops;
windows that no later event has closed stay open for the next start
(``best_window_replay`` reports a finished set of events to its end).

============================  =============================================
reference program             job
============================  =============================================
rolling reduce by parity      ``rolling_sum_job``
count per user                ``count_by_user_job``
counts per type and user      ``type_counts_job``
last 5 events of a type       ``last5_type_job``
map with open/close           ``doubled_job``
net players + best window     ``best_window_job``
processing-time windows       ``processing_time_job``
count trigger in windows      ``count_trigger_job``
last 5 adds/removes per user  ``last5_pair_job``
checkpointed high quantity    ``high_quantity_job``
two-file fizz/buzz            ``fizzbuzz_job``
============================  =============================================
"""

from __future__ import annotations

import os
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators import best, transform, windows
from eventide.schema import Kinds
from eventide.streaming import carry, rolling, sinks, stateful
from eventide.streaming import windows as swin


def _start(df: DataFrame, out: str, checkpoint: str, available_now: bool, interval: str = "5 seconds",
           mode: str = "append", foreach_batch=None) -> StreamingQuery:
    return sinks.start(df, checkpoint, fmt="parquet", path=None if foreach_batch else out, output_mode=mode,
                       interval=interval, available_now=available_now, foreach_batch=foreach_batch)


def _rolling_job(events: DataFrame, checkpoint: str, available_now: bool, fn) -> StreamingQuery:
    return _start(events, "", os.path.join(checkpoint, "query"), available_now, foreach_batch=fn)


def rolling_sum_job(events: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Running sum of ``seq`` per parity key, one row per event.  Both keys are hot, so the
    sums come from scans with a carry (``streaming.rolling``)."""
    d = events.select("seq", ((F.col("seq") % 2) == 0).alias("is_even"))
    fn = rolling.running_sums(out, os.path.join(checkpoint, "state"), "seq", {"running_sum": F.col("seq")}, ["is_even"])
    return _rolling_job(d, checkpoint, available_now, fn)


def count_by_user_job(events: DataFrame, out: str, checkpoint: str, key: str = "user_id", available_now: bool = False) -> StreamingQuery:
    """Per user and event: the number of the user's events so far, however hot a user is."""
    fn = rolling.running_sums(out, os.path.join(checkpoint, "state"), "seq", {"n_events": F.lit(1)}, [key])
    return _rolling_job(events.select("seq", key), checkpoint, available_now, fn)


def type_counts_job(events: DataFrame, out: str, checkpoint: str, types: Sequence[str], key: str = "user_id",
                    available_now: bool = False) -> StreamingQuery:
    """Per user and event: the number of the user's events of each type so far."""
    fn = rolling.type_counts(out, os.path.join(checkpoint, "state"), "seq", [key], "event_type", types)
    return _rolling_job(events.select("seq", key, "event_type"), checkpoint, available_now, fn)


def last5_type_job(events: DataFrame, out: str, checkpoint: str, n: int = 5, available_now: bool = False) -> StreamingQuery:
    """Per event: the last n events of its type.  A handful of keys, so all of them are hot."""
    fn = rolling.last_n(out, os.path.join(checkpoint, "state"), "seq", ["event_type"], n, "seq", "last5")
    return _rolling_job(events.select("seq", "event_type"), checkpoint, available_now, fn)


def _double(b: pa.RecordBatch, *_opened) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column("seq"), pc.multiply(b.column("seq"), 2)], names=["seq", "doubled"])


def doubled_job(events: DataFrame, out: str, checkpoint: str, available_now: bool = False,
                setup=None) -> StreamingQuery:
    """``x * 2`` through a per-partition Arrow map; ``setup`` (a context
    manager factory) runs around each partition: the open/close hooks."""
    res = transform.partition_map(events.select("seq"), _double, "seq long, doubled long", setup=setup)
    return _start(res, out, checkpoint, available_now)


def best_window_job(events: DataFrame, out: str, checkpoint: str, kinds: Kinds | None = None,
                    size: str = "2 seconds", delay: str = "1 second",
                    available_now: bool = False) -> StreamingQuery:
    """Net players (online - offline, floored at 0) per tumbling window and,
    for every closed window, the best window so far (first of ties)."""
    k = kinds or Kinds.domain()
    net = swin.stream_net_change(events, "event_time", size, k.is_online, k.is_offline, delay)
    fn = carry.best_window_so_far(os.path.join(out, "best"), os.path.join(checkpoint, "carry"))
    return _start(net, out, os.path.join(checkpoint, "query"), available_now, foreach_batch=fn)


def best_window_replay(events: DataFrame, out: str, kinds: Kinds | None = None, size: str = "2 seconds",
                       ties: str = "first") -> None:
    """The whole report of a finished set of events (a batch DataFrame): what
    ``best_window_job`` writes, the last windows included, under ``out/best``."""
    k = kinds or Kinds.domain()
    net = windows.net_change(events, "event_time", size, k.is_online, k.is_offline)
    best.best_so_far(net, "net", ties=ties).write.mode("overwrite").parquet(os.path.join(out, "best"))


def processing_time_job(events: DataFrame, out: str, checkpoint: str, kinds: Kinds | None = None,
                        size: str = "3 seconds", available_now: bool = False) -> StreamingQuery:
    """Add-to-cart events per processing-time window (runs differ by design).
    Each micro-batch writes the windows that it changed to ``out/batch_id=<n>``;
    ``streaming.windows.latest_windows`` reads the last state of each.  Closed
    windows leave the state."""
    k = kinds or Kinds.domain()
    res = swin.processing_time_windows(events, size, {"n_match": F.when(k.is_add, 1).otherwise(0)})
    return _start(res, out, checkpoint, available_now, mode="update", foreach_batch=sinks.batch_writer(out))


def count_trigger_job(events: DataFrame, out: str, checkpoint: str, kinds: Kinds | None = None,
                      size: str = "5 seconds", n: int = 3, purge: bool = False,
                      available_now: bool = False) -> StreamingQuery:
    """Every n-th event of each processing-time window: add events so far in
    the window (or in the last n events with ``purge``).  The rows of a
    micro-batch are counted by as many tasks as they need."""
    k = kinds or Kinds.domain()
    fn = carry.window_count_trigger(out, os.path.join(checkpoint, "carry"), "seq", n, k.is_add, purge=purge)
    return _start(swin.processing_time_stamped(events, size), out, os.path.join(checkpoint, "query"), available_now, foreach_batch=fn)


def last5_pair_job(events: DataFrame, out: str, checkpoint: str, kinds: Kinds | None = None,
                   key: str = "user_id", n: int = 5, available_now: bool = False) -> StreamingQuery:
    """Per user and event: the last n adds and the last n removes."""
    k = kinds or Kinds.domain()
    d = events.select("seq", key, "event_type")
    res = stateful.apply_stateful(
        d, [key], stateful.LastNPerType([key], "seq", "event_type", "seq", {k.add: "last_add", k.remove: "last_remove"}, n),
        f"{key} {dict(d.dtypes)[key]}, seq long, last_add string, last_remove string")
    return _start(res, out, checkpoint, available_now)


def high_quantity_job(events: DataFrame, out: str, checkpoint: str, kinds: Kinds | None = None,
                      threshold: int = 3, interval: str = "5 seconds",
                      available_now: bool = False) -> StreamingQuery:
    """Add events with quantity above the threshold as (sku, quantity), with a
    checkpoint every ``interval`` (progress reported to listeners)."""
    k = kinds or Kinds.domain()
    res = transform.high_quantity(events, k.is_add, threshold)
    return _start(res, out, checkpoint, available_now, interval=interval)


def fizzbuzz_job(events: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Tags by divisibility of ``seq``, written to one folder per route."""
    return _start(events, out, checkpoint, available_now,
                  foreach_batch=sinks.route_writer(transform.fizzbuzz_route_map("seq"), out))
