"""Windows on streams: event time with watermarks, and processing time.

The same window operators as the batch side, with a watermark in front:
``withWatermark(time, delay)`` is the bounded-out-of-orderness strategy (the
watermark is the max event time seen minus the delay), evaluated per
micro-batch.  Rows later than the watermark are dropped by the window
aggregate and counted in the query progress (``numRowsDroppedByWatermark``),
which is the default of the reference too: no allowed lateness, no side output.

Sliding windows in append mode are two chained aggregations (``stream_sliding_sums``); in
update mode, which allows one aggregation only, they use Spark's own
``window(t, size, slide)``.  Spark's session windows on a stream need a key (a global one is
refused, and a constant key would be one task); sessions of the whole stream, and windows
under a watermark that moves with every event, are in ``streaming.event_time``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.exprs import duration_us
from eventide.operators.windows import END, START, count_measure, net_measure


def with_watermark(stream: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Bounded out-of-orderness: watermark = max(time) - delay.  A zero delay
    is a watermark equal to the newest event (source-emitted watermark)."""
    return stream.withWatermark(time_col, delay)


def stream_window_sums(stream: DataFrame, time_col: str, size: str, measures: Mapping[str, Column],
                       delay: str, slide: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Watermarked tumbling/sliding window sums; use output mode ``append``
    (each window once, when the watermark passes its end) or ``update``."""
    w = F.window(time_col, size, slide) if slide and duration_us(slide) != duration_us(size) \
        else F.window(time_col, size)
    g = (with_watermark(stream, time_col, delay)
         .groupBy(w.alias("_w"), *keys)
         .agg(*[F.sum(e).cast("long").alias(n) for n, e in measures.items()]))
    return g.select(F.col("_w.start").alias(START), F.col("_w.end").alias(END), *keys, *measures)


def stream_sliding_sums(stream: DataFrame, time_col: str, size: str, slide: str, measures: Mapping[str, Column],
                        delay: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sliding window sums without expanding rows, for output mode ``append``: a first
    aggregation makes slide-sized windows (one state row per key and slide, a hot window is
    one partial row per task), and a second one, over their ``window_time``, adds each to the
    size / slide windows that it is part of.  Equal to ``stream_window_sums`` with a slide."""
    if duration_us(size) % duration_us(slide):
        raise ValueError("the slide must divide the size; else use stream_window_sums")
    keys = list(keys)
    pre = (with_watermark(stream, time_col, delay).groupBy(F.window(time_col, slide).alias("_b"), *keys)
           .agg(*[F.sum(e).cast("long").alias(n) for n, e in measures.items()]))
    g = pre.groupBy(F.window(F.window_time("_b"), size, slide).alias("_w"), *keys).agg(*[F.sum(n).cast("long").alias(n) for n in measures])
    return g.select(F.col("_w.start").alias(START), F.col("_w.end").alias(END), *keys, *measures)


def stream_window_counts(stream: DataFrame, time_col: str, size: str, match: Column, delay: str,
                         slide: str | None = None, keys: Sequence[str] = (),
                         with_total: bool = False) -> DataFrame:
    m = {"n_match": count_measure(match)}
    if with_total:
        m["n_events"] = count_measure()
    return stream_window_sums(stream, time_col, size, m, delay, slide=slide, keys=keys)


def stream_net_change(stream: DataFrame, time_col: str, size: str, plus: Column, minus: Column,
                      delay: str, slide: str | None = None, floor_at: int | None = 0) -> DataFrame:
    out = stream_window_sums(stream, time_col, size, {"net": net_measure(plus, minus)}, delay, slide=slide)
    if floor_at is not None:
        out = out.withColumn("net", F.greatest(F.col("net"), F.lit(floor_at).cast("long")))
    return out


def stream_sessions(stream: DataFrame, time_col: str, gap: str, measures: Mapping[str, Column],
                    delay: str, keys: Sequence[str]) -> DataFrame:
    """Session windows per key on a stream (append mode emits a session once the
    watermark passes its end)."""
    keys = list(keys)
    if not keys:
        raise ValueError("a stream's sessions need a key; without one use event_time.global_sessions")
    g = with_watermark(stream, time_col, delay).groupBy(F.session_window(time_col, gap).alias("_w"), *keys).agg(
        *[F.sum(e).cast("long").alias(n) for n, e in measures.items()])
    return g.select(*keys, F.col("_w.start").alias(START), F.col("_w.end").alias(END), *measures)


def processing_time_windows(stream: DataFrame, size: str, measures: Mapping[str, Column],
                            stamp: str = "processing_time") -> DataFrame:
    """Tumbling windows on arrival (processing) time: every row is stamped
    with the micro-batch's ``current_timestamp()`` and windowed on it.  Runs
    differ by design.  Use output mode ``update`` (a window's row each time it
    changes; ``latest_windows`` reads the last one) or ``append`` (each window once,
    closed).  The arrival time is its own watermark, so closed windows leave the state."""
    stamped = stream.withColumn(stamp, F.current_timestamp()).withWatermark(stamp, "0 seconds")
    g = stamped.groupBy(F.window(stamp, size).alias("_w")).agg(
        *[F.sum(e).cast("long").alias(n) for n, e in measures.items()])
    return g.select(F.col("_w.start").alias(START), F.col("_w.end").alias(END), *measures)


def latest_windows(updates: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Of the rows that ``update`` mode has written per micro-batch, each window's last."""
    others = [c for c in updates.columns if c not in (START, END, batch)]
    last = updates.groupBy(START, END).agg(F.max(F.struct(batch, *others)).alias("_r"))
    return last.select(START, END, *[F.col(f"_r.`{c}`") for c in others])


def processing_time_stamped(stream: DataFrame, size: str, stamp: str = "processing_time") -> DataFrame:
    """The rows with the processing-time window of their micro-batch, for
    ``carry.window_count_trigger``."""
    w = stream.withColumn(stamp, F.current_timestamp()).withColumn("_w", F.window(stamp, size))
    return w.withColumns({START: F.col("_w.start"), END: F.col("_w.end")}).drop("_w", stamp)


def running_totals(stream: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Rolling reduce reported once per key and micro-batch: a plain keyed
    aggregation, run in output mode ``update``.  Stays in the JVM (partial
    aggregation, state store), so it is the cheap choice when the latest total
    per key is enough; ``stateful.RunningSum`` reports every event."""
    return stream.groupBy(*keys).agg(*[F.sum(e).cast("long").alias(n) for n, e in sums.items()])
