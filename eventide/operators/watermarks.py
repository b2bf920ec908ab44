"""Watermarks that move with every event, on tables.

A watermark w says that no event with a time up to w is expected any more.  Each event may
emit one when it arrives, and the watermark is the largest emitted so far, in arrival
order; it is a running maximum (``scan.running_max``), so it does not depend on how a
stream was cut into micro-batches, and no task sorts the whole order.

* bounded out-of-orderness: every event emits its time less a delay;
* a custom generator: any expression, null where an event emits nothing;
* watermarks of the source: the event's own time.

An event meets the watermark of the events before it.  It is late for a window whose last
instant (a millisecond before its end, the clock's tick) the watermark has reached:
that window has been reported and is not opened again.  Late rows are dropped from window
results; ``late_rows`` lists them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.exprs import duration_us
from eventide.operators.scan import DEFAULT_WIDTH, running_max
from eventide.operators.windows import END, START

WATERMARK = "watermark"
TICK_US = 1000


def bounded(time_col: str, delay: str) -> Column:
    """What an event emits under bounded out-of-orderness; a zero delay is the source's own
    watermark."""
    return _shifted(F.col(time_col), -duration_us(delay))


def _shifted(time: Column, us: int) -> Column:
    return F.timestamp_add("MICROSECOND", F.lit(us).cast("long"), time)


def with_watermark(df: DataFrame, order: str, emitted: Column, name: str = WATERMARK, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Add ``name``: the watermark that each event meets, null before the first one."""
    return running_max(df, order, name, emitted, width=width, before=True)


def is_late(watermark: str = WATERMARK, end: str | Column = END) -> Column:
    """Whether the watermark has passed the window."""
    last = _shifted(F.col(end) if isinstance(end, str) else end, -TICK_US)
    return F.coalesce(F.col(watermark) >= last, F.lit(False))


def judged(df: DataFrame, time_col: str, order: str, size: str, emitted: Column, slide: str | None = None,
           width: int = DEFAULT_WIDTH) -> DataFrame:
    """One row per event and window that it belongs to (one window unless they slide), with
    ``window_start``, ``window_end``, ``watermark`` and ``late``."""
    marked = with_watermark(df, order, emitted, width=width)
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    out = marked.withColumn("_w", w).withColumns({START: F.col("_w.start"), END: F.col("_w.end")}).drop("_w")
    return out.withColumn("late", is_late())


def late_rows(df: DataFrame, time_col: str, order: str, size: str, emitted: Column, slide: str | None = None,
              width: int = DEFAULT_WIDTH) -> DataFrame:
    """The events (per window) that are dropped for being late."""
    return judged(df, time_col, order, size, emitted, slide, width).where("late").drop("late")


def on_time_sums(df: DataFrame, time_col: str, order: str, size: str, measures: Mapping[str, Column], emitted: Column,
                 slide: str | None = None, keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Sum of per-row measures per window (and key) over the events that came in time, and
    ``n_late``, the number that did not.  Windows of late events only are not reported."""
    g = judged(df, time_col, order, size, emitted, slide, width).groupBy(START, END, *keys).agg(
        *[F.sum(F.when(~F.col("late"), e)).cast("long").alias(n) for n, e in measures.items()],
        F.count_if("late").alias("n_late"), F.count("*").alias("_n"))
    return g.where(F.col("_n") > F.col("n_late")).select(START, END, *keys, *measures, "n_late")
