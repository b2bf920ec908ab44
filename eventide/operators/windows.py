"""Event-time windows: tumbling, sliding, session, and the window reports.

Reference semantics kept here:

* a window with events but no match reports 0 (counting happens inside the
  window, never by filtering first); a window without events reports nothing;
* windows are half-open ``[start, end)`` and aligned to the epoch;
* session windows merge events no more than ``gap`` apart (an event exactly
  ``gap`` after the previous one continues the session); a session ends at its
  last event + gap.

Scale notes: tumbling windows are a plain ``groupBy(window(...))`` with partial
aggregation, so a hot window costs one partial row per map task.  Sliding
windows whose size is a multiple of the slide are computed from slide-sized
pre-aggregates, so rows are never multiplied by size/slide; only the (much
smaller) pre-aggregated table is expanded.  Sessions use the bucketed
gaps-and-islands method below instead of Spark's ``session_window`` batch
operator, which sorts every row of a key (or, without a key, every row) in one
task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.exprs import duration_us, window_report
from eventide.operators.scan import BUCKET, DEFAULT_WIDTH, ORDER, SPLIT, same_keys, split

START, END = "window_start", "window_end"


def _sum_aggs(measures: Mapping[str, Column]) -> list[Column]:
    return [F.sum(e).cast("long").alias(n) for n, e in measures.items()]


def count_measure(pred: Column | None = None) -> Column:
    """Per-row 0/1 value; summing it is ``count(*)`` or ``count_if(pred)``."""
    if pred is None:
        return F.lit(1)
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def net_measure(plus: Column, minus: Column) -> Column:
    """+1 / -1 / 0 per row (online minus offline)."""
    return F.when(plus, F.lit(1)).when(minus, F.lit(-1)).otherwise(F.lit(0))


def window_aggregate(df: DataFrame, time_col: str, size: str, aggs: Mapping[str, Column],
                     slide: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Any aggregate Columns per time window (and key): the general form.

    Built-in aggregates keep partial aggregation, which is what an incremental
    create/add/merge aggregate function gives.
    """
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    g = df.groupBy(w.alias("_w"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return g.select(F.col("_w.start").alias(START), F.col("_w.end").alias(END), *keys, *aggs)


def window_sums(df: DataFrame, time_col: str, size: str, measures: Mapping[str, Column],
                slide: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of per-row measures per tumbling or sliding window (and key).

    Output: window_start, window_end, keys..., one bigint per measure.
    """
    keys = list(keys)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    if slide_us == size_us:
        return window_aggregate(df, time_col, size, {n: F.sum(e).cast("long") for n, e in measures.items()},
                                keys=keys)
    if size_us % slide_us:
        return window_aggregate(df, time_col, size, {n: F.sum(e).cast("long") for n, e in measures.items()},
                                slide=slide, keys=keys)
    k = size_us // slide_us
    # 1) tumbling pre-aggregate at slide granularity (partial agg, one shuffle)
    pre = (df.groupBy(F.window(time_col, slide).start.alias("_bs"), *keys)
             .agg(*_sum_aggs(measures)))
    # 2) each slide bucket belongs to the k windows starting at bs, bs-slide, ...
    exp = pre.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_k"))
    exp = exp.withColumn(START, F.timestamp_add("MICROSECOND", -F.col("_k").cast("long") * F.lit(slide_us).cast("long"),
                                               F.col("_bs")))
    out = exp.groupBy(START, *keys).agg(*[F.sum(n).cast("long").alias(n) for n in measures])
    return out.select(START, F.timestamp_add("MICROSECOND", F.lit(size_us).cast("long"), F.col(START)).alias(END),
                      *keys, *measures)


def window_counts(df: DataFrame, time_col: str, size: str, match: Column,
                  slide: str | None = None, keys: Sequence[str] = (),
                  with_total: bool = False) -> DataFrame:
    """``n_match`` = rows matching ``match`` per window (0 when none match);
    ``n_events`` = all rows of the window when ``with_total``."""
    m = {"n_match": count_measure(match)}
    if with_total:
        m["n_events"] = count_measure()
    return window_sums(df, time_col, size, m, slide=slide, keys=keys)


def net_change(df: DataFrame, time_col: str, size: str, plus: Column, minus: Column,
               slide: str | None = None, floor_at: int | None = 0,
               keys: Sequence[str] = ()) -> DataFrame:
    """``net`` = (#plus - #minus) per window, floored at ``floor_at``
    (None = no floor)."""
    out = window_sums(df, time_col, size, {"net": net_measure(plus, minus)}, slide=slide, keys=keys)
    if floor_at is not None:
        out = out.withColumn("net", F.greatest(F.col("net"), F.lit(floor_at).cast("long")))
    return out


def with_report(df: DataFrame, count_col: str, label: str | Column, name: str = "report") -> DataFrame:
    """Append ``[start_ms - end_ms] - n label``; the label may differ by row."""
    return df.withColumn(name, window_report(START, END, count_col, label))


def sessions(df: DataFrame, time_col: str, gap: str, measures: Mapping[str, Column],
             keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Session windows: events no more than ``gap`` apart share a session.

    Output: keys..., window_start (first event), window_end (last event + gap),
    one bigint per measure.  A null key is a group; a null time fails the query.

    Gaps and islands.  Keys with more rows than ``width`` are split by time
    (``scan.split``), so no task holds more than about ``width`` rows:

    * in each ``(key, bucket)``: ``lag`` gives the previous time; a row with a
      gap > ``gap`` to it is a definite session start; the running max of
      definite starts is the row's session start, if any so far;
    * rows are aggregated to local sessions in the same partitions, which are
      final for keys that are not split;
    * bucket table of split keys (min, max, max definite start): the bucket's
      first row starts a session iff the previous bucket's max is more than
      ``gap`` before it; the carry is the latest start of all earlier buckets.
      It has as many rows as the split has buckets, and is broadcast;
    * local sessions before their bucket's first definite start take that head
      start, and ``groupBy(key, session start)`` merges the pieces.
    """
    keys = list(keys)
    gap_us = duration_us(gap)
    s = split(df, time_col, keys, width)
    lw = Window.partitionBy(*keys, BUCKET).orderBy(ORDER)
    run = lw.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.lag(ORDER).over(lw)
    started = F.col(ORDER) - prev > gap_us
    if not s.any:
        started = prev.isNull() | started
    local = (s.df.withColumn("_def", F.when(started, F.col(ORDER)))
                 .withColumn("_ls", F.max("_def").over(run)))
    # local sessions: rows of one (key, bucket) with the same definite start (null:
    # the head rows of a split key's bucket), built without another exchange
    ls = local.groupBy(*keys, BUCKET, "_ls").agg(
        F.min(ORDER).alias("_lmin"), F.max(ORDER).alias("_lmax"),
        F.min(time_col).alias("_first"), F.max(time_col).alias("_last"),
        *([F.max(SPLIT).alias(SPLIT)] if s.any else []),
        *[F.sum(e).cast("long").alias(f"_m_{n}") for n, e in measures.items()])
    if not s.any:
        return _session_rows(ls, keys, F.col("_first"), F.col("_last"), {n: F.col(f"_m_{n}") for n in measures}, gap_us)
    # the bucket table reads the same columns as the stitching (those it does not
    # need by way of a filter that is always true), so both share one raw exchange
    used = ["_first", "_last", *[f"_m_{n}" for n in measures]]
    bt = ls.groupBy(*keys, BUCKET).agg(F.min("_lmin").alias("_bmin"), F.max("_lmax").alias("_bmax"), F.max("_ls").alias("_bdef"),
                                       F.max(SPLIT).alias(SPLIT), *[F.max(c).alias(c) for c in used])
    bt = bt.where(F.col(SPLIT) & reduce(Column.__or__, [F.col(c).isNotNull() for c in used]))
    bw = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(BUCKET)
    prev_max = F.lag("_bmax").over(bw)
    bt = bt.withColumn("_bfirst", prev_max.isNull() | (F.col("_bmin") - prev_max > gap_us))
    bt = bt.withColumn("_beff", F.greatest("_bdef", F.when(F.col("_bfirst"), F.col("_bmin"))))
    bt = bt.withColumn("_carry", F.max("_beff").over(bw.rowsBetween(Window.unboundedPreceding, -1)))
    bt = bt.select(*keys, BUCKET, F.when(F.col("_bfirst"), F.col("_bmin")).otherwise(F.col("_carry")).alias("_head"))
    cond = same_keys("l", "b", keys) & (F.col(f"l.{BUCKET}") == F.col(f"b.{BUCKET}"))
    tagged = ls.alias("l").join(F.broadcast(bt).alias("b"), cond, "left").select(
        *[F.col(f"l.`{c}`") for c in ls.columns], F.coalesce("_ls", F.when(F.col(SPLIT), F.col("_head")), "_lmin").alias("_sid"))
    out = tagged.groupBy(*keys, "_sid").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        *[F.sum(f"_m_{n}").cast("long").alias(n) for n in measures])
    return _session_rows(out, keys, F.col("_first"), F.col("_last"), {n: F.col(n) for n in measures}, gap_us)


def _session_rows(d: DataFrame, keys: Sequence[str], first: Column, last: Column, measures: Mapping[str, Column], gap_us: int) -> DataFrame:
    return d.select(*keys, first.alias(START), F.timestamp_add("MICROSECOND", F.lit(gap_us).cast("long"), last).alias(END),
                    *[e.alias(n) for n, e in measures.items()])
