"""Best window: arg-max over a table of window results.

Two tie rules exist in the reference and both are kept:

* ``ties="first"``: a later window must be strictly better to replace the best
  (the running "best so far" report), so the earliest of equal windows wins;
* ``ties="last"``: a rolling reduce that keeps the right operand unless the left
  is strictly better, so the latest of equal windows wins.

Both are one ``max(struct(value, +/-start))``: a global aggregate with partial
aggregation, never a sort of the window table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.exprs import epoch_us
from eventide.operators.scan import DEFAULT_WIDTH, running_max
from eventide.operators.windows import END, START


def _rank_key(value: str, ties: str) -> Column:
    if ties not in ("first", "last"):
        raise ValueError("ties must be 'first' or 'last'")
    order = -epoch_us(START) if ties == "first" else epoch_us(START)
    return F.struct(F.col(value).alias("v"), order.alias("o"), F.col(START).alias("s"), F.col(END).alias("e"))


def best_window(windows: DataFrame, value: str = "net", ties: str = "first") -> DataFrame:
    """One row: window_start, window_end, value of the best window (no row if
    the table is empty)."""
    best = windows.agg(F.max(_rank_key(value, ties)).alias("_b"))
    return best.where(F.col("_b").isNotNull()).select(
        F.col("_b.s").alias(START), F.col("_b.e").alias(END), F.col("_b.v").alias(value))


def best_so_far(windows: DataFrame, value: str = "net", ties: str = "first",
                width: int = DEFAULT_WIDTH) -> DataFrame:
    """For every window, in start order, the best window among those up to it.

    Output: window_start (the window just closed), best_start, best_end,
    best_<value>.  The running arg-max is a scan over the window table, split into
    buckets of ``width`` windows, so it stays parallel when the table is long.
    """
    scanned = running_max(windows, START, "_best", _rank_key(value, ties),
                          width=width)
    return scanned.select(START, F.col("_best.s").alias("best_start"), F.col("_best.e").alias("best_end"),
                          F.col("_best.v").alias(f"best_{value}"))
