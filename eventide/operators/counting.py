"""Count triggers: fire every n elements, with or without purging.

Reference semantics:

* a global window with a count trigger fires after every n-th element and
  the function sees **all elements so far** (contents kept);
* inside a time window (``within``) the count restarts per window;
* a purging count trigger clears the window after each fire, so each fire
  sees exactly the last n elements;
* a tail shorter than n never fires (``emit_partial`` adds it, off by default).

Positions come from the running count (``scan.running_sums``), so the
global arrival order is never sorted in one task.  Purged groups are
``(position - 1) // n``: groups of n rows, aggregated with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.scan import DEFAULT_WIDTH, running_sums
from eventide.operators.windows import END, START


def count_trigger(df: DataFrame, order: str, n: int, measures: Mapping[str, Column],
                  keys: Sequence[str] = (), purge: bool = False, emit_partial: bool = False,
                  width: int = DEFAULT_WIDTH) -> DataFrame:
    """Fire every ``n`` rows (per key) in ``order``.

    Output: keys..., ``fire`` (1, 2, ...), ``n_seen`` (rows the fire covers so
    far: position for kept contents, group size when purging), one bigint per
    measure (sum so far, or sum of the purged group).
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    keys = list(keys)
    if not purge:
        pos = running_sums(df, order, {"n_seen": F.lit(1), **measures}, keys=keys, width=width)
        cond = (F.col("n_seen") % n) == 0
        if emit_partial:
            raise ValueError("emit_partial needs purge=True: kept contents fire on full counts only")
        return pos.where(cond).select(
            *keys, F.expr(f"n_seen div {int(n)}").alias("fire"),
            F.col("n_seen").cast("long").alias("n_seen"),
            *[F.col(m).cast("long").alias(m) for m in measures])
    pos = running_sums(df, order, {"_pos": F.lit(1)}, keys=keys, width=width)
    grp = F.expr(f"(_pos - 1) div {int(n)}")
    g = pos.groupBy(*keys, grp.alias("_g")).agg(
        F.count(F.lit(1)).alias("n_seen"), *[F.sum(e).cast("long").alias(m) for m, e in measures.items()])
    if not emit_partial:
        g = g.where(F.col("n_seen") == n)
    return g.select(*keys, (F.col("_g") + 1).alias("fire"), "n_seen", *measures)


def window_count_trigger(df: DataFrame, time_col: str, size: str, order: str, n: int,
                         measures: Mapping[str, Column], purge: bool = False,
                         emit_partial: bool = False, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Count trigger inside tumbling time windows: the count restarts per
    window.  Output: window_start, window_end, fire, n_seen, measures."""
    d = (df.withColumn("_w", F.window(time_col, size))
           .withColumn(START, F.col("_w.start")).withColumn(END, F.col("_w.end")).drop("_w"))
    return count_trigger(d, order, n, measures, keys=[START, END], purge=purge,
                         emit_partial=emit_partial, width=width)
