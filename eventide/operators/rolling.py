"""Rolling per-key state in batch form: one output row per input row.

These are the table versions of the keyed stateful functions (value, list and
map state).  Each is a scan (``scan``) that splits keys with more than ``width``
rows, so a key holding a third of the rows is many tasks.  The streaming versions are
``eventide.streaming.stateful``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.exprs import join_ids
from eventide.operators.scan import DEFAULT_WIDTH, last_n, last_n_of_types, running, running_sums


def running_sum_by_key(df: DataFrame, order: str, keys: Sequence[str], value: Column,
                       name: str = "running_sum", width: int = DEFAULT_WIDTH) -> DataFrame:
    """Rolling reduce (+) per key: each row gets the key's sum so far."""
    return running_sums(df, order, {name: value}, keys=keys, width=width)


def running_by_key(df: DataFrame, order: str, keys: Sequence[str], columns: Mapping[str, tuple],
                   width: int = DEFAULT_WIDTH) -> DataFrame:
    """Rolling reduce per key with any associative aggregates (``scan.running``)."""
    return running(df, order, columns, keys=keys, width=width)


def running_count_by_key(df: DataFrame, order: str, keys: Sequence[str],
                         name: str = "n_events", width: int = DEFAULT_WIDTH) -> DataFrame:
    """Value state counter: each row gets the key's event count so far."""
    return running_sums(df, order, {name: F.lit(1).cast("long")}, keys=keys, width=width)


def type_counts_by_key(df: DataFrame, order: str, keys: Sequence[str], type_col: str,
                       types: Sequence[str], prefix: str = "n_",
                       width: int = DEFAULT_WIDTH) -> DataFrame:
    """Map state type -> count: one running count column per type (0 while a
    type is unseen; the columns replace the unordered map report)."""
    sums: Mapping[str, Column] = {
        f"{prefix}{t}": F.when(F.col(type_col) == t, F.lit(1)).otherwise(F.lit(0)).cast("long")
        for t in types}
    return running_sums(df, order, sums, keys=keys, width=width)


def last_n_by_key(df: DataFrame, order: str, keys: Sequence[str], n: int, value: str,
                  name: str = "last_n", as_text: bool = True,
                  width: int = DEFAULT_WIDTH) -> DataFrame:
    """List state trimmed to the last ``n``: each row gets the last ``n``
    values of its key (oldest first), including its own.  ``as_text`` joins
    them with commas."""
    out = last_n(df, order, n, F.col(value), name, keys=keys, width=width, nullable=value != order)
    return out.withColumn(name, join_ids(F.col(name))) if as_text else out


def last_n_per_type(df: DataFrame, order: str, keys: Sequence[str], type_col: str,
                    types: Mapping[str, str], n: int, value: str, as_text: bool = True,
                    width: int = DEFAULT_WIDTH) -> DataFrame:
    """Map state type -> last-n list, reported side by side on every row.

    ``types`` maps event type -> output column.  For each type the list is the
    last ``n`` values of the key's events of that type up to this row; null
    while the type is unseen.  One scan (``scan.last_n_of_types``).
    """
    out = last_n_of_types(df, order, n, F.col(value), type_col, types, keys=list(keys), width=width)
    return out.withColumns({c: join_ids(F.col(c)) for c in types.values()}) if as_text else out


def history_pages(df: DataFrame, order: str, keys: Sequence[str], value: str,
                  page_size: int = 1000, width: int = DEFAULT_WIDTH) -> DataFrame:
    """All events so far per key (list state), as bounded pages.

    A key's full history is never gathered into one row or task: positions
    come from the running count, and each page holds ``page_size``
    consecutive events.  Output: keys..., page (0-based), first, last,
    n_events, values (comma-joined, in order).  The history at event k is the
    concatenation of pages up to k.
    """
    keys = list(keys)
    pos = running_sums(df, order, {"_pos": F.lit(1).cast("long")}, keys=keys, width=width)
    page = F.expr(f"(_pos - 1) div {int(page_size)}")
    g = pos.groupBy(*keys, page.alias("page")).agg(
        F.min(order).alias("first_seq"), F.max(order).alias("last_seq"),
        F.count(F.lit(1)).alias("n_events"),
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_vals"))
    return g.select(*keys, "page", "first_seq", "last_seq", "n_events",
                    join_ids(F.col("_vals.v")).alias("history"))
