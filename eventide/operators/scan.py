"""Skew-proof running aggregates ("so far" values in arrival order).

The direct way to write a running count per key is
``count(*) over (partition by key order by seq)``.  That puts every row of a
key into one task, and a global order (no key) puts the whole table into one
task.  With one key holding a third of all rows that task would hold a third
of the data.

Here only keys with more rows than ``width`` are split, at order values taken
from a sample, so a task's group has about ``width`` rows however hot the key
is, however the order values are spread, and with one outlier or a burst:

1. bounds       a statistics job over (keys, order): one row in
                ``width / SAMPLES`` (by hash), ranked within its key; every
                ``SAMPLES``-th is a bound.  About rows / width bounds in all
                reach the driver and are broadcast with their keys.  A width
                below the default is widened towards it, so that there are about
                ``MAX_BUCKETS`` buckets at most (that takes a count as well); at
                the default width a bucket has about 2^20 rows whatever the
                table, so 10^12 rows have 10^6 bounds of 16 bytes
2. local pass   window over ``partition by key, bucket order by seq``: the one
                exchange of the raw rows.  Keys that are not split have one
                bucket, and their result is final
3. carry        of split keys only: bucket summaries straight from the input
                by partial aggregation, combined over the earlier buckets; at
                most as many rows more than split keys as there are bounds, so it
                is broadcast

The last-n scan needs no carry: the last rows of a bucket are dealt to the next
one as well (a "halo", dropped afterwards).  The last n of several types at once
(``last_n_of_types``) has one: lists that are joined and trimmed to n, taken from the
local pass's own exchange.

The result does not depend on ``width``.  A null key is a group like any other.
A null order value fails the query: such a row has no place.  Null values are
taken as SQL window functions take them.  The order must be unique within a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.exprs import epoch_us

# Rows per (key, bucket) group; bounds and carries have rows / width entries.
DEFAULT_WIDTH = 1 << 20
# A smaller width is widened to rows / MAX_BUCKETS, up to DEFAULT_WIDTH.
MAX_BUCKETS = 4096
# Sampled rows per bucket: a bucket's size is width give or take a fifth.
SAMPLES = 32
BUCKET, ORDER, SPLIT, HALO = "_bkt", "_ord", "_split", "_halo"


class Split(NamedTuple):
    """Rows with ORDER (a non-null number), BUCKET and, if any key is split, SPLIT
    (its key is) and HALO (the row also belongs to the next bucket's context)."""

    df: DataFrame
    any: bool


def order_number(df: DataFrame, order: str) -> Column:
    """The order column as a number; a null fails loudly."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        number = epoch_us(order)
    elif isinstance(kind, (T.IntegralType, T.DecimalType)):
        number = F.col(order).cast("long")
    else:
        raise TypeError(f"order column {order} must be an integer, date or timestamp, not {kind.simpleString()}")
    return F.coalesce(number, F.raise_error(F.lit(f"null in order column {order}")).cast("long"))


def _key_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy()


def same_keys(a: str, b: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
    return cond


def bounds(df: DataFrame, keys: Sequence[str], width: int, halo: int = 0) -> list:
    """(keys..., bounds, halos) of the keys to split: a bucket ends at a bound, and
    the rows from its halo value on are at least ``halo`` rows of that bucket."""
    share = max(1, width // SAMPLES)
    per = max(1, width // share, halo)
    sample = df.select(*keys, ORDER).where(F.pmod(F.xxhash64(ORDER), F.lit(share)) == 0)
    w = _key_window(keys).orderBy(ORDER)
    ranked = sample.select(*keys, ORDER, F.row_number().over(w).alias("_r"),
                           F.lag(ORDER, max(halo - 1, 0)).over(w).alias("_h"))
    found = ranked.where(F.col("_r") % per == 0).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(ORDER, "_h"))).alias("_b")).where(F.size("_b") > 0)
    return found.select(*keys, F.col(f"_b.{ORDER}").alias("_bounds"), F.col("_b._h").alias("_halos")).collect()


def split(df: DataFrame, order: str, keys: Sequence[str] = (), width: int = DEFAULT_WIDTH, halo: int = 0) -> Split:
    """Deal each key's rows to buckets of about ``width`` rows in ``order``; of a width below
    the default more, if the table would have over ``MAX_BUCKETS`` buckets."""
    if width < 1:
        raise ValueError("width must be >= 1")
    keys = list(keys)
    d = df.withColumn(ORDER, order_number(df, order))
    if width < DEFAULT_WIDTH:
        width = max(width, min(DEFAULT_WIDTH, -(-d.count() // MAX_BUCKETS)))
    found = bounds(d, keys, width, halo)
    if not found:
        return Split(d.withColumn(BUCKET, F.lit(0)), False)
    longest = max(len(r["_bounds"]) for r in found)
    if keys:
        schema = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys],
                               *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("_bounds", "_halos")]])
        hot = df.sparkSession.createDataFrame([tuple(r) for r in found], schema)
        d = d.alias("d").join(F.broadcast(hot).alias("h"), same_keys("d", "h", keys), "left").select(
            *[F.col(f"d.`{c}`") for c in d.columns], "h._bounds", "h._halos")
    else:
        # one folded literal each, however many bounds
        literal = [F.split(F.lit(",".join(map(str, found[0][c]))), ",").cast("array<bigint>") for c in ("_bounds", "_halos")]
        d = d.withColumns({"_bounds": literal[0], "_halos": literal[1]})
    # binary search: number of bounds below the row's order
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(longest.bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda n, s: F.when(
        (n + s <= F.size("_bounds")) & (F.get("_bounds", n + s - 1) < F.col(ORDER)), n + s).otherwise(n))
    d = d.withColumns({SPLIT: F.col("_bounds").isNotNull(), BUCKET: F.when(F.col("_bounds").isNotNull(), at).otherwise(0)})
    return Split(d.withColumn(HALO, F.coalesce(F.col(ORDER) >= F.get("_halos", F.col(BUCKET)), F.lit(False))).drop("_bounds", "_halos"), True)


def _so_far(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, BUCKET).orderBy(ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(keys: Sequence[str]) -> Window:
    return _key_window(keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)


def _with_carry(local: DataFrame, totals: DataFrame, keys: Sequence[str], carry: Mapping[str, Column]) -> DataFrame:
    """Join the carries of split keys to the local pass.  Their number is bounded by
    the bounds, which the driver has seen, hence the broadcast."""
    c = totals.select(*keys, BUCKET, *[e.alias(n) for n, e in carry.items()])
    cond = same_keys("l", "c", keys) & (F.col(f"l.{BUCKET}") == F.col(f"c.{BUCKET}"))
    return local.alias("l").join(F.broadcast(c).alias("c"), cond, "left").select(
        *[F.col(f"l.`{x}`") for x in local.columns], *[F.col(f"c.{n}") for n in carry])


def running_sums(df: DataFrame, order: str, sums: Mapping[str, Column],
                 keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Add one column per entry of ``sums``: the sum of the expression over the
    rows of the same key with ``order`` <= this row's (running sum/count); null
    while all its values are null."""
    return running(df, order, {n: (F.sum, F.sum, _plus, e) for n, e in sums.items()}, keys, width)


def running_max(df: DataFrame, order: str, name: str, value: Column,
                keys: Sequence[str] = (), width: int = DEFAULT_WIDTH, before: bool = False) -> DataFrame:
    """Add ``name``: max of ``value`` over rows of the key so far (``before``: without the
    row itself).  Works for any orderable type, structs included (``max(struct(a, b))`` is
    an arg-max)."""
    return running(df, order, {name: (F.max, F.max, F.greatest, value)}, keys, width, before)


def running_min(df: DataFrame, order: str, name: str, value: Column,
                keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Add ``name``: min of ``value`` over rows of the key so far."""
    return running(df, order, {name: (F.min, F.min, F.least, value)}, keys, width)


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def running(df: DataFrame, order: str, columns: Mapping[str, tuple], keys: Sequence[str] = (),
            width: int = DEFAULT_WIDTH, before: bool = False) -> DataFrame:
    """Rolling reduce with any associative aggregate: one column per entry of
    ``columns``, given as (aggregate, aggregate of its results, function of two
    results, value), e.g. ``(F.sum, F.sum, plus, value)``.  ``before`` leaves the row itself
    out."""
    keys = list(keys)
    s = split(df, order, keys, width)
    frame = _so_far(keys).rowsBetween(Window.unboundedPreceding, -1) if before else _so_far(keys)
    local = s.df.select("*", *[agg(e).over(frame).alias(f"_l_{n}") for n, (agg, _, _, e) in columns.items()])
    if not s.any:
        return local.select(*df.columns, *[F.col(f"_l_{n}").alias(n) for n in columns])
    totals = s.df.where(SPLIT).groupBy(*keys, BUCKET).agg(*[agg(e).alias(f"_t_{n}") for n, (agg, _, _, e) in columns.items()])
    out = _with_carry(local, totals, keys, {f"_c_{n}": merge(f"_t_{n}").over(_earlier(keys)) for n, (_, merge, _, _) in columns.items()})
    return out.select(*df.columns, *[join(F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n) for n, (_, _, join, _) in columns.items()])


def last_n(df: DataFrame, order: str, n: int, value: Column, name: str,
           keys: Sequence[str] = (), width: int = DEFAULT_WIDTH, nullable: bool = True) -> DataFrame:
    """Add ``name``: array of the last ``n`` values of ``value`` (oldest first)
    among rows of the key with ``order`` <= this row's.  Null values take
    their place in the list: values travel wrapped in a struct, which
    ``collect_list`` keeps (``nullable=False`` saves the wrapping)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    keys = list(keys)
    s = split(df, order, keys, max(width, n), halo=n - 1)
    d = s.df.withColumn("_context", F.lit(False))
    if s.any and n > 1:
        own = F.struct(F.col(BUCKET).alias("b"), F.lit(False).alias("x"))
        after = F.struct((F.col(BUCKET) + 1).alias("b"), F.lit(True).alias("x"))
        d = s.df.withColumn("_to", F.explode(F.when(F.col(HALO), F.array(own, after)).otherwise(F.array(own))))
        d = d.withColumns({BUCKET: F.col("_to.b"), "_context": F.col("_to.x")}).drop("_to")
    w = Window.partitionBy(*keys, BUCKET).orderBy(ORDER).rowsBetween(-(n - 1), Window.currentRow)
    listed = F.collect_list(F.struct(value.alias("v")) if nullable else value).over(w)
    out = d.withColumn("_list", listed).where(~F.col("_context"))
    return out.select(*df.columns, (F.transform("_list", lambda x: x["v"]) if nullable else F.col("_list")).alias(name))


def forward_fill(df: DataFrame, order: str, fills: Mapping[str, Column],
                 keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Add one column per entry of ``fills``: the latest non-null value of the
    expression among rows of the key so far (null until the first one).  All
    columns share one local pass and one carry table."""
    keys = list(keys)
    s = split(df, order, keys, width)
    local = s.df.select("*", *[F.last(e, ignorenulls=True).over(_so_far(keys)).alias(f"_l_{n}") for n, e in fills.items()])
    if not s.any:
        return local.select(*df.columns, *[F.col(f"_l_{n}").alias(n) for n in fills])
    totals = s.df.where(SPLIT).groupBy(*keys, BUCKET).agg(*[
        F.max_by(e, F.when(e.isNotNull(), F.col(ORDER))).alias(f"_t_{n}") for n, e in fills.items()])
    out = _with_carry(local, totals, keys, {f"_c_{n}": F.last(f"_t_{n}", ignorenulls=True).over(_earlier(keys)) for n in fills})
    return out.select(*df.columns, *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in fills])


def last_n_of_types(df: DataFrame, order: str, n: int, value: Column, type_col: str, types: Mapping[str, str],
                    keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Add one column per entry of ``types`` (type -> column): the last ``n`` values of
    ``value`` among the key's rows of that type so far, oldest first; null until the first.
    Null values take their place in the lists.

    One exchange of the raw rows serves it all: in a (key, bucket), rows sorted by type make
    the lists at their own rows, and rows in order carry them to the rows between.  A split
    key's lists as of the end of each bucket, trimmed to n, are the carry.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    keys, names = list(keys), list(types.values())
    s = split(df, order, keys, width)
    own = Window.partitionBy(*keys, BUCKET, type_col).orderBy(ORDER).rowsBetween(-(n - 1), Window.currentRow)
    # dealt by the coarser of the two windows' groups, which serves both
    groups = [*keys, BUCKET] if s.any else keys
    dealt = s.df.repartition(*groups) if groups else s.df.coalesce(1)
    listed = dealt.withColumn("_list", F.collect_list(F.struct(value.alias("v"))).over(own))
    so_far = [F.last(F.when(F.col(type_col) == t, F.col("_list")), ignorenulls=True).over(_so_far(keys)).alias(f"_l_{c}") for t, c in types.items()]
    local = listed.select(*s.df.columns, *so_far)

    def shown(lists: Mapping[str, Column]) -> list[Column]:
        return [F.transform(e, lambda x: x["v"]).alias(c) for c, e in lists.items()]

    if not s.any:
        return local.select(*df.columns, *shown({c: F.col(f"_l_{c}") for c in names}))
    # a condition that always holds keeps all columns, so that both readers share the exchange
    plain = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    totals = local.where(F.col(SPLIT) & (F.pmod(F.xxhash64(*plain), F.lit(2)) < 2)).groupBy(*keys, BUCKET).agg(
        F.max_by(F.struct(*[f"_l_{c}" for c in names]), ORDER).alias("_t"))
    # in long form: the items of each bucket's lists, their last n as of each item, and of each bucket
    stacked = totals.select(*keys, BUCKET, F.posexplode(F.array(*[F.col(f"_t._l_{c}") for c in names])).alias("_type", "_list"))
    items = stacked.select(*keys, BUCKET, "_type", F.posexplode_outer("_list").alias("_at", "_item"))
    by_type = Window.partitionBy(*keys, "_type")
    # a bucket without the type has one row without an item: numbers of items, not rows, make the frame
    items = items.withColumn("_k", F.count("_item").over(by_type.orderBy(BUCKET, "_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    as_of = items.withColumn("_list", F.collect_list("_item").over(by_type.orderBy("_k").rangeBetween(-(n - 1), Window.currentRow)))
    ends = as_of.groupBy(*keys, "_type", BUCKET).agg(F.max_by("_list", F.coalesce("_at", F.lit(-1))).alias("_list"))
    before = F.lag(F.when(F.size("_list") > 0, F.col("_list"))).over(by_type.orderBy(BUCKET))
    carried = ends.select(*keys, BUCKET, "_type", before.alias("_list")).groupBy(*keys, BUCKET).agg(
        *[F.first(F.when(F.col("_type") == i, F.col("_list")), ignorenulls=True).alias(f"_c_{c}") for i, c in enumerate(names)])
    cond = same_keys("l", "c", keys) & (F.col(f"l.{BUCKET}") == F.col(f"c.{BUCKET}")) & F.col(f"l.{SPLIT}")
    both = local.alias("l").join(F.broadcast(carried).alias("c"), cond, "left").select(
        *[F.col(f"l.`{x}`") for x in local.columns], *[F.col(f"c._c_{c}") for c in names])

    def trimmed(c: str) -> Column:
        joined = F.concat(F.col(f"_c_{c}"), F.col(f"_l_{c}"))
        return F.coalesce(F.slice(joined, F.greatest(F.size(joined) - (n - 1), F.lit(1)), F.lit(n)), f"_l_{c}", f"_c_{c}")

    return both.select(*df.columns, *shown({c: trimmed(c) for c in names}))
