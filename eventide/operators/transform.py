"""Row-level operators: map, filter, fan-out, itemize, tag and route.

All are narrow transformations (no shuffle) built from Column expressions, so
Catalyst prunes columns, pushes the filters to the scan and fuses the chain
into one whole-stage-codegen stage.  ``partition_map`` is the one Python path:
a per-partition Arrow batch function with set-up before and tear-down after
the batch loop, for logic that has no Column expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, nullcontext

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.exprs import divisible, tag


def scale(df: DataFrame, col: str, factor: int, name: str) -> DataFrame:
    """``x * factor`` (map)."""
    return df.withColumn(name, F.col(col) * F.lit(factor))


def prefixed(df: DataFrame, col: str, prefix: str, name: str) -> DataFrame:
    """number -> ``prefix + str(number)`` (map to string)."""
    return df.withColumn(name, F.concat(F.lit(prefix), F.col(col).cast("string")))


def keep(df: DataFrame, pred: Column) -> DataFrame:
    """Filter by predicate."""
    return df.where(pred)


def fan_out(df: DataFrame, exprs: Sequence[Column], name: str, keep_cols: Sequence[str] = ()) -> DataFrame:
    """flatMap with a fixed fan-out: one output row per expression, in order."""
    return df.select(*keep_cols, F.explode(F.array(*exprs)).alias(name))


def itemize(df: DataFrame, is_add: Column, quantity: str = "quantity",
            keep_cols: Sequence[str] = ("seq", "user_id", "sku", "event_time")) -> DataFrame:
    """An add event of quantity q becomes q events of quantity 1; other kinds
    and q <= 0 produce nothing.  ``item`` numbers the copies 1..q.

    The ``q > 0`` filter must come first: ``sequence(1, 0)`` counts down.
    """
    src = df.where(is_add & (F.col(quantity) > 0))
    return src.select(*keep_cols, F.explode(F.sequence(F.lit(1), F.col(quantity))).alias("item"),
                      F.lit(1).alias(quantity))


def itemize_to(df: DataFrame, is_add: Column, value: str = "sku", quantity: str = "quantity") -> DataFrame:
    """Itemize to one value per unit (e.g. the SKU repeated q times)."""
    src = df.where(is_add & (F.col(quantity) > 0))
    return src.select(F.explode(F.array_repeat(F.col(value), F.col(quantity))).alias(value))


def high_quantity(df: DataFrame, is_add: Column, threshold: int, sku: str = "sku",
                  quantity: str = "quantity") -> DataFrame:
    """Add events with quantity > threshold, as (sku, quantity as bigint)."""
    return df.where(is_add & (F.col(quantity) > threshold)).select(
        F.col(sku).alias("sku"), F.col(quantity).cast("long").alias("quantity"))


def fizzbuzz_rules(col: str | Column, first_match: bool = False) -> list[tuple[Column, str]]:
    """Ordered tag rules on divisibility.

    By default 15 -> fizzbuzz (three tags); ``first_match=True`` tests 3 before 5
    and has no third tag, so 15 -> fizz.
    """
    three, five = divisible(col, 3), divisible(col, 5)
    if first_match:
        return [(three, "fizz"), (five, "buzz")]
    return [(three & five, "fizzbuzz"), (three, "fizz"), (five, "buzz")]


def routes(df: DataFrame, routes_: Mapping[str, tuple[Column, Column]],
           keep_cols: Sequence[str] = ()) -> DataFrame:
    """One input, several outputs: ``name -> (filter, value)``.

    A single pass: each row becomes one output row per route whose filter it
    passes (``explode`` of the matching routes), with columns ``route`` and
    ``tag``.  Writing it with ``partitionBy("route")`` gives one folder per
    route from one scan of the input (``streaming.sinks.write_routes``).
    """
    cands = F.array(*[F.struct(F.lit(name).alias("route"), pred.alias("keep"), val.cast("string").alias("tag"))
                      for name, (pred, val) in routes_.items()])
    hit = F.explode(F.filter(cands, lambda r: F.coalesce(r["keep"], F.lit(False))))
    return df.select(*keep_cols, hit.alias("_r")).select(*keep_cols, "_r.route", "_r.tag")


def fizzbuzz_route_map(col: str) -> dict[str, tuple[Column, Column]]:
    """The two-file fizz/buzz job: route ``fizz_and_buzz`` keeps multiples of
    3 or 5, tagged first-match (fizz before buzz); route ``fizzbuzz`` keeps
    multiples of both, tagged ``fizzbuzz``."""
    three, five = divisible(col, 3), divisible(col, 5)
    return {
        "fizz_and_buzz": (three | five, tag(fizzbuzz_rules(col, first_match=True), default="")),
        "fizzbuzz": (three & five, F.lit("fizzbuzz")),
    }


def fizzbuzz_routes(df: DataFrame, col: str, keep_cols: Sequence[str] = ()) -> DataFrame:
    """``routes`` of ``fizzbuzz_route_map``."""
    return routes(df, fizzbuzz_route_map(col), keep_cols=keep_cols)


def partition_map(df: DataFrame, fn: Callable[..., pa.RecordBatch], schema: str,
                  setup: Callable[[], AbstractContextManager] | None = None) -> DataFrame:
    """Per-partition Arrow batch map with set-up and tear-down.

    ``setup`` returns a context manager entered once per partition before
    the first batch and exited after the last (also on failure): the
    open/close hooks of a rich map function.  With ``setup``, ``fn`` gets what the
    context manager returned as a second argument.  Batches stay columnar
    (Arrow), never per row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with (setup() if setup else nullcontext()) as opened:
            for b in batches:
                yield fn(b, opened) if setup else fn(b)

    return df.mapInArrow(run, schema)
