"""Functions of one's own over windows: mergeable accumulators and whole-window functions.

``aggregate_windows`` takes an accumulator (create, add, merge, result).  Tasks add their rows
to one accumulator for each window that they meet, Arrow batch by Arrow batch; only these
accumulators are shuffled, serialised, and they are merged in two levels, so a window that
every task has rows of is a few hundred small objects in any one place, not its rows.

``apply_windows`` gives a function the window and all of its rows in order, as a stream of
Arrow batches: rows are dealt by window and sorted within (Spark's sort spills), and a task
passes on one batch after the other.  A window of any size is never held whole, and a
function may stop reading early.  It is for results that need the rows themselves, in
order; what can be merged is better off as an accumulator, as all rows of a window go to
one task here.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any, NamedTuple, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.operators.windows import END, START

#: Accumulators that a task keeps open; past it they are passed on and begun anew.
OPEN = 20_000
#: Tasks whose accumulators are merged at the first level.
FAN = 64
ACC, SALT = "_acc", "_salt"


class Accumulator(Protocol):
    """An aggregate function.  ``add`` may change its accumulator; accumulators must pickle."""

    def create(self) -> Any: ...

    def add(self, accumulator: Any, rows: pa.RecordBatch) -> Any:
        """The accumulator with the rows (the input columns) added."""

    def merge(self, a: Any, b: Any) -> Any: ...

    def result(self, accumulator: Any) -> Mapping[str, Any]:
        """Values of the result columns."""


class Group(NamedTuple):
    """A window (and key) as a function sees it."""

    start: Any
    end: Any
    keys: dict[str, Any]


def _windowed(df: DataFrame, time_col: str, size: str, slide: str | None, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    d = df.select(w.alias("_w"), *keys, *[e.alias(c) for c, e in columns.items()])
    return d.select(F.col("_w.start").alias(START), F.col("_w.end").alias(END), *keys, *columns)


def _runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) of each run of equal values in the first columns."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for i in range(n_keys):
        codes = batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    first = np.flatnonzero(new)
    for s, e in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows], strict=True):
        yield tuple(batch.column(i)[s].as_py() for i in range(n_keys)), batch.slice(s, e - s)


def _grouped(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) of each group of the batch; rows keep their order."""
    codes = np.column_stack([batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for i in range(n_keys)])
    order = np.lexsort(codes.T)
    yield from _runs(batch.take(pa.array(order)), n_keys)


def _rows_schema(df: DataFrame, names: Sequence[str], more: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([*[df.schema[n] for n in names], *more])


def aggregate_windows(df: DataFrame, time_col: str, size: str, accumulator: Accumulator, inputs: Mapping[str, Column],
                      result: str, slide: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """One row per window (and key) that has rows: window_start, window_end, keys..., and the
    result columns of the accumulator, whose types ``result`` tells as DDL.  ``inputs``: the
    columns that ``add`` sees.  Sliding windows add a row to each of its windows."""
    keys = list(keys)
    by = [START, END, *keys]
    d = _windowed(df, time_col, size, slide, keys, inputs)
    k = len(by)
    acc_schema = _rows_schema(d, by, [T.StructField(ACC, T.BinaryType())])
    arrow = to_arrow_schema(acc_schema)

    def batch_of(accs: Mapping[tuple, Any]) -> pa.RecordBatch:
        columns = list(zip(*accs, strict=True)) if accs else [()] * k
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, arrow.field(i).type) for i, c in enumerate(columns)], pa.array([pickle.dumps(a) for a in accs.values()], pa.binary())],
            names=[*by, ACC])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accs: dict[tuple, Any] = {}
        for batch in batches:
            for key, rows in _grouped(batch, k):
                acc = accs[key] if key in accs else accumulator.create()
                accs[key] = accumulator.add(acc, rows.select(range(k, rows.num_columns)))
            if len(accs) > OPEN:
                yield batch_of(accs)
                accs = {}
        yield batch_of(accs)

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Accumulators of equal keys, which come one after the other, as one."""
        done: dict[tuple, Any] = {}
        for batch in batches:
            for key, rows in _runs(batch, k):
                for value in rows.column(k).to_pylist():
                    acc = pickle.loads(value)
                    done[key] = accumulator.merge(done[key], acc) if key in done else acc
            if len(done) > 1:
                last = next(reversed(done))
                open_ = {last: done.pop(last)}
                yield batch_of(done)
                done = open_
        yield batch_of(done)

    parts = d.mapInArrow(partial, acc_schema).withColumn(SALT, F.expr(f"spark_partition_id() div {FAN}"))
    # the salt is a column behind the accumulator, so that both levels read the same
    level = parts.repartition(*by, SALT).sortWithinPartitions(*by, SALT).drop(SALT).mapInArrow(merged, acc_schema)
    whole = level.repartition(*by).sortWithinPartitions(*by).mapInArrow(merged, acc_schema)
    result_fields = T.StructType.fromDDL(result).fields
    out_schema = _rows_schema(d, by, result_fields)
    out_arrow = to_arrow_schema(out_schema)

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [accumulator.result(pickle.loads(a)) for a in batch.column(k).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(k)], *[pa.array([r[f.name] for r in rows], out_arrow.field(k + j).type) for j, f in enumerate(result_fields)]],
                names=out_schema.names)

    return whole.mapInArrow(told, out_schema)


def apply_windows(df: DataFrame, time_col: str, size: str, function: Callable[[Group, Iterator[pa.RecordBatch]], Iterable[Mapping[str, Any]]],
                  inputs: Mapping[str, Column], result: str, order: Sequence[str], slide: str | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """window_start, window_end, keys... and the result columns (DDL in ``result``) of each
    mapping that ``function(window, batches)`` yields for a window (and key) that has rows: none,
    one or many.  ``batches`` are the window's rows, the columns of ``inputs``, sorted by
    ``order`` (columns of the inputs)."""
    keys = list(keys)
    by = [START, END, *keys]
    d = _windowed(df, time_col, size, slide, keys, inputs)
    k = len(by)
    result_fields = T.StructType.fromDDL(result).fields
    out_schema = _rows_schema(d, by, result_fields)
    arrow = to_arrow_schema(out_schema)
    wanted = [f.name for f in result_fields]

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = ((key, rows) for batch in batches for key, rows in _runs(batch, k))
        ahead = next(runs, None)
        held: list[tuple] = []
        while ahead is not None:
            key = ahead[0]

            def own(key: tuple = key) -> Iterator[pa.RecordBatch]:
                nonlocal ahead
                while ahead is not None and ahead[0] == key:
                    rows, ahead = ahead[1], None
                    yield rows.select(range(k, rows.num_columns))
                    ahead = next(runs, None)

            rest = own()
            for row in function(Group(key[0], key[1], dict(zip(keys, key[2:], strict=True))), rest):
                held.append((*key, *[row[c] for c in wanted]))
                if len(held) >= 10_000:
                    yield _batch(held, arrow)
                    held = []
            for _ in rest:  # what the function has not read
                pass
        yield _batch(held, arrow)

    return d.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(told, out_schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(i).type) for i, c in enumerate(columns)], names=schema.names)
