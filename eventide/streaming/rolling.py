"""Rolling state on streams whose keys may be hot: ``foreachBatch`` jobs with a keyed
carry table.

A stateful processor (``stateful``) holds all rows that a key has in a micro-batch in one
task.  Here a micro-batch goes through the skew-proof scans of ``operators.scan`` instead:
the state that its keys had before enters the scan as rows of their own, placed before
the batch's rows, so a key that holds a third of all rows is as many tasks as it needs and
its carry meets it without a join.

State lies in a table on shared storage (``KeyedState``): each micro-batch writes the new
state of the keys it has seen (a *delta*), and every ``compact``-th one writes the latest
state of all keys (a *base*).  Before a micro-batch the last base and the deltas after it
are read and the newest row of each key is taken, so a micro-batch reads the state table
once; a key that is seldom hot and a table of very many keys are better off with the
state store behind ``stateful``.

Outputs and states are written by ``batch_id``: a micro-batch that is repeated after a
failure reads the same state and overwrites what it wrote.  A missing state fails it.
Rows of a later micro-batch come after all rows of earlier ones; within a micro-batch they
are in ``order``, which must be unique within a key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from eventide.functions.exprs import join_ids
from eventide.operators import rolling as batch_rolling
from eventide.operators import scan
from eventide.operators.scan import DEFAULT_WIDTH, order_number, same_keys
from eventide.streaming.carry import MissingCarry

#: Place of a row in its key's order; carried rows are placed from the smallest long on.
PLACE, CARRIED, VALUE = "_place", "_carried", "_value"
FIRST = -(1 << 63)
#: Every so many micro-batches the state is rewritten as one table.
COMPACT = 32


class KeyedState:
    """Latest state per key as ``path/delta/batch_id=<n>`` and ``path/base/batch_id=<n>``.

    What the micro-batches since the last base but one do not need is deleted.
    """

    def __init__(self, path: str, keys: Sequence[str], compact: int = COMPACT):
        if compact < 1:
            raise ValueError("compact must be >= 1")
        self.path, self.keys, self.compact = path, list(keys), compact

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/batch_id={batch_id}"

    def _read(self, spark: SparkSession, kind: str, batch_id: int) -> DataFrame:
        try:
            return spark.read.parquet(self._folder(kind, batch_id)).withColumn("_batch", F.lit(batch_id).cast("long"))
        except AnalysisException as e:
            raise MissingCarry(f"the state of micro-batch {batch_id} is missing in {self.path}") from e

    def before(self, spark: SparkSession, batch_id: int, touched: DataFrame | None = None) -> DataFrame | None:
        """Newest state per key (of ``touched``, a table of distinct keys) as the
        micro-batches before ``batch_id`` have left it; None before the first one."""
        if batch_id <= 0:
            return None
        base = batch_id // self.compact * self.compact - 1
        parts = [self._read(spark, "base", base)] if base >= 0 else []
        parts += [self._read(spark, "delta", b) for b in range(base + 1, batch_id)]
        every = reduce(DataFrame.unionByName, parts)
        if touched is not None and self.keys:
            every = every.alias("s").join(touched.alias("t"), same_keys("s", "t", self.keys), "left_semi")
        return self._newest(every)

    def _newest(self, every: DataFrame) -> DataFrame:
        newest = every.groupBy(*self.keys).agg(F.max_by("state", "_batch").alias("state"))
        return newest.where(F.col("state").isNotNull())  # without keys an empty table has a row too

    def write(self, states: DataFrame, batch_id: int) -> None:
        """``states``: keys and ``state`` (a struct) of the keys of this micro-batch."""
        spark = states.sparkSession
        states.write.mode("overwrite").parquet(self._folder("delta", batch_id))
        if (batch_id + 1) % self.compact:
            return
        every, old = self._read(spark, "delta", batch_id), self.before(spark, batch_id)
        if old is not None:
            every = every.unionByName(old.withColumn("_batch", F.lit(-1).cast("long")))
        self._newest(every).write.mode("overwrite").parquet(self._folder("base", batch_id))
        # a repeat of this micro-batch still needs the base before it
        last = batch_id - self.compact
        for kind, ids in (("base", [last - self.compact]), ("delta", range(last - self.compact + 1, last + 1))):
            for i in ids:
                self._delete(spark, kind, i)

    def _delete(self, spark: SparkSession, kind: str, batch_id: int) -> None:
        if batch_id >= 0:  # through Hadoop's file system: the folder may be on any store
            path = spark._jvm.org.apache.hadoop.fs.Path(self._folder(kind, batch_id))
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _job(out_path: str, state: KeyedState, order: str, rows: Callable[[DataFrame], DataFrame], seeds: Callable[[DataFrame], DataFrame],
         step: Callable[[DataFrame], DataFrame], outputs: Sequence[str], shown: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """``rows`` adds the scan's input columns to a micro-batch, ``seeds`` makes rows of
    carried states, ``step`` is the scan (it adds ``outputs``, which are the state at a row
    as well), ``shown`` turns them into the columns that are written."""
    keys = state.keys

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = batch.columns
        # read by the keys, the statistics of the scan and the scan
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        own = rows(batch).withColumns({PLACE: order_number(batch, order), CARRIED: F.lit(False)})
        old = state.before(spark, batch_id, batch.select(*keys).distinct() if keys else None)
        if old is not None:
            own = own.unionByName(seeds(old).withColumn(CARRIED, F.lit(True)), allowMissingColumns=True)
        scanned = step(own).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            new = scanned.where(~F.col(CARRIED))
            shown(new.select(*columns, *outputs)).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            last = scanned.groupBy(*keys).agg(F.max_by(F.struct(*outputs), PLACE).alias("state")).where(F.col("state").isNotNull())
            state.write(last, batch_id)
        finally:
            scanned.unpersist()
            batch.unpersist()

    return run


def running(out_path: str, state_path: str, order: str, columns: Mapping[str, tuple], keys: Sequence[str] = (),
            width: int = DEFAULT_WIDTH, compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: rolling reduce per key with any associative aggregate, one
    output row per row with all its columns.  ``columns``: name -> (aggregate, function of
    two results, value), the value of the result's type."""
    names = list(columns)

    def rows(batch: DataFrame) -> DataFrame:
        return batch.withColumns({f"{VALUE}_{n}": e for n, (_, _, e) in columns.items()})

    def seeds(old: DataFrame) -> DataFrame:
        return old.select(*keys, F.lit(FIRST).alias(PLACE), *[F.col(f"state.{n}").alias(f"{VALUE}_{n}") for n in names])

    def step(every: DataFrame) -> DataFrame:
        return scan.running(every, PLACE, {n: (agg, agg, join, F.col(f"{VALUE}_{n}")) for n, (agg, join, _) in columns.items()}, keys, width)

    return _job(out_path, KeyedState(state_path, keys, compact), order, rows, seeds, step, names, lambda d: d)


def running_sums(out_path: str, state_path: str, order: str, sums: Mapping[str, Column], keys: Sequence[str] = (),
                 width: int = DEFAULT_WIDTH, compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: running sums and counts per key (bigint), as in
    ``scan.running_sums``."""
    return running(out_path, state_path, order, {n: (F.sum, scan._plus, e.cast("long")) for n, e in sums.items()}, keys, width, compact)


def type_counts(out_path: str, state_path: str, order: str, keys: Sequence[str], type_col: str, types: Sequence[str],
                prefix: str = "n_", width: int = DEFAULT_WIDTH, compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: a running count per listed type, as in
    ``operators.rolling.type_counts_by_key``."""
    sums = {f"{prefix}{t}": F.when(F.col(type_col) == t, 1).otherwise(0) for t in types}
    return running_sums(out_path, state_path, order, sums, keys, width, compact)


def last_n(out_path: str, state_path: str, order: str, keys: Sequence[str], n: int, value: str, name: str = "last_n",
           as_text: bool = True, width: int = DEFAULT_WIDTH, compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the last ``n`` values of the key at every row, oldest
    first, as in ``operators.rolling.last_n_by_key``.  The carried list enters as its values."""
    def rows(batch: DataFrame) -> DataFrame:
        return batch.withColumn(VALUE, F.col(value))

    def seeds(old: DataFrame) -> DataFrame:
        each = old.select(*keys, F.posexplode(f"state.{name}").alias("_at", VALUE))
        return each.select(*keys, (F.lit(FIRST) + F.col("_at")).alias(PLACE), VALUE)

    def step(every: DataFrame) -> DataFrame:
        return scan.last_n(every, PLACE, n, F.col(VALUE), name, keys=keys, width=width)

    def shown(d: DataFrame) -> DataFrame:
        return d.withColumn(name, join_ids(F.col(name))) if as_text else d

    return _job(out_path, KeyedState(state_path, keys, compact), order, rows, seeds, step, [name], shown)


def last_n_per_type(out_path: str, state_path: str, order: str, keys: Sequence[str], type_col: str, types: Mapping[str, str], n: int,
                    value: str, as_text: bool = True, width: int = DEFAULT_WIDTH, compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the last ``n`` values of each listed type side by side at
    every row, as in ``operators.rolling.last_n_per_type``."""
    def rows(batch: DataFrame) -> DataFrame:
        return batch.withColumn(VALUE, F.col(value))

    def seeds(old: DataFrame) -> DataFrame:
        parts = []
        for i, (t, c) in enumerate(types.items()):
            each = old.select(*keys, F.posexplode(f"state.{c}").alias("_at", VALUE))
            parts.append(each.select(*keys, F.lit(t).alias(type_col), (F.lit(FIRST + i * n) + F.col("_at")).alias(PLACE), VALUE))
        return reduce(DataFrame.unionByName, parts)

    def step(every: DataFrame) -> DataFrame:
        return batch_rolling.last_n_per_type(every, PLACE, keys, type_col, types, n, VALUE, as_text=False, width=width)

    def shown(d: DataFrame) -> DataFrame:
        return d.withColumns({c: join_ids(F.col(c)) for c in types.values()}) if as_text else d

    return _job(out_path, KeyedState(state_path, keys, compact), order, rows, seeds, step, list(types.values()), shown)
