"""``foreachBatch`` jobs that carry a few numbers from one micro-batch to the next.

Two reports need an order over the whole stream, which a streaming query
cannot express (a global aggregate after a window aggregate is refused, and
so is a non-time window function):

* the global count trigger: every n-th event overall, with the number of
  matches among all events so far;
* the best window so far: for each closed window, the best of all windows
  closed up to it.

Each micro-batch is a bounded DataFrame, so the batch operators run on it in
parallel; only the carry (a handful of numbers) goes from batch to batch.
The carry and the output are written per ``batch_id`` under the query's
shared checkpoint folder, so a micro-batch replayed after a failure
overwrites its own output and reads the same carry: exactly once.  A missing
carry fails the micro-batch instead of restarting the count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.exprs import epoch_us
from eventide.operators.scan import DEFAULT_WIDTH, running_max, running_sums
from eventide.operators.windows import END, START


class MissingCarry(RuntimeError):
    """The carry of the micro-batch before is not there: counting on would guess."""


class CarryStore:
    """One small table per micro-batch at ``path/batch_id=<n>`` (parquet).

    The carries of the last ``keep`` micro-batches stay (a replay needs one);
    older ones are deleted.
    """

    def __init__(self, path: str, keep: int = 100):
        self.path, self.keep = path, max(2, keep)

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def before(self, spark: SparkSession, batch_id: int) -> dict | None:
        """Carry written by the batch before ``batch_id`` (None at start, or if that
        batch had nothing to carry).

        Micro-batch ids are consecutive, so this is the folder of
        ``batch_id - 1``: one small read however long the stream has run.  A
        replayed batch reads the same folder again, so it gets the same carry.  If
        the folder is missing the batch fails.
        """
        table = self.table_before(spark, batch_id)
        rows = [] if table is None else table.collect()
        return rows[0].asDict() if rows else None

    def table_before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The carry as a table, of any size; None at the start."""
        if batch_id <= 0:
            return None
        try:
            return spark.read.parquet(self._folder(batch_id - 1))
        except AnalysisException as e:
            raise MissingCarry(f"micro-batch {batch_id} needs the carry of {batch_id - 1} in {self.path}") from e

    def write(self, row: DataFrame, batch_id: int) -> None:
        self.write_table(row.coalesce(1), batch_id)

    def write_table(self, table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(self._folder(batch_id))
        self._delete(table.sparkSession, batch_id - self.keep)

    def _delete(self, spark: SparkSession, batch_id: int) -> None:
        if batch_id >= 0:  # through Hadoop's file system: the folder may be on any store
            path = spark._jvm.org.apache.hadoop.fs.Path(self._folder(batch_id))
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _write_output(df: DataFrame, out_path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")


def global_count_trigger(out_path: str, carry_path: str, order: str, n: int, match: Column,
                         width: int = DEFAULT_WIDTH) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: fire every n-th event of the whole stream.

    Output rows: fire, n_seen, n_match (matches among all events so far), as
    in the batch ``counting.count_trigger``.  Events of a later micro-batch
    count after all events of earlier ones (arrival order), and within a
    micro-batch in ``order``.
    """
    return _count_trigger(out_path, carry_path, order, n, match, (), False, width)


def window_count_trigger(out_path: str, carry_path: str, order: str, n: int, match: Column,
                         purge: bool = False, width: int = DEFAULT_WIDTH) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over rows that carry the processing-time window of
    their micro-batch (``window_start``, ``window_end``): fire every n-th event
    of each window, with the matches so far in the window, or among the last n
    events with ``purge``.

    All rows of a micro-batch have one arrival time, so one window, which goes on
    from the micro-batch before if that had the same; closed windows leave no state.
    """
    return _count_trigger(out_path, carry_path, order, n, match, (START, END), purge, width)


def _count_trigger(out_path: str, carry_path: str, order: str, n: int, match: Column, window: Sequence[str],
                   purge: bool, width: int) -> Callable[[DataFrame, int], None]:
    if n < 1:
        raise ValueError("n must be >= 1")
    store = CarryStore(carry_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # read by the statistics, the scan, its totals and the carry: once from the source
        batch = batch.withColumn("_m", F.when(match, 1).otherwise(0).cast("long")).persist()
        try:
            c = store.before(spark, batch_id)
            places = [batch.select(*window).first()] if window else []
            if window and not places[0]:  # an empty micro-batch: nothing fires, the carry stays
                _write_output(_fires(batch, order, n, window, purge, 0, 0, 0, width), out_path, batch_id)
                store.write(_row(spark, c) if c else batch.limit(0).select(*window, *[F.lit(0).cast("long").alias(k) for k in ("seen", "matched", "open")]), batch_id)
                return
            if not c or any(c[w] != places[0][w] for w in window):
                c = {"seen": 0, "matched": 0, "open": 0}
            seen, matched, open_ = c["seen"], c["matched"], c["open"]
            _write_output(_fires(batch, order, n, window, purge, seen, matched, open_, width), out_path, batch_id)
            total = batch.agg(*[F.first(w).alias(w) for w in window], (F.count("*") + seen).alias("seen"),
                              (F.coalesce(F.sum("_m"), F.lit(0)) + matched).alias("matched"))
            # matches of the group that has not fired yet: those after the last fire
            tail = F.col("seen") % n
            rest = _positions(batch, order, width).withColumn("_s", F.col("_p") + seen).alias("p").join(
                F.broadcast(total.alias("t")), F.col("_s") > F.col("t.seen") - tail).agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("r"))
            now = total.crossJoin(rest)  # one row each
            kept = F.when(tail == 0, F.lit(0)).when(F.col("seen") - tail <= seen, F.col("r") + (open_ if seen % n else 0)).otherwise(F.col("r"))
            store.write(now.select(*window, "seen", "matched", kept.cast("long").alias("open")), batch_id)
        finally:
            batch.unpersist()

    return run


def _row(spark: SparkSession, c: dict) -> DataFrame:
    return spark.createDataFrame([tuple(c.values())], list(c))


def _positions(batch: DataFrame, order: str, width: int) -> DataFrame:
    return running_sums(batch, order, {"_p": F.lit(1).cast("long"), "_q": F.col("_m")}, width=width)


def _fires(batch: DataFrame, order: str, n: int, window: Sequence[str], purge: bool, seen: int, matched: int,
           open_: int, width: int) -> DataFrame:
    """Rows of the fires; ``seen`` and ``matched`` events came earlier, ``open_``
    matches of them since the last fire."""
    pos = _positions(batch, order, width).withColumn("_s", F.col("_p") + F.lit(int(seen)))
    if not purge:
        return pos.where(F.col("_s") % n == 0).select(*window, F.expr(f"_s div {int(n)}").alias("fire"),
                                                      F.col("_s").alias("n_seen"), (F.col("_q") + F.lit(int(matched))).alias("n_match"))
    group = F.expr(f"(_s - 1) div {int(n)}")
    g = pos.groupBy(*window, group.alias("_g")).agg(F.max("_s").alias("_end"), F.sum("_m").alias("_n"))
    first = F.lit(int(open_) if seen % n else 0)
    return g.where(F.col("_end") % n == 0).select(
        *window, (F.col("_g") + 1).alias("fire"), F.lit(n).cast("long").alias("n_seen"),
        (F.col("_n") + F.when(F.col("_g") == seen // n, first).otherwise(F.lit(0))).cast("long").alias("n_match"))


def best_window_so_far(out_path: str, carry_path: str, value: str = "net",
                       width: int = DEFAULT_WIDTH) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over an append-mode window aggregate: for
    each window closed in this micro-batch (start order), the best window
    closed so far; the first of equal windows wins."""
    store = CarryStore(carry_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        # a stateful aggregate: run it once for the scan, the output and the carry
        batch = batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    def step(batch: DataFrame, batch_id: int) -> None:
        c = store.before(batch.sparkSession, batch_id)
        rank = F.struct(F.col(value).cast("long").alias("v"), (-epoch_us(START)).alias("o"),
                        F.col(START).alias("s"), F.col(END).alias("e"))
        scanned = running_max(batch, START, "_b", rank, width=width)
        if c is not None:
            prev = F.struct(F.lit(c["v"]).cast("long").alias("v"), F.lit(c["o"]).cast("long").alias("o"),
                            F.lit(c["s"]).cast(batch.schema[START].dataType).alias("s"),
                            F.lit(c["e"]).cast(batch.schema[END].dataType).alias("e"))
            scanned = scanned.withColumn("_b", F.greatest(F.col("_b"), prev))
        out = scanned.select(START, F.col("_b.s").alias("best_start"), F.col("_b.e").alias("best_end"),
                             F.col("_b.v").alias(f"best_{value}"))
        _write_output(out, out_path, batch_id)
        best = batch.agg(F.max(rank).alias("b"))
        if c is not None:
            best = best.select(F.greatest(F.col("b"), prev).alias("b"))
        store.write(best.where(F.col("b").isNotNull()).select("b.*"), batch_id)

    return run
