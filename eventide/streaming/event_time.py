"""Windows and global sessions on streams under a watermark that moves with every event.

Spark moves its watermark once per micro-batch, so what counts as late depends on how the
stream was cut.  These ``foreachBatch`` jobs carry the watermark, the largest emitted so far
(``operators.watermarks``), from batch to batch and judge each event by the one that it
meets, so any cut gives the result of the whole table.

What is open is a table: the sums of windows, or sessions, that the watermark has not passed.
A micro-batch aggregates its own rows in parallel, adds them to what is open, reports
what the watermark has passed by its end and writes the rest as the next carry.  No event
that comes in time can still belong to what has been reported.

Output per micro-batch: ``out/windows/batch_id=<n>`` (or ``out/sessions``) and
``out/late/batch_id=<n>``, the rows that were dropped.  A repeated micro-batch reads the
same carry and overwrites its output; a missing carry fails it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators import watermarks, windows
from eventide.operators.scan import DEFAULT_WIDTH, running_max
from eventide.operators.watermarks import WATERMARK
from eventide.operators.windows import END, START
from eventide.streaming.carry import CarryStore


def _job(out_path: str, carry_path: str, name: str, order: str, emitted: Column, width: int,
         late: Callable[[DataFrame], DataFrame], opened: Callable[[DataFrame, DataFrame | None], DataFrame],
         is_over: Callable[[Column], Column]) -> Callable[[DataFrame, int], None]:
    """``late`` adds the column of that name to rows with their watermark, ``opened`` makes the
    open table of rows in time and the one before."""
    mark, open_ = CarryStore(f"{carry_path}/watermark"), CarryStore(f"{carry_path}/open")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        batch = batch.persist()
        try:
            before = mark.before(spark, batch_id)
            last = batch.agg(F.max(emitted).alias(WATERMARK))
            kind = last.schema[WATERMARK].dataType
            carried = F.lit(before[WATERMARK] if before else None).cast(kind)
            marked = watermarks.with_watermark(batch, order, emitted, width=width)
            judged = late(marked.withColumn(WATERMARK, F.greatest(F.col(WATERMARK), carried))).persist()
            now = last.select(F.greatest(F.col(WATERMARK), carried).alias(WATERMARK)).first()[0]
            every = opened(judged.where(~F.col("late")), open_.table_before(spark, batch_id)).persist()
            over = F.coalesce(is_over(F.lit(now).cast(kind)), F.lit(False))
            every.where(over).write.mode("overwrite").parquet(f"{out_path}/{name}/batch_id={batch_id}")
            judged.where("late").select(*columns, WATERMARK).write.mode("overwrite").parquet(f"{out_path}/late/batch_id={batch_id}")
            open_.write_table(every.where(~over), batch_id)
            mark.write(spark.range(1).select(F.lit(now).cast(kind).alias(WATERMARK)), batch_id)
            every.unpersist()
            judged.unpersist()
        finally:
            batch.unpersist()

    return run


def on_time_windows(out_path: str, carry_path: str, order: str, time_col: str, size: str, measures: Mapping[str, Column],
                    emitted: Column, keys: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: sums per tumbling window (and key) of the events in time, each
    window once, when the watermark has passed it: ``watermarks.on_time_sums`` on a stream."""
    keys, names = list(keys), list(measures)

    def late(marked: DataFrame) -> DataFrame:
        w = marked.withColumn("_w", F.window(time_col, size)).withColumns({START: F.col("_w.start"), END: F.col("_w.end")})
        return w.drop("_w").withColumn("late", watermarks.is_late())

    def opened(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        own = rows.select(START, END, *keys, *[e.cast("long").alias(n) for n, e in measures.items()])
        every = own if before is None else own.unionByName(before)
        return every.groupBy(START, END, *keys).agg(*[F.sum(n).cast("long").alias(n) for n in names])

    def is_over(now: Column) -> Column:
        return now >= F.timestamp_add("MICROSECOND", F.lit(-watermarks.TICK_US).cast("long"), F.col(END))

    return _job(out_path, carry_path, "windows", order, emitted, width, late, opened, is_over)


def global_sessions(out_path: str, carry_path: str, order: str, time_col: str, gap: str, measures: Mapping[str, Column],
                    emitted: Column, width: int = DEFAULT_WIDTH) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: sessions of the whole stream, without a key, each reported once
    the watermark has passed its end.  An event is late once the watermark has reached its
    time; the sessions of those in time are ``windows.sessions`` of them, however the stream
    was cut.  A micro-batch's own sessions come from the skew-proof scan, and are then
    merged with the open ones as intervals."""
    names = list(measures)

    def late(marked: DataFrame) -> DataFrame:
        return marked.withColumn("late", F.coalesce(F.col(WATERMARK) >= F.col(time_col), F.lit(False)))

    def opened(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        own = windows.sessions(rows, time_col, gap, measures, width=width)
        return own if before is None else merged_sessions(own.unionByName(before), names, width)

    def is_over(now: Column) -> Column:
        return now >= F.col(END)

    return _job(out_path, carry_path, "sessions", order, emitted, width, late, opened, is_over)


def merged_sessions(sessions: DataFrame, names: Sequence[str], width: int = DEFAULT_WIDTH) -> DataFrame:
    """Sessions that touch (a start no later than another's end) as one, measures added up."""
    starts = sessions.groupBy(START).agg(F.max(END).alias(END), *[F.sum(n).cast("long").alias(n) for n in names])
    reach = running_max(starts, START, "_reach", F.col(END), width=width, before=True)
    new = F.col("_reach").isNull() | (F.col(START) > F.col("_reach"))
    first = running_max(reach.withColumn("_new", F.when(new, F.col(START))), START, "_first", F.col("_new"), width=width)
    out = first.groupBy("_first").agg(F.max(END).alias(END), *[F.sum(n).cast("long").alias(n) for n in names])
    return out.select(F.col("_first").alias(START), END, *names)
