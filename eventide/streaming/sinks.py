"""Sinks: text files, one-folder-per-route writes, console, checkpointed starts.

* ``write_text`` / ``stream_text``: UTF-8 text, one value per line (the
  row-format file sink).  ``single_file=True`` is the parallelism-1 sink: an
  opt-in ``coalesce(1)`` for small outputs only.
* ``write_routes`` / ``route_writer``: one input, several outputs by
  predicate, in one pass (``transform.routes`` + ``partitionBy("route")``);
  the streaming form is a ``foreachBatch`` function that writes each
  micro-batch under ``batch_id=<n>`` so a replayed batch overwrites itself.
* ``start``: ``writeStream`` with a checkpoint location (the query's offsets,
  commits and state) and a processing-time trigger (the checkpoint interval).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators.transform import routes


def _as_text(df: DataFrame, col: str | Column) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.cast("string").alias("value"))


def write_text(df: DataFrame, path: str, col: str | Column, single_file: bool = False,
               mode: str = "overwrite") -> None:
    out = _as_text(df, col)
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def stream_text(stream: DataFrame, path: str, checkpoint: str, col: str | Column,
                trigger: dict | None = None) -> StreamingQuery:
    w = _as_text(stream, col).writeStream.format("text").option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path)


def write_routes(df: DataFrame, routes_: Mapping[str, tuple[Column, Column]], base: str,
                 keep_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write each route's values to ``base/route=<name>/`` in one job."""
    out = routes(df, routes_, keep_cols=keep_cols)
    cols = [*keep_cols, "tag"]
    if cols == ["tag"]:
        out.select("route", F.col("tag").alias("value")).write.mode(mode).partitionBy("route").text(base)
    else:
        out.write.mode(mode).partitionBy("route").parquet(base)


def route_writer(routes_: Mapping[str, tuple[Column, Column]], base: str,
                 keep_cols: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: every micro-batch's routes, in one write,
    under ``base/batch_id=<n>/route=<name>/`` (idempotent on replay)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write_routes(batch, routes_, f"{base}/batch_id={batch_id}", keep_cols=keep_cols)
    return run


def batch_writer(base: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: every micro-batch's rows under
    ``base/batch_id=<n>/`` (idempotent on replay)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")
    return run


def console(stream: DataFrame, output_mode: str = "append", truncate: bool = False) -> StreamingQuery:
    """Print every micro-batch (the print sink)."""
    return (stream.writeStream.format("console").outputMode(output_mode)
            .option("truncate", str(truncate).lower()).start())


def start(stream: DataFrame, checkpoint: str, *, fmt: str = "parquet", path: str | None = None,
          output_mode: str = "append", interval: str | None = "5 seconds",
          available_now: bool = False, query_name: str | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start a checkpointed streaming query.

    ``interval`` is the micro-batch (and so checkpoint) interval;
    ``available_now`` processes what is there and stops (for replays).
    Restarting with the same ``checkpoint`` resumes after the last committed
    micro-batch with the saved state.
    """
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(fmt)
    return w.start(path) if path else w.start()
