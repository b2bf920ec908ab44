"""Replay of event files as a stream, and the end-of-stream sentinel.

A Structured Streaming file source reads a folder; with
``maxFilesPerTrigger=1`` each file is one micro-batch, which is how tests
control batch boundaries.  A finite replay in append mode leaves the last
windows open (their end is never passed by the watermark); a final file
with one event far in the future (the *sentinel*) moves the watermark past
every real window, so all of them are emitted, while the sentinel's own
window stays open and never shows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL_TIME = dt.datetime(2200, 1, 1)


def replay_stream(spark: SparkSession, folder: str, schema: T.StructType,
                  files_per_batch: int = 1, fmt: str = "parquet") -> DataFrame:
    """Stream the files of ``folder`` in arrival order, ``files_per_batch``
    files per micro-batch."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", str(files_per_batch)).load(folder))


def sentinel_row(df: DataFrame, time_col: str, at: dt.datetime = SENTINEL_TIME, **values) -> DataFrame:
    """One row shaped like ``df`` with ``time_col`` far in the future and
    other columns null unless given."""
    cols = []
    for f in df.schema.fields:
        if f.name == time_col:
            cols.append(F.lit(at).cast(f.dataType).alias(f.name))
        elif f.name in values:
            cols.append(F.lit(values[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.sparkSession.range(1).select(*cols)
