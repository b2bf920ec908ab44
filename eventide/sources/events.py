"""Event intake: tables and file streams mapped onto the canonical schema.

``read_events`` replaces the reference's random in-process generators with
what a Spark user has: a table or a folder of files.  The mapping is a list
of column expressions, so Catalyst prunes every unused column and pushes
filters written on the mapped columns down to the parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def normalize(df: DataFrame, mapping: Mapping[str, str | Column],
              to_instant: bool = False) -> DataFrame:
    """Project ``df`` onto canonical column names.

    ``mapping`` maps output name -> source column name or SQL expression (or
    a Column).  ``to_instant`` casts ``event_time`` to TIMESTAMP (an instant),
    which watermarks require; batch queries may keep TIMESTAMP_NTZ.
    """
    cols = []
    for out, src in mapping.items():
        c = src if isinstance(src, Column) else F.expr(src)
        if out == "event_time" and to_instant:
            c = c.cast(T.TimestampType())
        cols.append(c.alias(out))
    return df.select(*cols)


def read_events(spark: SparkSession, path: str,
                mapping: Mapping[str, str | Column], *,
                streaming: bool = False, schema: T.StructType | None = None,
                max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Read an event table (batch) or a folder of event files (stream).

    A stream needs a fixed schema; when none is given it is taken from the
    files once (a batch read of the footers only).  In streaming mode
    ``event_time`` is cast to TIMESTAMP so that ``withWatermark`` accepts it.
    """
    if not streaming:
        return normalize(spark.read.format(fmt).load(path), mapping)
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return normalize(reader.load(path), mapping, to_instant=True)


def server_events(df: DataFrame, strict: bool = True) -> DataFrame:
    """Game-server events: adds the derived ``identity`` and, with ``strict``,
    fails rows whose ``game_type`` is not one of the fixed game types (the enum
    check of the typed original) by turning them into an error at run time."""
    from eventide.functions.exprs import one_of, player_identity
    from eventide.schema import GAME_TYPES
    out = df.withColumn("identity", player_identity())
    if strict and "game_type" in df.columns:
        out = out.withColumn("game_type", F.when(one_of("game_type", GAME_TYPES), F.col("game_type"))
                             .otherwise(F.raise_error(F.concat(F.lit("unknown game type: "), F.col("game_type")))))
    return out


def number_sequence(spark: SparkSession, start: int, end: int,
                    num_partitions: int | None = None) -> DataFrame:
    """Inclusive integer range, column ``n`` (Spark's own end is exclusive)."""
    return spark.range(start, end + 1, numPartitions=num_partitions).withColumnRenamed("id", "n")
