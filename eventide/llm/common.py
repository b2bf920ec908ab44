"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the word separators of the contracts: \x09-\x0D and space.
ASCII_SPACE = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that clashes with none of ``taken`` (Spark resolves names
    without regard to case)."""
    names, name = {c.lower() for c in taken}, f"_llm_{base}"
    while name.lower() in names:
        name += "_"
    return name


def ref(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also folds other alphabets)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one of our
    own only where that is unset and all tasks run on this machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root or os.path.join(tempfile.gettempdir(), "eventide-checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
