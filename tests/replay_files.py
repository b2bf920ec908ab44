"""Replay fixtures: one parquet file per micro-batch, on the local disk."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def write_batch_file(df: DataFrame, folder: str, index: int) -> str:
    """Write ``df`` as one parquet file ``folder/batch-<index>.parquet``.

    Meant for replay fixtures on a local file system (it renames files with
    ``os``), not for cluster storage: the rows go through Spark's own writer into a
    scratch folder, then the single part file is moved next to the others,
    with a modification time that keeps the files in index order.
    """
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder + ".staging", f"b{index:06d}")
    df.coalesce(1).write.mode("overwrite").parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.startswith("part-") and f.endswith(".parquet"))
    dest = os.path.join(folder, f"batch-{index:06d}.parquet")
    os.replace(os.path.join(tmp, part), dest)
    stamp = 1_000_000_000 + index
    os.utime(dest, (stamp, stamp))
    return dest
