"""A text sink whose readers see whole micro-batches, once.

``spark.dataSource.register(CommittedText)``, then
``df.writeStream.format("committed_text").option("path", ...)`` for a stream of one string
column.  A task writes its lines to a file of its own and reports the name; when all tasks
of a micro-batch have, the driver writes one manifest with the names.  ``read_lines`` reads
the files of the manifests, so files of killed tasks, speculative copies and repeated
micro-batches are never seen: a micro-batch that has a manifest is not committed again, and
its second files are deleted.  A folder belongs to one query: micro-batch numbers of a
second one would be taken for repeats.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

from eventide.sources.table_stream import file_system

PARTS, MANIFESTS = "parts", "manifests"


@dataclass
class Written(WriterCommitMessage):
    name: str
    lines: int


class CommittedText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_text"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        if len(schema.fields) != 1 or not isinstance(schema.fields[0].dataType, StringType):
            raise ValueError("committed_text writes one string column")
        return CommittedWriter(self.options["path"])


class CommittedWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, path = file_system(self.path)
        name, n = f"{uuid.uuid4().hex}.txt", 0
        fs.create_dir(f"{path}/{PARTS}", recursive=True)
        with fs.open_output_stream(f"{path}/{PARTS}/{name}") as f:
            for row in iterator:
                f.write(f"{'' if row[0] is None else row[0]}\n".encode())
                n += 1
        return Written(name, n)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, path = file_system(self.path)
        manifest = f"{path}/{MANIFESTS}/{batchId:020}.json"
        if fs.get_file_info(manifest).type == pafs.FileType.File:
            self.abort(messages, batchId)  # a repeat
            return
        fs.create_dir(f"{path}/{MANIFESTS}", recursive=True)
        with fs.open_output_stream(f"{manifest}.new") as f:
            for m in messages:
                if m is not None and m.lines:
                    f.write((json.dumps({"name": m.name, "lines": m.lines, "batch_id": batchId}) + "\n").encode())
        fs.move(f"{manifest}.new", manifest)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        fs, path = file_system(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{path}/{PARTS}/{m.name}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines: ``value``."""
    path = path.rstrip("/")
    names = spark.read.schema("name string, lines long, batch_id long").json(f"{path}/{MANIFESTS}/*.json")
    # the folder is listed by Spark; only files of a manifest are kept
    lines = spark.read.text(f"{path}/{PARTS}").withColumn("name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return lines.join(names.select("name"), "name", "left_semi").select("value")
