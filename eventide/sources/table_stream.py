"""A table as a continuous source: its Parquet row groups in file order, as a stream.

``spark.dataSource.register(TableStream)``, then
``spark.readStream.format("event_table").option("path", ...).load()``.  No file is copied.
An offset is the number of row groups that have been read; new files, whose names must
sort behind the ones there (as appending writers name them), are picked up by later
micro-batches.  A partition is one row group, read as Arrow batches.

``maxRowGroups`` bounds a micro-batch.  The source has to remember then how far it has let
the query go, across restarts too: in the small file ``progress``, on shared storage.  The
query's own checkpoint decides what has been processed; a progress that is ahead of it
makes one larger micro-batch, never a lost or repeated row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

OFFSET = "row_groups"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class RowGroup(InputPartition):
    def __init__(self, path: str, number: int):
        super().__init__((path, number))
        self.path, self.number = path, number


class TableStream(DataSource):
    """Options: ``path`` (a Parquet file or a folder of them), ``maxRowGroups`` and ``progress``."""

    @classmethod
    def name(cls) -> str:
        return "event_table"

    def schema(self) -> StructType:
        fs, path = file_system(self.options["path"])
        files = table_files(fs, path)
        if not files:
            raise ValueError(f"no Parquet file in {path}: state a schema")
        with fs.open_input_file(files[0]) as f:
            return from_arrow_schema(pq.read_schema(f), prefer_timestamp_ntz=True)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RowGroupReader(dict(self.options), schema)


def table_files(fs: pafs.FileSystem, path: str) -> list[str]:
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [path]
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f.path for f in found if f.type == pafs.FileType.File and f.path.endswith(".parquet"))


class RowGroupReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        lower = {k.lower(): v for k, v in options.items()}
        self.path, self.schema = lower["path"], schema
        self.most = int(lower["maxrowgroups"]) if "maxrowgroups" in lower else None
        self.progress = lower.get("progress")
        if self.most is not None and (self.most < 1 or not self.progress):
            raise ValueError("maxRowGroups must be 1 or more and needs a progress file")
        self.counts: dict[str, int] = {}  # row groups of each file; files do not change

    def row_groups(self) -> list[tuple[str, int]]:
        fs, path = file_system(self.path)
        files = table_files(fs, path)
        for file in files:
            if file not in self.counts:
                with fs.open_input_file(file) as f:
                    self.counts[file] = pq.read_metadata(f).num_row_groups
        return [(file, i) for file in files for i in range(self.counts[file])]

    def initialOffset(self) -> dict:
        return {OFFSET: 0}

    def latestOffset(self) -> dict:
        there = len(self.row_groups())
        if self.most is None:
            return {OFFSET: there}
        fs, path = file_system(self.progress)
        known = 0
        if fs.get_file_info(path).type == pafs.FileType.File:
            with fs.open_input_stream(path) as f:
                known = json.loads(f.read())[OFFSET]
        offset = {OFFSET: min(there, known + self.most)}
        if offset[OFFSET] > known:
            with fs.open_output_stream(f"{path}.new") as f:
                f.write(json.dumps(offset).encode())
            fs.move(f"{path}.new", path)
        return offset

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [RowGroup(*g) for g in self.row_groups()[start[OFFSET]:end[OFFSET]]]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        wanted = to_arrow_schema(self.schema)
        with fs.open_input_file(partition.path) as f:
            rows = pq.ParquetFile(f).read_row_group(partition.number, columns=wanted.names)
        yield from rows.select(wanted.names).cast(wanted).to_batches(max_chunksize=10_000)
