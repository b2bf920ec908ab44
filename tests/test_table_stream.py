"""A table as a stream source, and the committed text sink: restarts, kills and repeats."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventide.plans import catalog
from eventide.plans.tables import EVENTS_TABLE_MAPPING
from eventide.sources.events import normalize
from eventide.sources.table_stream import TableStream
from eventide.streaming import committed
from eventide.streaming import windows as swin
from eventide.schema import Kinds
from tests.conftest import SF0001


@pytest.fixture()
def table(spark, scratch):
    """The events in row groups of 100, two files."""
    spark.dataSource.register(TableStream)
    rows = pq.read_table(f"{SF0001}/events.parquet").sort_by("event_id")
    folder = os.path.join(scratch, "table")
    os.makedirs(folder)
    pq.write_table(rows.slice(0, 500), f"{folder}/part-0.parquet", row_group_size=100)
    pq.write_table(rows.slice(500, 250), f"{folder}/part-1.parquet", row_group_size=100)
    return folder, rows


def _start(df, scratch, name, checkpoint="cp"):
    return df.writeStream.format("parquet").option("path", f"{scratch}/{name}").option("checkpointLocation", f"{scratch}/{checkpoint}").start()


def test_stream_of_row_groups_with_new_files_and_restarts(spark, scratch, table):
    folder, rows = table

    def source(**options):
        return spark.readStream.format("event_table").option("path", folder).options(**options).load()

    limits = {"maxRowGroups": "2", "progress": f"{scratch}/progress"}
    assert source().schema == spark.read.parquet(f"{SF0001}/events.parquet").schema
    q = _start(source(**limits), scratch, "out")
    q.processAllAvailable()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    q.stop()
    assert sizes == [200, 200, 200, 150]
    pq.write_table(rows.slice(750, rows.num_rows - 750), f"{folder}/part-2.parquet", row_group_size=50)
    q = _start(source(**limits), scratch, "out")  # the same checkpoint: goes on behind the 750 rows
    q.processAllAvailable()
    assert max(p["numInputRows"] for p in q.recentProgress) <= 100
    q.stop()
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == rows.num_rows == got.select("event_id").distinct().count()
    with pytest.raises(Exception, match="progress file"):
        _start(source(maxRowGroups="2"), scratch, "other", "cp2").processAllAvailable()


def test_windows_over_the_table_stream_equal_the_batch(spark, scratch, table):
    folder, rows = table
    pq.write_table(rows.slice(750, rows.num_rows - 750), f"{folder}/part-2.parquet")
    last = pa.Table.from_pylist([{**rows.slice(0, 1).to_pylist()[0], "event_id": 10 ** 9, "ts": __import__("datetime").datetime(2100, 1, 1), "event_type": "x"}], rows.schema)
    pq.write_table(last, f"{folder}/part-3.parquet")
    raw = spark.readStream.format("event_table").option("path", folder).load()
    ev = normalize(raw, EVENTS_TABLE_MAPPING, to_instant=True)
    out = swin.stream_window_counts(ev, "event_time", "1 hour", Kinds.events_table().is_registered, "0 seconds")
    q = _start(out, scratch, "w")
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(f"{scratch}/w").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_match")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, catalog.ev_tumbling_count(spark, SF0001).select("window_start", "n_match").collect()))


def test_killed_and_repeated_batches_leave_no_partial_or_double_line(spark, scratch, table):
    folder, rows = table
    spark.dataSource.register(committed.CommittedText)
    flag, out = f"{scratch}/flag", f"{scratch}/lines"

    def run():
        @F.udf("string")
        def line(i):
            if i == 620 and not os.path.exists(flag):  # dies in the second micro-batch, once
                open(flag, "w").close()
                raise RuntimeError("killed")
            return f"event {i}"

        src = spark.readStream.format("event_table").option("path", folder).option("maxRowGroups", "3").option("progress", f"{scratch}/p").load()
        q = src.select(line("event_id").alias("value")).writeStream.format("committed_text").option("path", out).option("checkpointLocation", f"{scratch}/cpl").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    with pytest.raises(Exception, match="killed"):
        run()
    seen = committed.read_lines(spark, out).count()
    assert 0 < seen < 750
    run()
    lines = sorted(r["value"] for r in committed.read_lines(spark, out).collect())
    assert lines == sorted(f"event {i}" for i in rows.slice(0, 750).column("event_id").to_pylist())
    writer = committed.CommittedWriter(out)  # a repeat of the first micro-batch, and a task that never reports
    again = writer.write(iter([("event 0",)]))
    writer.write(iter([("lost",)]))
    writer.commit([again, None], 0)
    assert sorted(r["value"] for r in committed.read_lines(spark, out).collect()) == lines
    assert not os.path.exists(f"{out}/{committed.PARTS}/{again.name}")
    with pytest.raises(ValueError, match="one string column"):
        committed.CommittedText({"path": out}).streamWriter(spark.range(1).schema, False)
