"""The driver's ``events`` table in canonical form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.sources.events import normalize, read_table

# Mapping of the driver's ``events`` table onto the canonical names.
# quantity: floor the double first (cast truncates the same for the
# non-negative values in the table, but floor states the intent).
EVENTS_TABLE_MAPPING: dict[str, str] = {
    "seq": "event_id",
    "event_time": "ts",
    "event_type": "event_type",
    "user_id": "user_id",
    "quantity": "CAST(FLOOR(value) % 10 AS INT)",
    "sku": "props",
}


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table in canonical form (batch)."""
    return normalize(read_table(spark, sf_dir, "events"), EVENTS_TABLE_MAPPING)
