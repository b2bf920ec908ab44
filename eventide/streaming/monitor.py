"""Progress listener and late-row metrics.

The reference prints a line at every checkpoint; Spark commits once per
micro-batch and reports it through ``StreamingQueryListener.onQueryProgress``
(batch id, timestamp, input rows, state operator metrics).  Rows dropped as
too late by a watermark show in the state operators'
``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Totals per query (by name, or id if it has none) since the listener was
    attached, and the last ``keep`` micro-batches as small dicts."""

    def __init__(self, keep: int = 1000):
        self._lock = threading.Lock()
        self.events: deque[dict] = deque(maxlen=keep)
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = {
            "name": p.name or str(p.id), "batch_id": p.batchId, "timestamp": p.timestamp,
            "input_rows": p.numInputRows,
            "dropped_by_watermark": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
        }
        with self._lock:
            self.events.append(seen)
            total = self.totals.setdefault(seen["name"], {"batches": 0, "input_rows": 0, "dropped_by_watermark": 0})
            total["batches"] += 1
            for k in ("input_rows", "dropped_by_watermark"):
                total[k] += seen[k]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def for_query(self, name: str) -> list[dict]:
        """The kept micro-batches of a query."""
        with self._lock:
            return [e for e in self.events if e["name"] == name]

    def dropped(self, name: str) -> int:
        """All rows of a query that a watermark has dropped as late."""
        with self._lock:
            return self.totals.get(name, {}).get("dropped_by_watermark", 0)


def attach(spark: SparkSession, keep: int = 1000) -> ProgressLog:
    log = ProgressLog(keep)
    spark.streams.addListener(log)
    return log
