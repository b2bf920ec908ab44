"""Spark session settings shared by the library, the tests and the bench.

Everything here is plain Spark configuration: UTC session time, adaptive query
execution (partition coalescing, skew-join splitting, runtime broadcast only
when a shuffle stage is measured small), the RocksDB state store for streams and
unix-socket state servers for Python stateful processors.  The web UI stays off.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from planning-time estimates (they come from compressed
    # file sizes and can be far off).  AQE turns a sort-merge join into a
    # broadcast join only after the build side's shuffle output was measured
    # below this size: a proven bound, with the sort-merge join beyond it.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
}


def get_session(master: str | None = None, app: str = "eventide",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster the submitter decides both.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
