"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Days and hours of logs follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Joins and rebalanced writes rely on it for hot keys and for choosing broadcasts by size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where a later step would have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # State larger than memory, and small changelog uploads per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a session builder. Master, memory and shuffle partitions stay with the
    one who submits the job."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
