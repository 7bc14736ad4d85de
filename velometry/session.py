"""A session with the settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins carry no broadcast hints except for single rows: a side is broadcast
# only where its known or measured size is below Spark's threshold, and is
# shuffled otherwise.  Adaptive execution splits skewed partitions and merges
# small ones, so the number of shuffle partitions may be generous.  Two open files
# spare the sort before a write into two folders (accepted and refused rows).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "velometry", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with ``SETTINGS``, overridden by ``settings`` with _ for dots.

    ``spark.checkpoint.dir`` should name a shared folder on a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
