"""Session settings the library is tuned for.  All of them are plain Spark settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Re-plan joins and partition counts from measured shuffle sizes, and split skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A merge joins on the bucket columns plus the partition column, if any: the buckets still fit.
    # Set for the session, because table builds run in parallel threads of one session.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Tables and staged copies are written more often than the processor is short of time.
    "spark.sql.parquet.compression.codec": "zstd",
    # What a task sorts before a shuffle stays in memory: a parquet row is many times larger there.
    "spark.sql.files.maxPartitionBytes": "32MB",
    # Tasks write into a few partitions at once instead of sorting their rows by partition.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # One meaning for timestamps and partition values wherever a job runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RECOMMENDED` to a running session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark
