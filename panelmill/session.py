"""Session settings that the package's plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024
MAX_PARTITIONS = 50_000


def cluster_settings(shuffled_bytes: int) -> dict[str, str]:
    """Settings for a job that shuffles about this much.

    Adaptive execution joins small shuffle partitions but cannot split the
    ordinary ones, so the initial number must fit the data: about 128 MB each,
    until the bookkeeping for so many partitions would cost more than spilling.
    """
    partitions = min(max(200, -(-shuffled_bytes // PARTITION_BYTES)), MAX_PARTITIONS)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
        "spark.sql.parquet.compression.codec": "snappy",
    }


def session(name: str, shuffled_bytes: int | None = None) -> SparkSession:
    """The running session or a new one; master and memory come from the submitter."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    if shuffled_bytes:
        for key, value in cluster_settings(shuffled_bytes).items():
            builder = builder.config(key, value)
    return builder.getOrCreate()
