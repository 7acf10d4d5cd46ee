"""Session settings for a cluster, from the size of the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1 << 20
# Shuffled rows are narrow (keys and an instant), roughly a quarter of the bytes scanned.
SHUFFLED_SHARE = 4
LARGE_INPUT = 10 << 40


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Adaptive execution with scan splits and shuffle partitions that fit a task's memory.

    Small neighbouring partitions are merged again at run time and oversized ones split. Above
    10 TiB both sizes grow, since the number of shuffle blocks is their product: 100 TB on 8,000
    cores give about 93,000 scan tasks and 48,000 partitions of half a gigabyte.
    """
    large = input_bytes > LARGE_INPUT
    split, partition = (1024 * MIB, 512 * MIB) if large else (128 * MIB, 128 * MIB)
    wanted = max(input_bytes // SHUFFLED_SHARE // partition, 1)
    partitions = str(-(-wanted // cores) * cores)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def configured(builder: SparkSession.Builder, input_bytes: int, cores: int) -> SparkSession.Builder:
    for name, value in cluster_settings(input_bytes, cores).items():
        builder = builder.config(name, value)
    return builder
