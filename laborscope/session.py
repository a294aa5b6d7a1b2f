"""Settings that depend on the size of the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

from laborscope.sources import total_bytes

BYTES_PER_PARTITION = 128 * 1024 * 1024


# Share of the input that the reports shuffle: keys, positions and numbers, not texts.
SHUFFLED_SHARE = 0.1


def size_shuffles(spark: SparkSession, *paths: str, share: float = SHUFFLED_SHARE) -> int:
    """Start shuffles with partitions of about 128 MB of what is shuffled; AQE merges small ones.

    ``share`` is the part of the input that is shuffled.
    """
    size = int(share * sum(total_bytes(spark, path) for path in paths))
    partitions = max(spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    return partitions
