"""A static table that batches look keys up in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborscope.sources import storage

#: Rows per bucket, and buckets at most.
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 4096

_BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def write_lookup(table: DataFrame, key: str, folder: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Write a table with one row per key in buckets by key, unless that was done before."""
    spark = table.sparkSession
    if storage.exists(spark, f"{folder}/{storage.SUCCESS_MARKER}"):
        return
    storage.delete(spark, folder)
    buckets = min(MOST_BUCKETS, table.count() // bucket_rows + 1)
    # The number of buckets is part of the path, so that no reader can take another.
    (
        table.withColumn(_BUCKET, _bucket(key, buckets))
        .repartition(_BUCKET)
        .sortWithinPartitions(_BUCKET, key)
        .write.mode("overwrite")
        .partitionBy(_BUCKET)
        .parquet(f"{folder}/of={buckets}")
    )
    storage.write_text(spark, f"{folder}/{storage.SUCCESS_MARKER}", str(buckets))


def joined_levels(batch: DataFrame, key: str, folder: str) -> DataFrame:
    """Inner join of a batch, one row per key, with the buckets that its keys are in.

    Spark broadcasts the smaller side by its measured size.
    """
    spark = batch.sparkSession
    found = [n for n in storage.children(spark, folder) if n.startswith("of=")]
    buckets = int(found[0].removeprefix("of="))
    table = spark.read.parquet(f"{folder}/{found[0]}")
    if buckets == 1:
        return batch.join(table.drop(_BUCKET), key)
    own = batch.withColumn(_BUCKET, _bucket(key, buckets)).persist()
    # At most as many numbers as there are buckets.
    needed = [r[0] for r in own.select(_BUCKET).distinct().collect()]
    return own.join(table.filter(F.col(_BUCKET).isin(needed)), [_BUCKET, key]).drop(_BUCKET)
