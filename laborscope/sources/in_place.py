"""First rows per key of a scan whose other columns are too wide to move."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborscope.operators.dedup import first_by_key
from laborscope.operators.joins import NULL_SAFE_KEY, null_safe_key
from laborscope.sources.files import SOURCE_ORDER
from laborscope.sources.storage import work_folder

#: Bytes of keys and positions that every task may be given.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes that a row of them takes besides its key.
_ROW_BYTES = 64


def first_rows_in_place(
    scan: DataFrame,
    key: str,
    columns: Sequence[str],
    position: str = SOURCE_ORDER,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``key`` and ``columns`` of the first row per key, the same rows as ``first_by_key``.

    First only keys and positions are read, and reduced to the keys that repeat, each
    with its first position. If these are at most ``broadcast_bytes``, measured, they go to all
    tasks, and the scan drops the other rows of these keys where it reads them: its wide
    columns are never shuffled. Else the rows are shuffled by key. ``position`` must tell
    rows apart; null is a key.
    """
    wanted = list(dict.fromkeys([key, *columns]))
    spark = scan.sparkSession
    repeated = (
        scan.select(*null_safe_key(scan, key), position)
        .groupBy(*NULL_SAFE_KEY)
        .agg(F.count("*").alias("_n"), F.min(position).alias("_first"))
        .filter("_n > 1")
        .drop("_n")
    )
    path = work_folder(spark, "repeated-keys")
    repeated.write.parquet(path)
    repeated = spark.read.parquet(path)
    key_bytes = F.octet_length(F.col("_key").cast("string"))
    size = repeated.agg(F.sum(F.coalesce(key_bytes, F.lit(0)) + _ROW_BYTES)).first()[0] or 0
    if size > broadcast_bytes:
        return first_by_key(scan, key, columns, position)
    marked = scan.select(*(F.col(f"`{c}`") for c in wanted), position, *null_safe_key(scan, key))
    joined = marked.join(F.broadcast(repeated), NULL_SAFE_KEY, "left")
    kept = joined.filter(F.col("_first").isNull() | (F.col("_first") == F.col(position)))
    return kept.select(*(F.col(f"`{c}`") for c in wanted))
