"""The first row per key, kept in the state store."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from laborscope.operators.dedup import Keys, _columns

Handler = Callable[[DataFrame, int], None]

# State on disk, of which a batch reads its own keys and saves its own changes.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# State partitions of a handful of groups: each is a task in every batch, and reports to the driver.
SMALL_STATE = 4


@contextmanager
def small_state(spark: SparkSession) -> Iterator[None]:
    """At most ``SMALL_STATE`` state partitions for queries that start inside; a query that goes on keeps its own."""
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    spark.conf.set(name, min(SMALL_STATE, int(old)))
    try:
        yield
    finally:
        spark.conf.set(name, old)


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """State store settings for queries that start inside, unless the session has its own."""
    own = spark._jsparkSession.conf().getAll()
    added = [k for k in _STATE_STORE if not own.contains(k)]
    for k in added:
        spark.conf.set(k, _STATE_STORE[k])
    try:
        yield
    finally:
        for k in added:
            spark.conf.unset(k)


def run_batches(stream: DataFrame, handle: Handler, folder: str, mode: str = "append") -> StreamingQuery:
    """Process what is available, batch by batch, and return the ended query."""
    with _settings(stream.sparkSession):
        query = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(handle)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return query


def first_rows_per_key(stream: DataFrame, key: str, columns: Sequence[str], order: Keys) -> DataFrame:
    """``key``, ``columns`` of the first row per key, and ``_new``; for update mode.

    An earlier batch comes first, and ``order`` within a batch. The state holds these
    columns for every key, and each batch reads and writes the keys it has. Rows are
    reduced to one per key in every task before they are shuffled. ``_new`` marks the
    keys that no earlier batch had; their rows never change later. Null is a key.
    """
    wanted = [c for c in dict.fromkeys(columns) if c != key]
    # The time of a batch is one constant, written down with its offsets and so the same if it is repeated.
    timed = stream.withColumn("_batch_time", F.current_timestamp())
    place = F.struct(F.col("_batch_time"), *(c.alias(f"_o{i}") for i, c in enumerate(_columns(order))))
    row = F.struct(F.lit(True).alias("_row"), *(F.col(f"`{c}`") for c in wanted))
    found = timed.groupBy(F.col(f"`{key}`")).agg(
        F.min_by(row, place).alias("_first"),
        F.min("_batch_time").alias("_since"),
        F.max("_batch_time").alias("_latest"),
    )
    return found.select(
        F.col(f"`{key}`"),
        *(F.col(f"_first.`{c}`").alias(c) for c in wanted),
        (F.col("_since") == F.col("_latest")).alias("_new"),
    )
