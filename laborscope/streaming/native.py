"""Streaming queries that keep their state in Spark's state store.

The tables carry no event time, so there is no watermark: the state holds one
entry per key or token for as long as the query lives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from laborscope.functions import DEFAULT_SEPARATOR, has_text, not_empty, text_length
from laborscope.operators.ranking import count_by
from laborscope.operators.textstats import tokens
from laborscope.sources import storage
from laborscope.sources.files import SOURCE_ORDER
from laborscope.streaming.state import run_batches, small_state
from laborscope.streaming.versions import Versions, latest_per_key

# Sub-keys a repeated key is first deduplicated under.
SPREAD = 32

def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Read Parquet files as they arrive, with their position as ``source_order``.

    Files keep coming, so none has a number: they are ordered by when they were written,
    then by path. The file source takes them in that order too. A batch ends before the
    file that would exceed ``bytes_per_trigger``, so it is bounded whatever the files' number.
    """
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if storage.is_file(spark, path):
        path = f"{path[:-1]}[{path[-1]}]"  # a stream takes a folder or a pattern
    position = F.struct(
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    return reader.parquet(path).select("*", position.alias(SOURCE_ORDER))


def stream_dedup(
    stream: DataFrame,
    keys: Sequence[str],
    spread_by: Column | str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """One row per key over all batches.

    A repeated key is first deduplicated in up to ``spread`` tasks, so a hot key
    does not send all its rows to one; choose it by the share of the hottest
    key, 1 for none. Rows are told apart by ``spread_by``, such as
    ``source_order``, and by all their columns if it is not given.
    """
    keys = list(keys)
    if spread <= 1:
        return stream.dropDuplicates(keys)
    told = [spread_by] if spread_by is not None else [F.col(f"`{c}`") for c in stream.columns]
    spread = F.pmod(F.xxhash64(*told), F.lit(spread))
    once = stream.withColumn("_spread", spread).dropDuplicates([*keys, "_spread"])
    return once.drop("_spread").dropDuplicates(keys)


def stream_token_counts(
    stream: DataFrame,
    key: str,
    text: str,
    name: str = "token",
    count: str = "n",
    separator: str = DEFAULT_SEPARATOR,
    spread_by: Column | str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """Running count per list item over one row per key; for complete or update mode."""
    unique = stream_dedup(stream, [key], spread_by, spread)
    return count_by(tokens(unique, text, name, separator), name, count)


def stream_length_totals_by(
    stream: DataFrame, levels: DataFrame, key: str, text: str, level: str, folder: str
) -> DataFrame:
    """Running ``level, _n, _total`` against a static table with one level per key.

    Merge with ``mean_from_totals``. The levels are written below ``folder`` once. Up to
    Spark's broadcast threshold every task gets them all, and no row is shuffled before
    the sums, so no key is hot. A larger table is an error:
    ``incremental_mean_length_by`` takes one of any size.
    """
    spark, path = stream.sparkSession, f"{folder}/levels"
    if not storage.exists(spark, f"{path}/{storage.SUCCESS_MARKER}"):
        levels.select(key, level).filter(has_text(level)).write.mode("overwrite").parquet(path)
    size = storage.total_bytes(spark, path)
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if size > limit:
        raise ValueError(f"the levels have {size} bytes, more than spark.sql.autoBroadcastJoinThreshold, {limit}")
    known = F.broadcast(spark.read.parquet(path))
    texts = stream.filter(not_empty(text)).select(key, text_length(text).alias("_length"))
    joined = texts.join(known, key)
    return joined.groupBy(level).agg(F.count("*").alias("_n"), F.sum("_length").alias("_total"))


def run_update(stream: DataFrame, keys: Sequence[str], folder: str) -> DataFrame:
    """Process what is available in update mode and return the table written so far.

    A batch writes the rows that it changed; the table has the latest row for each of ``keys``.
    """
    table = Versions(stream.sparkSession, f"{folder}/data", stream.schema, latest_per_key(list(keys)))
    run_batches(stream, table.save, folder, "update")
    return table.read()


def run_append(stream: DataFrame, folder: str) -> DataFrame:
    """Process what is available into Parquet and return the table written so far."""
    (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/data")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


def run_complete(stream: DataFrame, folder: str) -> DataFrame:
    """Process what is available in complete mode and return the last full result.

    Every batch writes all rows: for small results, such as a handful of groups. A new
    query keeps them in at most ``SMALL_STATE`` partitions, whatever the session's number.
    """
    latest: list[int] = []

    def save(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(f"{folder}/data/batch={batch_id}")
        latest[:] = [batch_id]

    spark = stream.sparkSession
    with small_state(spark):
        query = (
            stream.writeStream.outputMode("complete")
            .foreachBatch(save)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    if not latest and not storage.exists(spark, f"{folder}/data"):
        return spark.createDataFrame([], stream.schema)
    batches = spark.read.parquet(f"{folder}/data")
    newest = F.lit(latest[0]) if latest else F.lit(batches.agg(F.max("batch")).first()[0])
    return batches.filter(F.col("batch") == newest).drop("batch")
