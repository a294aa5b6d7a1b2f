"""Incremental queries."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import (
    FIRST_DOCUMENTS_SQL,
    MEAN_LENGTH_SQL,
    MEAN_LIST_SQL,
    TOP_TOKENS_SQL,
    quality_labels,
    query,
    table,
)
from laborscope.functions import text_digest
from laborscope.sources import total_bytes, work_folder
from laborscope.sources.files import input_files
from laborscope.sources.storage import set_modified
from laborscope.streaming import (
    incremental_keep_first,
    incremental_mean_length_by,
    incremental_mean_list_size,
    incremental_token_counts,
    run_append,
    run_update,
    stream_dedup,
    stream_length_totals_by,
    stream_parquet,
    stream_token_counts,
)

#: Batches that the documents come in, and bytes of a file at most.
BATCHES = 4
FILE_BYTES = 32 * 1024 * 1024


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The documents in files by ascending id, a quarter of the bytes per batch, so that keys repeat across batches."""
    return in_batches(spark, folder, "documents").withColumn("text_key", text_digest("text"))


def in_batches(spark: SparkSession, folder: str, name: str, key: str = "doc_id") -> DataFrame:
    """A stream of all rows in files by ascending key, dated one after another, in batches of bounded bytes."""
    rows = table(spark, folder, name)
    size = total_bytes(spark, f"{folder}/{name}.parquet")
    files = max(2 * BATCHES, -(-size // FILE_BYTES))
    target = work_folder(spark, f"{name}-parts")
    rows.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(target)
    written = input_files(spark.read.parquet(target))
    now = int(time.time() * 1000)
    for i, file in enumerate(written):
        set_modified(spark, file, now - 1000 * (len(written) - i))
    return stream_parquet(spark, target, rows.schema, bytes_per_trigger=total_bytes(spark, target) // BATCHES + 1)


@query("SELECT DISTINCT sha256(text) AS text_key FROM documents")
def in1_stream_dedup(spark, folder):
    unique = stream_dedup(document_stream(spark, folder), ["text_key"], "source_order")
    return run_append(unique.select("text_key"), work_folder(spark, "stream-dedup"))


@query(f"SELECT doc_id, lang, source FROM {FIRST_DOCUMENTS_SQL}")
def in1_incremental_keep_first(spark, folder):
    wanted = ["doc_id", "lang", "source"]
    stream = document_stream(spark, folder)
    target = work_folder(spark, "keep-first")
    return incremental_keep_first(stream, "text_key", wanted, "doc_id", target).select(*wanted)


@query(TOP_TOKENS_SQL)
def in2_stream_token_counts(spark, folder):
    stream = document_stream(spark, folder)
    counts = stream_token_counts(stream, "text_key", "text", spread_by="source_order")
    result = run_update(counts, ["token"], work_folder(spark, "stream-tokens"))
    return op.rank_counts(result, "token").limit(20)


@query(TOP_TOKENS_SQL)
def in2_incremental_token_counts(spark, folder):
    stream = document_stream(spark, folder)
    target = work_folder(spark, "tokens")
    counts = incremental_token_counts(stream, "text_key", "text", "doc_id", target)
    return op.rank_counts(counts, "token").limit(20)


@query(MEAN_LENGTH_SQL)
def in3_stream_mean_length_by(spark, folder):
    labels = op.first_by_key(quality_labels(spark, folder), "doc_id", ["quality"], "doc_id")
    stream = in_batches(spark, folder, "documents")
    target = work_folder(spark, "stream-lengths")
    totals = stream_length_totals_by(stream, labels, "doc_id", "text", "quality", target)
    return op.mean_from_totals(run_update(totals, ["quality"], target), "quality")


@query(MEAN_LENGTH_SQL)
def in3_incremental_mean_length_by(spark, folder):
    stream = in_batches(spark, folder, "documents")
    labels = quality_labels(spark, folder)
    target = work_folder(spark, "lengths")
    return incremental_mean_length_by(stream, labels, "doc_id", "text", "quality", "doc_id", target)


@query(MEAN_LIST_SQL)
def in4_incremental_mean_list_size(spark, folder):
    documents = table(spark, folder, "documents", "doc_id").withColumnRenamed("doc_id", "conv_id")
    turns = stream_parquet(spark, f"{folder}/conversations.parquet")
    target = work_folder(spark, "lists")
    return incremental_mean_list_size(documents, turns, "conv_id", "text", "turn", target)
