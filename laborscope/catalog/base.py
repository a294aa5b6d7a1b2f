"""Registration, and the tables and SQL fragments the bindings share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.functions import WHITESPACE, text_digest
from laborscope.sources import read_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def query(sql: str) -> Callable[[Query], Query]:
    """Register the function under its name, with its SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet", columns or None)


# Orders with missing values: one priority stands for null, one for blanks,
# and one status is an empty text.
ORDERS_SQL = """(
    SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_custkey, o_totalprice,
           CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '  '
                ELSE o_orderpriority END AS priority,
           CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END AS status
    FROM orders) o"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        "o_custkey",
        "o_totalprice",
        F.when(priority == "5-LOW", "  ")
        .when(priority != "4-NOT SPECIFIED", priority)
        .alias("priority"),
        F.when(status == "P", "").otherwise(status).alias("status"),
    )


# Documents with their labels; most have none.
LABELLED_SQL = """(
    SELECT CAST(l.doc_id AS VARCHAR) AS label_key, d.lang, d.source, d.n_chars,
           CAST(l.quality AS VARCHAR) AS quality, CAST(l.toxic AS VARCHAR) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) x"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(
        F.col("doc_id"),
        F.col("doc_id").cast("string").alias("label_key"),
        F.col("quality").cast("string").alias("quality"),
        F.col("toxic").cast("string").alias("toxic"),
    )
    documents = table(spark, folder, "documents", "doc_id", "lang", "source", "n_chars")
    joined = documents.join(labels, "doc_id", "left")
    return joined.select("label_key", "lang", "source", "n_chars", "quality", "toxic")


def keyed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a short key for their text, so exact copies share a key."""
    return table(spark, folder, "documents").withColumn("text_key", text_digest("text"))


FIRST_DOCUMENTS_SQL = """(
    SELECT * FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1) d"""

TOKENS_SQL = f"""
    SELECT trim(t, {WS}) AS token
    FROM (SELECT unnest(string_split(text, ', ')) AS t FROM {{source}} WHERE trim(text, {WS}) <> '') s
    WHERE trim(t, {WS}) <> ''"""

TOP_TOKENS_SQL = f"""
    SELECT token, count(*) AS n FROM ({TOKENS_SQL.format(source=FIRST_DOCUMENTS_SQL)}) k
    GROUP BY token ORDER BY n DESC, token LIMIT 20"""

MEAN_LENGTH_SQL = """
    SELECT CAST(quality AS VARCHAR) AS quality, count(*) AS n,
           round(sum(length(text)) / count(*), 2) AS mean_length
    FROM documents JOIN labels USING (doc_id) WHERE text <> '' GROUP BY quality ORDER BY quality"""


def quality_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels", "doc_id", "quality")
    return labels.withColumn("quality", F.col("quality").cast("string"))


MEAN_LIST_SQL = """
    SELECT count(*) AS rows, count(*) FILTER (items > 0) AS rows_with_items,
           round(sum(items) / count(*), 2) AS mean_items
    FROM (SELECT coalesce(len(string_split(c.text, ', ')), 0) AS items
          FROM documents d
          LEFT JOIN (SELECT * FROM conversations
                     QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1) c
          ON c.conv_id = d.doc_id)"""
