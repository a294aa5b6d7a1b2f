"""Projections, filters and nulls."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import LABELLED_SQL, ORDERS_SQL, WS, labelled, orders, query, table
from laborscope.functions import (
    MISSING_LABEL,
    NULL_LABEL,
    fill_null,
    has_text,
    not_empty,
    text_length,
)


@query("SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def pf1_project(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    return lines.select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@query("SELECT doc_id, length(text) AS n, length(text) > 1000 AS long_text FROM documents")
def pf2_derive(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "text")
    lengths = documents.withColumn("n", text_length("text"))
    return lengths.withColumn("long_text", F.col("n") > 1000).drop("text")


@query("SELECT s_name AS company, s_suppkey AS id FROM supplier")
def pf3_rename(spark, folder):
    suppliers = table(spark, folder, "supplier", "s_name", "s_suppkey")
    return suppliers.withColumnsRenamed({"s_name": "company", "s_suppkey": "id"})


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def pf4_equal(spark, folder):
    rows = table(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    return rows.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


@query(f"SELECT order_key, priority FROM {ORDERS_SQL} WHERE trim(priority, {WS}) <> ''")
def pf5_has_text(spark, folder):
    return orders(spark, folder).filter(has_text("priority")).select("order_key", "priority")


@query(f"""
    SELECT priority, status, count(*) AS n FROM {ORDERS_SQL}
    WHERE priority <> '' AND status <> '' GROUP BY 1, 2""")
def pf6_not_empty(spark, folder):
    rows = orders(spark, folder).filter(not_empty("priority") & not_empty("status"))
    return rows.groupBy("priority", "status").agg(F.count("*").alias("n"))


@query(f"SELECT label_key, source FROM {LABELLED_SQL} WHERE trim(label_key, {WS}) <> ''")
def pf7_drop_missing_key(spark, folder):
    rows = labelled(spark, folder)
    return op.drop_missing_key(rows, "label_key").select("label_key", "source")


@query(f"""
    SELECT order_key, CASE WHEN trim(priority, {WS}) <> '' THEN priority END AS priority,
           CASE WHEN trim(status, {WS}) <> '' THEN status END AS status
    FROM {ORDERS_SQL}""")
def pf8_blank_to_null(spark, folder):
    rows = orders(spark, folder).select("order_key", "priority", "status")
    return op.blanks_to_null(rows)


@query(f"""
    SELECT order_key, CASE WHEN trim(priority, {WS}) <> '' THEN priority ELSE '{MISSING_LABEL}' END AS priority
    FROM {ORDERS_SQL}""")
def pf9_impute(spark, folder):
    return op.impute(orders(spark, folder).select("order_key", "priority"), "order_key")


@query(f"SELECT coalesce(priority, '{NULL_LABEL}') AS priority, count(*) AS n FROM {ORDERS_SQL} GROUP BY 1")
def pf10_impute_nulls(spark, folder):
    return op.count_by(op.impute_nulls(orders(spark, folder), ["priority"]), "priority")


@query(f"""
    SELECT coalesce(priority, '') AS priority, coalesce(CAST(quality AS BIGINT), 0) AS quality
    FROM {ORDERS_SQL} LEFT JOIN labels ON CAST(order_key AS BIGINT) = doc_id""")
def pf11_fill_null(spark, folder):
    rows = orders(spark, folder).withColumn("doc_id", F.col("order_key").cast("long"))
    joined = rows.join(table(spark, folder, "labels", "doc_id", "quality"), "doc_id", "left")
    return joined.select(
        fill_null("priority", "").alias("priority"),
        fill_null(F.col("quality").cast("long"), 0).alias("quality"),
    )


@query(f"""
    SELECT order_key, CASE WHEN trim(priority, {WS}) <> '' THEN o_totalprice ELSE 0 END AS price
    FROM {ORDERS_SQL}""")
def pf12_conditional(spark, folder):
    price = F.when(has_text("priority"), F.col("o_totalprice")).otherwise(0.0)
    return orders(spark, folder).select("order_key", price.alias("price"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS text_key, CAST(o_orderkey AS DOUBLE) AS double_key,
           CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS long_key
    FROM orders""")
def pf13_cast(spark, folder):
    key = F.col("o_orderkey")
    return table(spark, folder, "orders", "o_orderkey").select(
        key.cast("string").alias("text_key"),
        key.cast("double").alias("double_key"),
        key.cast("string").cast("long").alias("long_key"),
    )
