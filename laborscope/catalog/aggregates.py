"""Aggregations, sorting and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import LABELLED_SQL, ORDERS_SQL, labelled, orders, query, table
from laborscope.functions import list_count, list_size, round2, text_length, to_list


@query("SELECT count(*) AS n FROM lineitem")
def ag1_count(spark, folder):
    return table(spark, folder, "lineitem", "l_orderkey").agg(F.count("*").alias("n"))


@query(f"SELECT priority, count(*) AS n FROM {ORDERS_SQL} GROUP BY priority")
def ag2_count_by(spark, folder):
    return op.count_by(orders(spark, folder), "priority")


@query(f"SELECT lang, count(quality) AS total FROM {LABELLED_SQL} GROUP BY lang ORDER BY total DESC, lang")
def ag3_count_present(spark, folder):
    return op.ranking(labelled(spark, folder), "lang", "total", of="quality")


@query("""
    SELECT lang, count(*) AS n, round(sum(length(text)) / count(*), 2) AS mean_length
    FROM documents GROUP BY lang ORDER BY lang""")
def ag4_count_and_mean(spark, folder):
    documents = table(spark, folder, "documents", "lang", "text")
    lengths = documents.groupBy("lang").agg(
        F.count("*").alias("_n"), F.sum(text_length("text")).alias("_total")
    )
    return op.mean_from_totals(lengths, "lang")


@query("SELECT source, avg(n_chars) AS mean FROM documents GROUP BY source")
def ag5_mean_by(spark, folder):
    return op.mean_by(table(spark, folder, "documents", "source", "n_chars"), "source", "n_chars")


@query("SELECT CAST(sum(len(string_split(text, ', '))) AS BIGINT) AS items FROM conversations")
def ag6_sum_of_sizes(spark, folder):
    turns = table(spark, folder, "conversations", "text")
    return turns.agg(F.sum(list_size(to_list("text"))).alias("items"))


@query("""
    SELECT count(*) FILTER (len(string_split(text, ', ')) > 1) AS several, count(*) AS rows,
           round(avg(len(string_split(text, ', '))), 2) AS mean
    FROM conversations""")
def ag7_conditional_count(spark, folder):
    sizes = table(spark, folder, "conversations", "text").select(list_count("text").alias("n"))
    return sizes.agg(
        F.count_if(F.col("n") > 1).alias("several"),
        F.count("*").alias("rows"),
        round2(F.avg("n")).alias("mean"),
    )


@query("SELECT count(*) AS rows, round(avg(l_quantity), 2) AS mean FROM lineitem WHERE l_returnflag = 'none'")
def ag8_mean_of_nothing(spark, folder):
    """The mean over no rows is null."""
    lines = table(spark, folder, "lineitem", "l_quantity", "l_returnflag")
    nothing = lines.filter(F.col("l_returnflag") == "none")
    return nothing.agg(F.count("*").alias("rows"), round2(F.avg("l_quantity")).alias("mean"))


@query("""
    SELECT count(*) AS n, round(avg(x), 8) AS mean
    FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)""")
def ag13_array_mean(spark, folder):
    means = op.array_mean(table(spark, folder, "embeddings", "embedding"), "embedding")
    return means.withColumn("mean", F.round("mean", 8))


@query("""
    SELECT source, count(*) AS n FROM documents
    GROUP BY source ORDER BY n DESC, source LIMIT 3""")
def so2_top_k(spark, folder):
    return op.top_k(table(spark, folder, "documents", "source"), "source", 3)


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY lang")
def so4_sort_by_key(spark, folder):
    return op.count_by(table(spark, folder, "documents", "lang"), "lang").orderBy("lang")


@query("""
    SELECT p_partkey, count(*) AS n FROM (SELECT l_partkey AS p_partkey FROM lineitem)
    GROUP BY p_partkey ORDER BY n DESC, p_partkey""")
def so5_full_ranking(spark, folder):
    lines = table(spark, folder, "lineitem", "l_partkey")
    return op.ranking(lines.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def so6_first_rows(spark, folder):
    events = table(spark, folder, "events", "event_id", "user_id", "event_type", "ts")
    return op.first_rows(events, ["ts", "event_id"]).drop("ts")


@query("""
    SELECT c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_name, s_nationkey FROM supplier""")
def st1_concatenate(spark, folder):
    customers = table(spark, folder, "customer", "c_name", "c_nationkey")
    suppliers = table(spark, folder, "supplier", "s_name", "s_nationkey")
    return customers.toDF("name", "nation").unionByName(suppliers.toDF("name", "nation"))
