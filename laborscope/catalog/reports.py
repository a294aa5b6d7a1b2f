"""The ten queries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import (
    FIRST_DOCUMENTS_SQL,
    LABELLED_SQL,
    MEAN_LENGTH_SQL,
    MEAN_LIST_SQL,
    ORDERS_SQL,
    TOP_TOKENS_SQL,
    WS,
    keyed_documents,
    labelled,
    orders,
    quality_labels,
    query,
    table,
)
from laborscope.functions import MISSING_LABEL, has_text, list_size, text_digest, text_length


@query("""
    SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after,
           count(*) - count(DISTINCT text) AS rows_removed
    FROM documents""")
def q1_dedup_summary(spark, folder):
    documents = table(spark, folder, "documents", "text")
    return op.dedup_summary(documents, text_digest("text"))


@query(f"SELECT doc_id, lang, source, n_chars FROM {FIRST_DOCUMENTS_SQL}")
def q1_dedup_rows(spark, folder):
    wanted = ["doc_id", "lang", "source", "n_chars"]
    first = op.first_by_key(keyed_documents(spark, folder), "text_key", wanted, "doc_id")
    return first.select(*wanted)


def _profile_sql(source: str, columns: list[str], measures: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {measures.format(c=c, blank=f'trim({c}, {WS})')} FROM {source}"
        for c in columns
    )


@query(
    _profile_sql(
        ORDERS_SQL,
        ["order_key", "priority", "status"],
        "count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({blank} = '') AS blanks",
    )
)
def q2_null_profile(spark, folder):
    return op.null_profile(orders(spark, folder), ["order_key", "priority", "status"])


@query(
    _profile_sql(
        LABELLED_SQL,
        ["label_key", "lang", "source", "quality", "toxic"],
        "count(*) FILTER ({c} IS NULL) AS nulls_before, count(*) FILTER ({blank} = '') AS blanks_before,"
        " 0::BIGINT AS nulls_after, count(*) FILTER (label_key IS NULL) AS rows_dropped",
    )
)
def q2_treatment_report(spark, folder):
    return op.treatment_report(labelled(spark, folder).drop("n_chars"), "label_key")


@query(f"""
    SELECT CASE WHEN trim(priority, {WS}) <> '' THEN priority ELSE '{MISSING_LABEL}' END AS priority,
           CASE WHEN trim(status, {WS}) <> '' THEN status ELSE '{MISSING_LABEL}' END AS status,
           count(*) AS n
    FROM {ORDERS_SQL} GROUP BY 1, 2""")
def q2_impute(spark, folder):
    treated = op.impute(orders(spark, folder), "order_key", columns=["priority", "status"])
    return treated.groupBy("priority", "status").agg(F.count("*").alias("n"))


@query("""
    SELECT count(*) AS rows, CAST(sum(len(string_split(text, ', '))) AS BIGINT) AS items
    FROM documents""")
def q3_list_summary(spark, folder):
    return op.list_summary(table(spark, folder, "documents", "text"), "text")


@query("""
    SELECT doc_id, CAST(len(string_split(text, ', ')) AS BIGINT) AS items,
           md5(array_to_string(string_split(text, ', '), '|')) AS joined
    FROM documents""")
def q3_list_rows(spark, folder):
    lists = op.add_list(table(spark, folder, "documents", "doc_id", "text"), "text")
    return lists.select(
        "doc_id",
        list_size("tokens").alias("items"),
        F.md5(F.array_join("tokens", "|")).alias("joined"),
    )


@query("SELECT count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'")
def q4_filter(spark, folder):
    first = op.first_by_key(
        table(spark, folder, "orders"), "o_orderkey", ["o_orderpriority"], "o_orderkey"
    )
    return op.count_equal(first, "o_orderpriority", "1-URGENT")


@query("""
    SELECT count(*) AS n
    FROM (SELECT * FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
    WHERE o_orderpriority = '1-URGENT'""")
def q4_filter_first_orders(spark, folder):
    first = op.first_by_key(
        table(spark, folder, "orders"),
        "o_custkey",
        ["o_orderpriority"],
        ["o_orderdate", "o_orderkey"],
    )
    return op.count_equal(first, "o_orderpriority", "1-URGENT")


@query("""
    SELECT c_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_name ORDER BY n DESC, c_name LIMIT 10""")
def q5_top10(spark, folder):
    first = op.first_by_key(
        table(spark, folder, "orders"), "o_orderkey", ["o_custkey"], "o_orderkey"
    ).withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, folder, "customer", "c_custkey", "c_name")
    return op.labelled_ranking(first, customers, "c_custkey", "c_name").limit(10)


@query(f"""
    SELECT priority, count(*) AS n
    FROM (SELECT * FROM {ORDERS_SQL}
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(order_key AS BIGINT)) = 1)
    WHERE trim(priority, {WS}) <> ''
    GROUP BY priority ORDER BY n DESC, priority LIMIT 10""")
def q5_top10_unique(spark, folder):
    rows = orders(spark, folder)
    values = op.unique_values(rows, "o_custkey", "priority", F.col("order_key").cast("long"))
    return op.top_k(values, "priority", 10)


@query("""
    SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY n DESC, n_name LIMIT 10""")
def q6_top10(spark, folder):
    first = op.first_by_key(
        table(spark, folder, "customer"), "c_custkey", ["c_nationkey"], "c_custkey"
    ).withColumnRenamed("c_nationkey", "n_nationkey")
    nations = table(spark, folder, "nation", "n_nationkey", "n_name")
    return op.labelled_ranking(first, nations, "n_nationkey", "n_name").limit(10)


@query(MEAN_LENGTH_SQL)
def q7_mean_length_by(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "text")
    return op.mean_length_by(
        documents, quality_labels(spark, folder), "doc_id", "text", "quality", "doc_id"
    )


@query(f"""
    SELECT level, count(*) AS n, round(sum(length(text)) / count(*), 2) AS mean_length
    FROM conversations
    JOIN (SELECT conv_id, CASE role WHEN 'system' THEN '  ' ELSE role END AS level
          FROM conversations
          QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1) USING (conv_id)
    WHERE text <> '' AND trim(level, {WS}) <> '' GROUP BY level ORDER BY level""")
def q7_mean_length_repeated(spark, folder):
    """Repeated texts per key; a first row with a blank level hides its key."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    role = F.col("role")
    levels = turns.withColumn("level", F.when(role == "system", "  ").otherwise(role))
    return op.mean_length_by(turns, levels, "conv_id", "text", "level", "turn")


@query(f"""
    SELECT level, count(*) AS n, CAST(sum(length(event_type)) AS BIGINT) AS total
    FROM (SELECT event_type, CASE event_type WHEN 'error' THEN '  ' ELSE event_type END AS level
          FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)
    WHERE trim(level, {WS}) <> '' GROUP BY level""")
def q7_dedup_first(spark, folder):
    """Deduplication comes before the filter on blank levels."""
    kind = F.col("event_type")
    events = table(spark, folder, "events").withColumn(
        "level", F.when(kind == "error", "  ").otherwise(kind)
    )
    first = op.first_by_key(events, "user_id", ["event_type", "level"], ["ts", "event_id"])
    return (
        first.filter(has_text("level"))
        .groupBy("level")
        .agg(F.count("*").alias("n"), F.sum(text_length("event_type")).alias("total"))
    )


@query(TOP_TOKENS_SQL)
def q8_top_tokens(spark, folder):
    return op.top_tokens(keyed_documents(spark, folder), "text_key", "text", "doc_id", 20)


@query("""
    SELECT s_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_name ORDER BY n DESC, s_name""")
def q9_ranking(spark, folder):
    lines = table(spark, folder, "lineitem", "l_suppkey").withColumnRenamed("l_suppkey", "s_suppkey")
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name")
    return op.labelled_ranking(lines, suppliers, "s_suppkey", "s_name")


@query("""
    SELECT l_suppkey, count(*) AS n
    FROM (SELECT l_suppkey FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_shipdate, l_partkey, l_suppkey) = 1)
    GROUP BY l_suppkey ORDER BY n DESC, l_suppkey""")
def q9_ranking_unique(spark, folder):
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", *order)
    first = op.keep_first(lines, ["l_orderkey", "l_linenumber"], order)
    return op.ranking(first, "l_suppkey")


@query(MEAN_LIST_SQL)
def q10_mean_list_size(spark, folder):
    documents = table(spark, folder, "documents", "doc_id").withColumnRenamed("doc_id", "conv_id")
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    return op.mean_list_size(documents, turns, "conv_id", "text", "turn")


@query("""
    SELECT lang, avg(len(string_split(c.text, ', '))) AS mean_items
    FROM documents d JOIN conversations c ON c.conv_id = d.doc_id GROUP BY lang""")
def q10b_mean_list_size_by(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "lang")
    turns = table(spark, folder, "conversations", "conv_id", "text")
    return op.mean_list_size_by(
        documents.withColumnRenamed("doc_id", "conv_id"), turns, "conv_id", "text", "lang", "conv_id"
    )
