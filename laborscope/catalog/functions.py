"""Text and number functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import TOKENS_SQL, WS, keyed_documents, query, table
from laborscope.functions import (
    list_count,
    list_size,
    round2,
    strip,
    strip_spaces,
    text_length,
    to_list,
)


@query("""
    SELECT conv_id, turn, array_to_string(string_split(text, ', '), '|') AS tokens
    FROM conversations""")
def fn1_split(spark, folder):
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    return turns.select("conv_id", "turn", F.array_join(to_list("text"), "|").alias("tokens"))


@query("""
    SELECT conv_id, turn, array_to_string(string_split(text, ','), '|') AS tokens
    FROM conversations""")
def fn2_split_comma(spark, folder):
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    return turns.select("conv_id", "turn", F.array_join(to_list("text", ","), "|").alias("tokens"))


@query("SELECT doc_id, CAST(len(string_split(text, ', ')) AS BIGINT) AS n FROM documents")
def fn3_list_size(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "text")
    return documents.select("doc_id", list_size(to_list("text")).alias("n"))


@query("SELECT page_id, CAST(len(string_split(html, '</')) AS BIGINT) AS n FROM pages")
def fn4_list_count(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "html")
    return pages.select("page_id", list_count("html", "</").alias("n"))


@query(f"""
    SELECT token, count(*) AS n FROM ({TOKENS_SQL.format(source="documents")}) k
    GROUP BY token ORDER BY n DESC, token""")
def fn5_explode(spark, folder):
    return op.token_ranking(table(spark, folder, "documents", "text"), "text")


@query(f"""
    SELECT page_id, length(trim(x, {WS})) AS stripped, length(trim(x)) AS spaces_stripped
    FROM (SELECT page_id, unnest(string_split(html, '>')) AS x FROM pages)""")
def fn6_strip(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "html")
    parts = pages.select("page_id", F.explode(to_list("html", ">")).alias("x"))
    return parts.select(
        "page_id",
        text_length(strip("x")).alias("stripped"),
        text_length(strip_spaces("x")).alias("spaces_stripped"),
    )


@query("SELECT page_id, length(html) AS n FROM pages")
def fn8_length(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "html")
    return pages.select("page_id", text_length("html").alias("n"))


@query("SELECT p_type, round(sum(p_size) / count(*), 2) AS mean_size FROM part GROUP BY p_type")
def fn9_round(spark, folder):
    parts = table(spark, folder, "part", "p_type", "p_size")
    return parts.groupBy("p_type").agg(round2(F.sum("p_size") / F.count("*")).alias("mean_size"))


@query("""
    SELECT lang, count(*) - count(DISTINCT text) AS copies FROM documents GROUP BY lang""")
def fn10_subtract(spark, folder):
    rows = keyed_documents(spark, folder).groupBy("lang", "text_key").agg(F.count("*").alias("n"))
    return rows.groupBy("lang").agg((F.sum("n") - F.count("*")).alias("copies"))
