"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import query, table
from laborscope.catalog.reports import q9_ranking
from laborscope.functions import list_count, round2, text_digest, text_length
from laborscope.plans import JobDataset
from laborscope.sources import (
    SOURCE_ORDER,
    collect_small,
    csv_to_parquet,
    head_and_count,
    per_file,
    read_complete_parquet,
    read_csv_text,
    read_large_csv,
    read_parquet,
    sample_json,
    total_bytes,
    work_folder,
    write_csv,
    write_parts,
)
from laborscope.streaming import run_complete, run_update, stream_parquet


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sc1_csv_scan(spark, folder):
    target = work_folder(spark, "csv")
    write_csv(table(spark, folder, "customer"), target)
    text = read_csv_text(spark, target)
    return text.select(
        F.col("c_custkey").cast("long").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


@query("""
    SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer GROUP BY c_mktsegment""")
def sc2_csv_inferred(spark, folder):
    target = work_folder(spark, "csv")
    write_csv(table(spark, folder, "customer"), target)
    typed = read_csv_text(spark, target, infer_types=True)
    return typed.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), round2(F.sum("c_acctbal")).alias("balance")
    )


TEXTS_SQL = "SELECT doc_id, length(text) AS n_chars, sha256(text) AS text_key FROM documents"


def _texts(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_length("text").alias("n_chars"),
        text_digest("text").alias("text_key"),
    )


@query(TEXTS_SQL)
def sc3_multiline_csv(spark, folder):
    target = work_folder(spark, "csv")
    write_csv(table(spark, folder, "documents", "doc_id", "text"), target)
    return _texts(read_csv_text(spark, target, multiline=True))


@query(TEXTS_SQL)
def sc3_multiline_csv_split(spark, folder):
    target = work_folder(spark, "csv")
    write_csv(table(spark, folder, "documents", "doc_id", "text"), target)
    return _texts(read_large_csv(spark, target))


@query(f"""
    SELECT doc_id, length(text || chr(13)) AS n_chars, sha256(text || chr(13)) AS text_key FROM documents
    UNION ALL {TEXTS_SQL}""")
def sc3_mixed_line_ends(spark, folder):
    """Files with LF and with CR LF in one folder; in the first, every text ends in a quoted CR."""
    target = work_folder(spark, "csv")
    texts = table(spark, folder, "documents", "doc_id", "text")
    quoted = texts.select("doc_id", F.concat("text", F.lit("\r")).alias("text"))
    for part, ends in ((quoted, ""), (texts, "\r")):
        field = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
        record = F.concat(F.col("doc_id").cast("string"), F.lit(","), F.coalesce(field, F.lit("")), F.lit(ends))
        # The first row of a task, and so of a file, brings the header.
        first = F.monotonically_increasing_id() % (1 << 33) == 0
        header = F.when(first, F.lit(f"doc_id,text{ends}\n")).otherwise(F.lit(""))
        part.select(F.concat(header, record)).write.mode("append").text(target)
    return _texts(read_csv_text(spark, target, multiline=True))


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def sc4_parquet_projection(spark, folder):
    return table(spark, folder, "orders", "o_orderkey", "o_orderpriority")


@query("SELECT conv_id, turn, role, text FROM conversations")
def sc5_complete_parquet(spark, folder):
    target = work_folder(spark, "parts")
    write_parts(table(spark, folder, "conversations"), target)
    return read_complete_parquet(spark, target, ["conv_id", "turn", "role", "text"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def sc6_batched_scan(spark, folder):
    target = work_folder(spark, "parts")
    events = table(spark, folder, "events", "event_id", "event_type")
    write_parts(events.repartition(8, "event_id"), target)
    stream = stream_parquet(spark, target, events.schema, files_per_trigger=2)
    return run_complete(op.count_by(stream, "event_type"), work_folder(spark, "batched"))


@query("SELECT user_id, count(*) AS n, max(value) AS highest FROM events GROUP BY user_id")
def sc6_batches_by_bytes(spark, folder):
    """Batches end by bytes, and each adds the users that it has to the table."""
    target = work_folder(spark, "parts")
    events = table(spark, folder, "events", "event_id", "user_id", "value")
    write_parts(events.repartition(16, "event_id"), target)
    stream = stream_parquet(spark, target, events.schema, bytes_per_trigger=total_bytes(spark, target) // 6 + 1)
    users = stream.groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").alias("highest"))
    return run_update(users, ["user_id"], work_folder(spark, "batched"))


@query("""
    SELECT CAST(doc_id % 8 AS INTEGER) AS part, count(*) AS rows,
           CAST(sum(len(string_split(text, ', '))) AS BIGINT) AS items
    FROM documents GROUP BY 1""")
def sc7_per_file(spark, folder):
    """Every task of the scan writes its own file of a part, so no part goes through one task; files add up to parts."""
    target = work_folder(spark, "parts")
    parts = table(spark, folder, "documents", "doc_id", "text").withColumn("part", F.col("doc_id") % 8)
    parts.write.partitionBy("part").parquet(target)
    files = per_file(spark.read.parquet(target), items=F.sum(list_count("text")))
    number = F.regexp_extract("file", r"part=(\d+)", 1).cast("int")
    return files.groupBy(number.alias("part")).agg(F.sum("rows").alias("rows"), F.sum("items").alias("items"))


@query("""
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM documents""")
def sc7_order_over_many_parts(spark, folder):
    """Tasks of over a thousand files each, numbered in source order."""
    target = work_folder(spark, "parts")
    ids = table(spark, folder, "documents", "doc_id")
    tasks = 2
    per_file = ids.count() // (tasks * 1100) + 1
    write_parts(ids.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id"), target, per_file)
    scan = read_parquet(spark, target, ["doc_id"], source_order=True)
    return op.number_rows(scan, SOURCE_ORDER).drop(SOURCE_ORDER)


@query("SELECT 'orders' AS name, count(*) AS n FROM orders")
def sc8_located_table(spark, folder):
    orders = JobDataset(spark, folder).read("orders.parquet", ["o_orderkey"])
    return orders.agg(F.lit("orders").alias("name"), F.count("*").alias("n"))


@query("""
    SELECT s_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_name""")
def sk1_csv_sink(spark, folder):
    target = work_folder(spark, "result")
    write_csv(q9_ranking(spark, folder), target)
    written = read_csv_text(spark, target)
    return written.select("s_name", F.col("n").cast("long").alias("n"))


@query("""
    SELECT to_json(list({'doc_id': doc_id, 'tokens': string_split(text, ', ')} ORDER BY doc_id)) AS json
    FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 5)""")
def sk2_json_sample(spark, folder):
    lists = op.add_list(table(spark, folder, "documents", "doc_id", "text"), "text")
    return sample_json(lists.select("doc_id", "tokens"), "doc_id")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5")
def sk3_row_sample(spark, folder):
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return op.first_rows(table(spark, folder, "orders", *columns), "o_orderkey")


@query(TEXTS_SQL)
def sk4_csv_to_parquet(spark, folder):
    source, target = work_folder(spark, "csv"), work_folder(spark, "parquet")
    write_csv(table(spark, folder, "documents", "doc_id", "text"), source)
    csv_to_parquet(spark, source, target, ["doc_id", "text"])
    return _texts(read_complete_parquet(spark, target))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def sk6_collect_small(spark, folder):
    """What came to the driver."""
    counts = op.count_by(table(spark, folder, "events", "event_type"), "event_type")
    return spark.createDataFrame(collect_small(counts), counts.schema)


@query("""
    SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS total
    FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 20""")
def sk5_preview(spark, folder):
    """The first rows with the number of all."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    finished = orders.filter("o_orderstatus = 'F'").orderBy("o_orderkey").drop("o_orderstatus")
    first, total = head_and_count(finished, 20)
    return spark.createDataFrame(first, finished.schema).withColumn("total", F.lit(total).cast("bigint"))
