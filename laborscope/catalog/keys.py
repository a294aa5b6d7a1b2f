"""Deduplication and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborscope import operators as op
from laborscope.catalog.base import labelled, query, table
from laborscope.functions import round2
from laborscope.sources import first_rows_in_place


@query("""
    SELECT user_id, event_type, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def dd1_keep_first(spark, folder):
    events = table(spark, folder, "events", "user_id", "event_type", "event_id", "ts")
    return op.keep_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
    SELECT quality, lang, n_chars FROM (
        SELECT quality, lang, n_chars, doc_id FROM documents LEFT JOIN labels USING (doc_id)
        QUALIFY row_number() OVER (PARTITION BY quality, lang ORDER BY doc_id) = 1)""")
def dd1_keep_first_null_key(spark, folder):
    """Null keys form one group."""
    documents = table(spark, folder, "documents", "doc_id", "lang", "n_chars")
    rows = documents.join(table(spark, folder, "labels", "doc_id", "quality"), "doc_id", "left")
    return op.keep_first(rows, ["quality", "lang"], "doc_id").drop("doc_id")


@query("SELECT DISTINCT user_id, event_type FROM events")
def dd2_keep_any(spark, folder):
    events = table(spark, folder, "events", "user_id", "event_type", "event_id")
    return op.keep_any(events, ["user_id", "event_type"]).select("user_id", "event_type")


@query("""
    SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
           CAST(sum(n) AS BIGINT) - count(*) AS rows_removed
    FROM (SELECT quality, source, count(*) AS n
          FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality, source)""")
def dd3_dedup_summary_null_key(spark, folder):
    return op.dedup_summary(labelled(spark, folder), ["quality", "source"])


@query("""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def dd5_keep_last(spark, folder):
    events = table(spark, folder, "events", "user_id", "event_id", "event_type", "ts")
    return op.keep_last(events, "user_id", ["ts", "event_id"]).drop("ts")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def jn1_inner(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    rows = table(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    return op.join_on_key(lines, rows.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")


@query("""
    SELECT doc_id, lang, coalesce(quality, 0) AS quality
    FROM documents LEFT JOIN labels USING (doc_id)""")
def jn2_left_fill(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "lang")
    return op.lookup(documents, table(spark, folder, "labels", "doc_id", "quality"), "doc_id", {"quality": 0})


@query("""
    SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def jn3_small_side(spark, folder):
    """The small side is broadcast when its size is below Spark's threshold."""
    customers = table(spark, folder, "customer", "c_nationkey", "c_acctbal")
    nations = table(spark, folder, "nation", "n_nationkey", "n_name")
    joined = op.join_on_key(customers.withColumnRenamed("c_nationkey", "n_nationkey"), nations, "n_nationkey")
    return joined.groupBy("n_name").agg(
        F.count("*").alias("n"), round2(F.sum("c_acctbal")).alias("balance")
    )


@query("""
    SELECT a.quality, a.documents, b.chars
    FROM (SELECT quality, count(*) AS documents
          FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality) a
    JOIN (SELECT quality, CAST(sum(n_chars) AS BIGINT) AS chars
          FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality) b
    ON a.quality IS NOT DISTINCT FROM b.quality""")
def jn4_null_safe(spark, folder):
    rows = labelled(spark, folder).withColumn("quality", F.col("quality").cast("int"))
    counts = op.count_by(rows, "quality", "documents")
    chars = rows.groupBy("quality").agg(F.sum("n_chars").alias("chars"))
    return op.join_null_safe(counts, chars, "quality")


# A third of the line items, and a tenth of the suppliers, have one key; others have none.
HEAVY_SQL = """(
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_linenumber > 5 THEN NULL ELSE l_suppkey END AS supplier
    FROM lineitem) l"""
HEAVY_RIGHT_SQL = """(
    SELECT CASE WHEN s_suppkey % 10 = 7 THEN 7 WHEN s_suppkey % 10 = 8 THEN NULL ELSE s_suppkey END AS supplier, s_name
    FROM supplier) s"""


def _heavy(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).when(F.col("l_linenumber") <= 5, F.col("l_suppkey"))
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name")
    number = F.col("s_suppkey") % 10
    other = F.when(number == 7, F.lit(7)).when(number != 8, F.col("s_suppkey"))
    left = lines.select("l_orderkey", "l_linenumber", "l_quantity", key.cast("bigint").alias("supplier"))
    return left, suppliers.select(other.cast("bigint").alias("supplier"), "s_name")


def _counts():
    """A third of the rows against a tenth is a product, so the rows of a key are counted before they are joined."""
    return {"n": F.count("*"), "with_key": F.count("supplier")}


@query(f"""
    SELECT s_name, count(*) AS n, CAST(sum(l_quantity * l_linenumber) AS BIGINT) AS total
    FROM {HEAVY_SQL} JOIN {HEAVY_RIGHT_SQL} ON l.supplier = s.supplier GROUP BY s_name""")
def jn1_heavy_key(spark, folder):
    total = F.sum(F.col("l_quantity") * F.col("l_linenumber"))
    joined = op.join_heavy(*_heavy(spark, folder), "supplier", sums={"n": F.count("*"), "total": total})
    return joined.groupBy("s_name").agg(F.sum("n").alias("n"), F.sum("total").cast("bigint").alias("total"))


@query(f"""
    SELECT coalesce(s_name, 'none') AS s_name, count(*) AS n, count(l.supplier) AS with_key
    FROM {HEAVY_SQL} LEFT JOIN {HEAVY_RIGHT_SQL} ON l.supplier = s.supplier GROUP BY 1""")
def jn2_heavy_left_fill(spark, folder):
    joined = op.lookup_heavy(*_heavy(spark, folder), "supplier", {"s_name": "none"}, sums=_counts())
    return joined.groupBy("s_name").agg(F.sum("n").alias("n"), F.sum("with_key").alias("with_key"))


@query(f"""
    SELECT s_name, count(*) AS n, count(l.supplier) AS with_key
    FROM {HEAVY_SQL} JOIN {HEAVY_RIGHT_SQL} ON l.supplier IS NOT DISTINCT FROM s.supplier GROUP BY s_name""")
def jn4_heavy_null_safe(spark, folder):
    joined = op.join_heavy_null_safe(*_heavy(spark, folder), "supplier", sums=_counts())
    return joined.groupBy("s_name").agg(F.sum("n").alias("n"), F.sum("with_key").alias("with_key"))


@query("""
    SELECT user_id, event_id, event_type, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def dd1_first_rows_in_place(spark, folder):
    """The wide column is read where it lies."""
    events = table(spark, folder, "events", "user_id", "event_id", "event_type", "props")
    return first_rows_in_place(events, "user_id", ["event_id", "event_type", "props"], "event_id")


@query("SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) AS place FROM events")
def so5_numbered_rows(spark, folder):
    events = table(spark, folder, "events", "user_id", "event_id")
    return op.number_rows(events, ["user_id", "event_id"]).drop("user_id")
