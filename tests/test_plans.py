"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from laborscope.catalog import QUERIES, jobs, sources
from laborscope.operators import (
    first_by_key,
    keep_first,
    mean_length_by,
    mean_list_size,
    ranking,
    top_k,
    top_tokens,
    treatment_report,
)
from laborscope.sources import SOURCE_ORDER, read_large_csv, read_parquet


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node):
    return len(re.findall(rf"\b{node}\b", plan(df)))


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_keep_first_reduces_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    text = plan(keep_first(rows, "k", "id"))
    partial = text.index("Partial")
    assert text.index("Final") < text.index("Exchange") < partial
    assert text.count("Exchange") == 1


def test_only_needed_columns_are_read_and_shuffled(spark, folder):
    table = spark.read.parquet(f"{folder}/orders.parquet")
    text = plan(first_by_key(table, "o_custkey", ["o_orderstatus"], "o_orderkey"))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["o_custkey", "o_orderkey", "o_orderstatus"]


def test_filter_reaches_the_scan(spark, folder):
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan(QUERIES["pf4_equal"](spark, folder))
    assert "Not(EqualTo(text,))" in plan(QUERIES["q7_mean_length_by"](spark, folder))


def test_deduplication_stays_below_the_filter(spark, folder):
    text = plan(QUERIES["q7_dedup_first"](spark, folder))
    assert text.index("trim(") < text.index("WindowGroupLimit")


def test_top_k_does_not_sort_everything(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"))
    assert "TakeOrderedAndProject" in plan(top_k(rows, "k", 3))
    assert "rangepartitioning" in plan(ranking(rows, "k"))
    assert "partial_count" in plan(ranking(rows, "k"))


def test_mean_length_joins_without_a_second_shuffle(spark, folder, no_broadcast):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("q", F.col("quality").cast("string"))
    means = mean_length_by(documents, labels, "doc_id", "text", "q", "doc_id")
    text = plan(means)
    # Texts by key, levels by key, groups by level, final sort.
    assert text.count("Exchange") == 4 and "SortMergeJoin" in text
    # Below the first aggregation only the length is left of the text.
    exchanges = re.findall(r"Exchange hashpartitioning\(doc_id.*\n.*", text)
    assert exchanges and not any("text#" in e for e in exchanges)


def test_mean_list_size_shares_one_partitioning(spark, folder, no_broadcast):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    lists = documents.select("doc_id", "text", "n_chars")
    text = plan(mean_list_size(documents, lists, "doc_id", "text", "n_chars"))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Exchange SinglePartition") == 1
    assert "SortMergeJoin" in text


def test_tokens_are_counted_before_the_shuffle(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    text = plan(top_tokens(documents, "doc_id", "text", "doc_id"))
    assert "partial_count" in text and "TakeOrderedAndProject" in text


def test_report_reads_once(spark, folder):
    table = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("k"), "o_orderstatus", "o_orderpriority"
    )
    text = plan(treatment_report(table, "k"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_source_order_takes_no_path_apart(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "p"))
    text = plan(keep_first(read_parquet(spark, str(tmp_path / "p"), source_order=True), "id", SOURCE_ORDER))
    assert "regexp" not in text and "BroadcastHashJoin" in text
    # The order that is shuffled and compared is two numbers.
    order = read_parquet(spark, str(tmp_path / "p"), source_order=True).schema[SOURCE_ORDER].dataType
    assert order.simpleString() == "struct<file:bigint,row:bigint>"


def test_split_csv_shuffles_only_what_crosses_a_border(spark, folder, tmp_path, no_broadcast):
    spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").write.option("header", True).csv(
        str(tmp_path / "csv")
    )
    text = plan(read_large_csv(spark, str(tmp_path / "csv"), source_order=True))
    assert text.count("Exchange") == 1 and "Join" not in text and "Window" not in text
    # Below the only exchange are the lines of records that cross a border.
    below = text[text.index("Exchange") :]
    assert re.search(r"Exchange hashpartitioning\(file#\d+L?, block#\d+L?", below)
    assert text.count("MapInArrow") == 2 and below.count("MapInArrow") == 1


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_postings_are_shuffled_once(spark, tmp_path, monkeypatch, no_broadcast, limit):
    """Line items meet their orders, and are sorted, in one partitioning; names come late or early."""
    made = {
        "lineitem": "SELECT id % 50 AS l_orderkey, CAST(id % 7 AS INT) AS l_linenumber, id AS l_partkey, id % 5 AS l_suppkey,"
        " timestamp'2020-01-01' AS l_shipdate, 'A' AS l_returnflag FROM range(1000)",
        "orders": "SELECT id AS o_orderkey, '1-URGENT' AS o_orderpriority FROM range(50)",
        "supplier": "SELECT id AS s_suppkey, concat('s', id) AS s_name, CAST(0 AS INT) AS s_nationkey FROM range(5)",
        "nation": "SELECT 0 AS n_nationkey, 'x' AS n_name",
    }
    for name, sql in made.items():
        spark.sql(sql).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(jobs, "SUPPLIER_BYTES", limit)
    postings = jobs._postings(spark, str(tmp_path))
    text = plan(postings)
    assert "rangepartitioning" not in text
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1 and "REPARTITION_BY_COL" in text
    postings.write.parquet(str(tmp_path / "out"))
    got = read_parquet(spark, str(tmp_path / "out"), source_order=True).orderBy(SOURCE_ORDER).collect()
    assert len(got) == 1000
    files, lines = {}, {}
    for r in got:
        files.setdefault(r.job_link, set()).add(r[SOURCE_ORDER].file)
        lines.setdefault(r.job_link, []).append(int(r.job_title.split()[1]))
    assert all(len(f) == 1 for f in files.values())
    assert all(x == sorted(x) for x in lines.values())


def test_parts_are_written_by_every_task(spark, tmp_path, monkeypatch):
    """No part goes through one task, and its files add up."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(", ", F.lit("a"), F.col("id")).alias("text"))
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(sources, "work_folder", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        got = sorted(tuple(r) for r in QUERIES["sc7_per_file"](spark, str(tmp_path)).select("part", "rows", "items").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, 50, 100) for i in range(8)]
    assert len(list((tmp_path / "parts" / "part=0").glob("*.parquet"))) > 1


#: Reading a split CSV file needs the order of its lines.
IN_ARROW = {"sc3_multiline_csv_split", "sc3_mixed_line_ends"}


def test_no_plan_uses_python_or_a_cross_join(spark, folder):
    for name, query in QUERIES.items():
        if name in IN_ARROW:
            continue
        text = plan(query(spark, folder))
        for node in ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop"):
            assert node not in text, (name, node)
