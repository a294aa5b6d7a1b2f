"""Behaviour that must not depend on file size, file count or a crash."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from laborscope.operators import join_null_safe
from laborscope.operators.dedup import keep_first
from laborscope.operators.joins import null_safe_key
from laborscope.plans import QUERIES, JobDataset
from laborscope.sources import SOURCE_ORDER, csv_to_parquet, read_csv_text, read_large_csv, read_parquet, write_parts
from laborscope.streaming import incremental_keep_first, stream_parquet

CRLF = 'k,v\r\na,"x\r\ny"\r\nb,plain\r\n'
STRAY = 'k,v\na,5" pipe\nb,t\nc,"q\nr"\nd,u\n'


def written(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_line_breaks_are_kept(spark, tmp_path, values):
    path = written(tmp_path / "a.csv", CRLF)
    for read in (lambda: read_csv_text(spark, path, multiline=True, strict=True), lambda: read_large_csv(spark, path)):
        assert sorted(values(read(), "k", "v")) == [("a", "x\r\ny"), ("b", "plain")]


def test_stray_quotes_lose_nothing(spark, tmp_path, values):
    path = written(tmp_path / "a.csv", STRAY)
    for table in (read_csv_text(spark, path, multiline=True, strict=True), read_large_csv(spark, path)):
        assert sorted(values(table)) == [("a", '5" pipe'), ("b", "t"), ("c", "q\nr"), ("d", "u")]


def test_line_ends_are_told_per_record(spark, tmp_path, values):
    folder = tmp_path / "mixed"
    folder.mkdir()
    written(folder / "1.csv", 'k,v\na,x\nb,"q\r"\nc,"r\r\ns"\nd,y\r\n')
    written(folder / "2.csv", 'k,v\r\ne,x\r\nf,"q\r"\r\ng,"z\r"\nh,\r\ni,""\r\n')
    expected = [
        ("a", "x"), ("b", "q\r"), ("c", "r\r\ns"), ("d", "y"),
        ("e", "x"), ("f", "q\r"), ("g", "z\r"), ("h", None), ("i", ""),
    ]
    for read in (lambda **o: read_csv_text(spark, str(folder), multiline=True, **o), lambda **o: read_large_csv(spark, str(folder), **o)):
        table = read(source_order=True)
        assert values(table.orderBy(SOURCE_ORDER), "k", "v") == expected
    for record in ("j\r\n", "j,k,l\r\n"):
        wrong = written(tmp_path / "wrong.csv", "k,v\n" + record)
        with pytest.raises(Exception, match="MALFORMED"):
            read_csv_text(spark, wrong, multiline=True, strict=True).collect()
        assert values(read_csv_text(spark, wrong, multiline=True), "k") == [("j",)]


def test_all_readers_take_files_in_number_order(spark, tmp_path, values):
    names = ["part-2", "part-01", "part-1", "part-99999", "part-100000", "part 3 %41 é", "p+q"]
    for i, name in enumerate(names):
        written(tmp_path / f"{name}.csv", f"k,n\nsame,{name}\n")
        row = spark.createDataFrame([("same", name)], "k string, n string")
        row.coalesce(1).write.parquet(str(tmp_path / "parquet" / name))
    # Equal numbers go by the path as it is.
    order = ["p+q", "part 3 %41 é", "part-01", "part-1", "part-2", "part-99999", "part-100000"]
    csv = str(tmp_path / "*.csv")
    parquet = [str(tmp_path / "parquet" / n) for n in names]
    for table in (
        read_csv_text(spark, csv, source_order=True),
        read_csv_text(spark, csv, multiline=True, source_order=True),
        read_large_csv(spark, csv, source_order=True),
        read_parquet(spark, parquet, source_order=True),
    ):
        assert values(table.orderBy(SOURCE_ORDER), "n") == [(n,) for n in order]
        assert values(keep_first(table, "k", SOURCE_ORDER), "n") == [("p+q",)]


@pytest.mark.parametrize("record", ["a", "a,b,c"])
def test_wrong_field_number_is_an_error(spark, tmp_path, record):
    path = written(tmp_path / "a.csv", f"k,v\nx,y\n{record}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        csv_to_parquet(spark, path, str(tmp_path / "out"))


def test_marker_comes_last(spark, tmp_path):
    table = spark.range(3).withColumn("x", F.lit("y"))
    write_parts(table, str(tmp_path / "p"), marked=False)
    assert "_SUCCESS" not in os.listdir(tmp_path / "p")


def test_postings_with_line_breaks(spark, tmp_path):
    written(tmp_path / "postings.csv", 'job_link,job_title,company\na,"x\ny",A\nb,t,B\n')
    data = JobDataset(spark, str(tmp_path), postings_name="postings.csv")
    assert data.postings().count() == 2
    assert sorted(r[0] for r in QUERIES[5](data).result.collect()) == ["A", "B"]


def test_order_beyond_the_padding(spark, tmp_path, values):
    table = spark.range(1100).select(F.when(F.col("id") >= 999, "same").otherwise(F.col("id").cast("string")).alias("k"), "id")
    write_parts(table.coalesce(1).sortWithinPartitions("id"), str(tmp_path / "p"), 1)
    kept = keep_first(read_parquet(spark, str(tmp_path / "p"), source_order=True), "k", SOURCE_ORDER)
    assert values(kept.filter("k = 'same'"), "id") == [(999,)]
    for name in ("part-99999-x", "part-100000-x"):
        spark.createDataFrame([(name,)], "n string").coalesce(1).write.parquet(str(tmp_path / "w" / name))
    both = read_parquet(spark, [str(tmp_path / "w" / "part-99999-x"), str(tmp_path / "w" / "part-100000-x")], source_order=True)
    assert [n for n, _ in values(both.orderBy(SOURCE_ORDER))] == ["part-99999-x", "part-100000-x"]


def test_restart_after_a_batch_that_died(spark, tmp_path, values):
    spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int").write.parquet(str(tmp_path / "in"))
    (tmp_path / "job" / "rows" / "batch=0" / "_temporary").mkdir(parents=True)
    stream = stream_parquet(spark, str(tmp_path / "in"))
    first = incremental_keep_first(stream, "k", ["n"], "n", str(tmp_path / "job"))
    assert sorted(values(first), key=str) == [("a", 1), (None, 3)]
    (tmp_path / "job" / "rows" / "batch=1" / "_temporary").mkdir(parents=True)
    spark.createDataFrame([("a", 0), ("b", 5), (None, 6)], "k string, n int").write.mode("append").parquet(str(tmp_path / "in"))
    again = incremental_keep_first(stream_parquet(spark, str(tmp_path / "in")), "k", ["n"], "n", str(tmp_path / "job"))
    assert sorted(values(again), key=str) == [("a", 1), ("b", 5), (None, 3)]


@pytest.mark.parametrize("kind", ["date", "timestamp", "boolean", "binary", "int", "string", "double"])
def test_keys_of_any_type(spark, kind):
    table = spark.createDataFrame([(None,)], "k string").select(F.col("k").cast(kind).alias("k"))
    row = table.select(*null_safe_key(table, "k")).first()
    assert row["_key"] is not None and row["_no_key"]


def test_null_safe_join_of_dates(spark, values):
    day = datetime.date(2024, 1, 2)
    left = spark.createDataFrame([(day, 1), (None, 2)], "k date, a int")
    right = spark.createDataFrame([(day, 3), (None, 4)], "k date, b int")
    assert sorted(values(join_null_safe(left, right, "k"), "a", "b")) == [(1, 3), (2, 4)]
