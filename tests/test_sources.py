import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from laborscope.session import size_shuffles
from laborscope.sources import (
    SOURCE_ORDER,
    collect_small,
    csv_to_parquet,
    per_file,
    preview,
    read_complete_parquet,
    read_csv_text,
    read_large_csv,
    read_parquet,
    sample_json,
    write_csv,
    write_parts,
    write_sample_csv,
)

HEADER = "job_link,job_summary\n"


def put(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


@pytest.fixture
def odd_csv(tmp_path):
    body = (
        'a,"line 1\nline ""2"""\n'
        "b,\n"
        'c,""\n'
        "NA,null\n"
        'd," spaced "\n'
    )
    return put(tmp_path / "odd.csv", HEADER + body)


READERS = [lambda s, p, **o: read_csv_text(s, p, multiline=True, **o), read_large_csv]


@pytest.mark.parametrize("read", READERS)
def test_csv_fields_stay_text(spark, odd_csv, values, read):
    assert dict(values(read(spark, odd_csv))) == {
        "a": 'line 1\nline "2"',
        "b": None,
        "c": "",
        "NA": "null",
        "d": " spaced ",
    }


@pytest.mark.parametrize("read", READERS)
def test_csv_missing_fields(spark, odd_csv, values, read):
    blank = dict(values(read(spark, odd_csv, missing="blank")))
    assert blank["b"] == blank["c"] == ""
    null = dict(values(read(spark, odd_csv, missing="null")))
    assert null["b"] is None and null["c"] is None
    assert sorted(values(read(spark, odd_csv, columns=["job_link"])))[0] == ("NA",)


def test_csv_options(spark, odd_csv, tmp_path):
    with pytest.raises(ValueError):
        read_csv_text(spark, odd_csv, missing="other")
    numbers = put(tmp_path / "numbers.csv", "a,b\n1,x\n2,y\n")
    assert read_csv_text(spark, numbers).dtypes == [("a", "string"), ("b", "string")]
    assert read_csv_text(spark, numbers, infer_types=True).dtypes == [("a", "int"), ("b", "string")]


@pytest.fixture(scope="module")
def big_csv(tmp_path_factory):
    """Files with line breaks, quotes and separators inside fields, and long records."""
    rng = random.Random(7)
    pieces = ["a", "b", ",", '"', "\n", "\r\n", "é😀", " ", '""', "NA", "null", "#", "\\"]
    folder = tmp_path_factory.mktemp("big")
    rows = []
    for part in range(2):
        some = [
            [f"k{part}-{i}", "".join(rng.choices(pieces, k=rng.choice([0, 1, 5, 40, 300]))), rng.choice(["", " y "])]
            for i in range(300)
        ]
        some.insert(150, [f"long-{part}", "z\n" * 4000, "x"])
        some.append([f"end-{part}", "u\n", "\n"])
        with open(folder / f"{part}.csv", "w", newline="", encoding="utf-8") as file:
            ending = "\n" if part == 0 else "\r\n"
            writer = csv.writer(file, quoting=csv.QUOTE_ALL, lineterminator=ending)
            writer.writerow(["job_link", "t", 'c,"x'])
            writer.writerows(some)
        rows += some
    return str(folder), [tuple(r) for r in rows]


@pytest.mark.parametrize("block", [700, 4096, 100_000, 128 * 1024 * 1024])
def test_large_csv_splits_files(spark, big_csv, block):
    path, rows = big_csv
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        table = read_large_csv(spark, path, source_order=True)
        got = [tuple(r) for r in table.orderBy(SOURCE_ORDER).drop(SOURCE_ORDER).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == rows


def test_csv_source_order(spark, tmp_path, values):
    path = put(tmp_path / "order.csv", "k\n" + "\n".join(f"{i}" for i in range(2000, 0, -1)) + "\n")
    rows = read_csv_text(spark, path, source_order=True).orderBy(SOURCE_ORDER)
    assert [r[0] for r in values(rows, "k")] == [f"{i}" for i in range(2000, 0, -1)]


@pytest.mark.parametrize("split", [True, False])
def test_conversion(spark, odd_csv, tmp_path, split):
    target = str(tmp_path / "out")
    parts, rows = csv_to_parquet(spark, odd_csv, target, rows_per_part=2, split=split)
    assert rows == 5 and parts >= 3
    marker = json.loads((tmp_path / "out" / "_SUCCESS").read_text())
    assert marker == {"origen": odd_csv, "partes": parts, "filas": 5}
    table = read_complete_parquet(spark, target, source_order=True)
    assert max(r[0] for r in per_file(spark.read.parquet(target)).select("rows").collect()) <= 2
    assert dict(table.drop(SOURCE_ORDER).collect())["b"] == ""
    with pytest.raises(FileExistsError):
        csv_to_parquet(spark, odd_csv, target)


def test_conversion_refuses_bad_input(spark, tmp_path):
    empty = put(tmp_path / "empty.csv", HEADER)
    with pytest.raises(ValueError):
        csv_to_parquet(spark, empty, str(tmp_path / "t1"))
    assert not (tmp_path / "t1").exists()
    with pytest.raises(ValueError):
        csv_to_parquet(spark, empty, str(tmp_path / "t2"), rows_per_part=0)
    with pytest.raises(ValueError):
        write_parts(spark.range(1), str(tmp_path / "t3"), 0)


def test_incomplete_folders_are_refused(spark, tmp_path):
    target = str(tmp_path / "parts")
    spark.range(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
    with pytest.raises(FileNotFoundError):
        read_complete_parquet(spark, target)
    lonely = tmp_path / "lonely"
    lonely.mkdir()
    (lonely / "_SUCCESS").touch()
    with pytest.raises(FileNotFoundError):
        read_complete_parquet(spark, str(lonely))


def test_empty_parquet_reads_empty(spark, tmp_path):
    target = str(tmp_path / "none")
    spark.createDataFrame([], "job_link string, job_summary string").coalesce(1).write.parquet(target)
    assert read_complete_parquet(spark, target).count() == 0


def test_parts_and_report_per_file(spark, tmp_path):
    target = str(tmp_path / "parts")
    assert write_parts(spark.range(1000).coalesce(1), target, 100) == 1000
    files = per_file(spark.read.parquet(target), total=F.sum("id"))
    assert sorted(r["rows"] for r in files.collect()) == [100] * 10
    assert files.agg(F.sum("total")).first()[0] == sum(range(1000))


def test_projection(spark, tmp_path):
    spark.range(3).withColumn("x", F.col("id")).write.parquet(str(tmp_path / "p"))
    table = read_parquet(spark, str(tmp_path / "p"), ["x"], source_order=True)
    assert table.columns == ["x", SOURCE_ORDER]


def test_csv_sink_keeps_text(spark, tmp_path, values):
    rows = [("a", ' "x", y\n '), ("b", ""), ("c", None), ("d", "\t")]
    table = spark.createDataFrame(rows, "k string, t string")
    write_csv(table, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    assert values(read_csv_text(spark, str(tmp_path / "out"), multiline=True)) == rows


def test_samples(spark, tmp_path, values, capsys):
    table = spark.range(20).select((20 - F.col("id")).alias("k"), F.array(F.lit("x")).alias("l"))
    array = json.loads(sample_json(table, "k", 3).first()[0])
    assert array == [{"k": i, "l": ["x"]} for i in (1, 2, 3)]
    write_sample_csv(table, str(tmp_path / "s"), "k", 2, drop=["l"])
    assert values(read_csv_text(spark, str(tmp_path / "s"))) == [("1",), ("2",)]
    assert preview(table) == 20 and "rows: 20" in capsys.readouterr().out


def test_collect_is_bounded(spark):
    assert len(collect_small(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        collect_small(spark.range(6), 5)


def test_shuffles_follow_the_input(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "p"))
    assert size_shuffles(spark, str(tmp_path / "p")) == spark.sparkContext.defaultParallelism
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_large_csv_edges(spark, tmp_path, values):
    """Header-only files, blank lines, no last line break, and one-line records."""
    folder = tmp_path / "edges"
    folder.mkdir()
    put(folder / "0.csv", "k,t\n")
    put(folder / "1.csv", 'k,t\n\na,"1\n\n2"\n\n\nb,x')
    put(folder / "2.csv", 'k,t\r\nc,"y\r\n"\r\n"d","z"\r\n')
    put(folder / "3.csv", 'k,t\ne,"' + "q" * 50 + '""\n"')
    put(folder / "4.csv", "k,t")
    expected = [("a", "1\n\n2"), ("b", "x"), ("c", "y\r\n"), ("d", "z"), ("e", "q" * 50 + '"\n')]
    table = read_large_csv(spark, str(folder), source_order=True).orderBy(SOURCE_ORDER)
    assert values(table, "k", "t") == expected


@pytest.mark.parametrize("seed", range(4))
def test_large_csv_equals_the_plain_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    pieces = ["a", "b c", ",", '"', "\n", "é", ""]
    rows = [[f"k{i}", "".join(rng.choices(pieces, k=rng.randrange(12)))] for i in range(400)]
    path = tmp_path / "minimal.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator="\n").writerows([["k", "t"], *rows])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = read_large_csv(spark, str(path), missing="blank").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    plain = read_csv_text(spark, str(path), multiline=True, missing="blank").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain)) == sorted(map(tuple, rows))
