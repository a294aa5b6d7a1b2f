"""Each incremental variant over several batches equals its batch result."""

import glob
import os
import re
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from laborscope.operators import (
    first_by_key,
    mean_from_totals,
    mean_length_by,
    mean_list_size,
    rank_counts,
    top_tokens,
)
from laborscope.sources import read_parquet, work_folder
from laborscope.sources.files import input_files
from laborscope.sources.storage import children, set_modified
from laborscope.streaming import (
    incremental_keep_first,
    incremental_mean_length_by,
    incremental_mean_list_size,
    incremental_token_counts,
    run_append,
    run_complete,
    run_update,
    stream_dedup,
    stream_length_totals_by,
    stream_parquet,
    stream_token_counts,
)
from laborscope.streaming.lookup import joined_levels, write_lookup
from laborscope.streaming.state import run_batches
from laborscope.streaming.versions import Versions, latest_per_key, summed_per_key

ROWS = [
    ("a", "Python, SQL"), ("b", "SQL, SQL"), ("c", None), ("d", "  "),
    ("a", "IGNORAR"), ("e", "Go, , Rust"), ("f", "C++,Python"), (None, "x"),
    ("", "y"), (None, "z"), ("b", "IGNORAR"), ("g", "SQL"),
]


@pytest.fixture
def arriving(spark, text_table, tmp_path):
    """Four files of three rows; every file is one batch."""
    path = str(tmp_path / "arriving")
    table = text_table(["k", "t"], ROWS)
    for i in range(4):
        part = table.filter((F.col("n") >= 3 * i) & (F.col("n") < 3 * i + 3)).orderBy("n")
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def test_streamed_dedup(spark, arriving):
    for spread in (None, "source_order"):
        stream = stream_dedup(stream_parquet(spark, arriving, files_per_trigger=1), ["k"], spread)
        rows = run_append(stream.select("k"), work_folder(spark, "s")).collect()
        assert sorted(str(r[0]) for r in rows) == sorted(["a", "b", "c", "d", "e", "f", "g", "", "None"])


def test_keep_first_over_batches(spark, arriving):
    folder = work_folder(spark, "s")
    stream = stream_parquet(spark, arriving, files_per_trigger=1)
    rows = incremental_keep_first(stream, "k", ["t", "n"], "n", folder).orderBy("n")
    assert [(r.k, r.t) for r in rows.collect()] == [
        r for r in ROWS if r[1] not in ("IGNORAR", "z")
    ]
    # New files continue the same state.
    more = spark.createDataFrame([("a", "IGNORAR", 50), ("h", "new", 51)], "k string, t string, n int")
    more.coalesce(1).write.mode("append").parquet(arriving)
    stream = stream_parquet(spark, arriving, files_per_trigger=1)
    again = incremental_keep_first(stream, "k", ["t", "n"], "n", folder).orderBy("n").collect()
    assert [r.k for r in again] == ["a", "b", "c", "d", "e", "f", None, "", "g", "h"]


def test_token_counts(spark, arriving, values):
    batch = values(top_tokens(read_parquet(spark, arriving), "k", "t", "n"))
    folder = work_folder(spark, "s")
    for _ in range(2):  # the second run finds nothing new
        stream = stream_parquet(spark, arriving, files_per_trigger=1)
        counts = incremental_token_counts(stream, "k", "t", "n", folder)
        assert values(rank_counts(counts, "token").limit(20)) == batch
    assert batch[0] == ("SQL", 4)


def test_streamed_token_counts(spark, tmp_path, text_table, values):
    rows = [(f"k{i % 7}", ", ".join(["x"] * (i % 7 + 1))) for i in range(40)]
    path = str(tmp_path / "copies")
    for i in range(4):
        part = text_table(["k", "t"], rows[10 * i : 10 * i + 10])
        part.coalesce(1).write.mode("append").parquet(path)
    folder = work_folder(spark, "s")
    for spread in (None, "source_order"):
        stream = stream_parquet(spark, path, files_per_trigger=1)
        counts = stream_token_counts(stream, "k", "t", spread_by=spread)
        assert values(run_complete(counts, f"{folder}-{spread}")) == [("x", 28)]
        assert values(run_update(counts, ["token"], f"{folder}-update-{spread}")) == [("x", 28)]
    assert values(run_complete(counts, f"{folder}-{spread}")) == [("x", 28)]


def test_mean_length(spark, arriving, text_table, values):
    levels = text_table(
        ["k", "level"],
        [("a", "Senior"), ("a", "Otro"), ("b", " "), ("b", "x"), ("e", "Junior"), ("f", "Junior"), (None, "x")],
    )
    batch = values(mean_length_by(read_parquet(spark, arriving), levels, "k", "t", "level", "n"))
    assert batch == [("Junior", 2, 10.0), ("Senior", 2, 9.0)]
    stream = stream_parquet(spark, arriving, files_per_trigger=1)
    got = incremental_mean_length_by(
        stream, levels, "k", "t", "level", "n", work_folder(spark, "s")
    )
    assert values(got) == batch
    first = first_by_key(levels, "k", ["level"], "n")
    folder = work_folder(spark, "s")
    stream = stream_parquet(spark, arriving, files_per_trigger=1)
    totals = stream_length_totals_by(stream, first, "k", "t", "level", folder)
    got = mean_from_totals(run_update(totals, ["level"], folder), "level")
    assert values(got) == batch
    # Levels too large to broadcast are refused.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10)
    try:
        with pytest.raises(ValueError):
            stream_length_totals_by(stream, first, "k", "t", "level", folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_mean_list_size(spark, arriving, text_table, values):
    postings = text_table(["k"], [("a",), ("b",), ("c",), ("z",), (None,), ("a",)])
    batch = values(mean_list_size(postings, read_parquet(spark, arriving), "k", "t", "n"))
    assert batch == [(5, 3, 1.0)]
    stream = stream_parquet(spark, arriving, files_per_trigger=1)
    got = incremental_mean_list_size(postings, stream, "k", "t", "n", work_folder(spark, "s"))
    assert values(got) == batch


@pytest.mark.parametrize("batch", [0, 2])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_batch_is_resumed(spark, arriving, values, monkeypatch, batch, when):
    """A job that dies before or after a batch has written goes on with that batch, which counts once."""
    expected = values(top_tokens(read_parquet(spark, arriving), "k", "t", "n"))
    save, folder = Versions.save, work_folder(spark, "s")

    def dying(self, rows, batch_id):
        if batch_id == batch and when == "before":
            raise RuntimeError("killed")
        save(self, rows, batch_id)
        if batch_id == batch:
            raise RuntimeError("killed")

    def counts():
        stream = stream_parquet(spark, arriving, files_per_trigger=1)
        return incremental_token_counts(stream, "k", "t", "n", folder)

    with monkeypatch.context() as patched:
        patched.setattr(Versions, "save", dying)
        with pytest.raises(StreamingQueryException):
            counts()
    assert values(rank_counts(counts(), "token").limit(20)) == expected


def test_work_follows_the_batch(spark, tmp_path, monkeypatch, values):
    """50 batches of 20 new keys and 20 known ones: each touches its own keys, and merges stay in proportion."""
    path, folder = str(tmp_path / "in"), work_folder(spark, "s")
    rows = spark.range(50 * 20).select((F.col("id") / 20).cast("int").alias("b"), F.col("id").cast("string").alias("k"))
    known = rows.filter("b < 49").select((F.col("b") + 1).alias("b"), "k")
    some = rows.union(known).withColumn("t", F.concat(F.lit("x, t"), F.col("k").cast("int") % 100))
    some.repartitionByRange(50, "b").write.parquet(path)
    for i, file in enumerate(input_files(spark.read.parquet(path))):
        set_modified(spark, file, 1_700_000_000_000 + 1000 * i)
    progress, merged, fold = [], [], Versions._rows

    def run(*args):
        query = run_batches(*args)
        progress.extend(query.recentProgress)
        return query

    def counted(self, newest, batches):
        found = fold(self, newest, batches)
        merged.append(found.count())
        return found

    monkeypatch.setattr("laborscope.streaming.incremental.run_batches", run)
    monkeypatch.setattr(Versions, "_rows", counted)
    stream = stream_parquet(spark, path, files_per_trigger=1)
    got = incremental_token_counts(stream, "k", "t", "b", folder)
    assert dict(values(got)) == {"x": 1000} | {f"t{i}": 10 for i in range(100)}
    # A range partition may hold two of the fifty.
    batches = [(p["numInputRows"], p["stateOperators"][0]) for p in progress if p["numInputRows"]]
    assert 45 <= len(batches) <= 50
    # State of 1,000 keys in the end, of which a batch writes its own.
    assert batches[-1][1]["numRowsTotal"] == 1000
    assert all(s["numRowsUpdated"] <= n <= 80 for n, s in batches)
    # Batches add 21 counts each, merged a few times over.
    assert sum(merged) < 4 * 50 * 21
    left = [n for n in children(spark, f"{folder}/counts")]
    assert sum(n.startswith("upto") for n in left) == 1 and len(left) < 25


def test_merged_tables(spark, tmp_path, values):
    schema = "k string, n bigint"
    empty = spark.createDataFrame([], schema)
    newest = Versions(spark, str(tmp_path / "latest"), empty.schema, latest_per_key(["k"]))
    summed = Versions(spark, str(tmp_path / "summed"), empty.schema, summed_per_key(["k"]))
    assert newest.read().collect() == []
    for i in [*range(20), 19]:
        rows = spark.createDataFrame([("a", i), (f"k{i}", None), (None, i)], schema)
        newest.save(rows, i)
        summed.save(rows, i)
    assert dict(values(newest.read())) == {"a": 19, None: 19} | {f"k{i}": None for i in range(20)}
    assert dict(values(summed.read())) == {"a": 190, None: 190} | {f"k{i}": None for i in range(20)}
    assert len(children(spark, str(tmp_path / "latest"))) < 20
    # What a job that died has left isn't read.
    (tmp_path / "latest" / "batch=90").mkdir()
    (tmp_path / "latest" / "upto=95" / "_temporary").mkdir(parents=True)
    assert dict(values(newest.read()))["a"] == 19


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(4000).repartition(12).write.parquet(path)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")]
    seen = []
    stream = stream_parquet(spark, path, bytes_per_trigger=3 * max(sizes) + 1)
    run_batches(stream, lambda batch, i: seen.append(batch.count()), work_folder(spark, "s"))
    assert sum(seen) == 4000 and 4 <= len(seen) <= 6


def test_lookup_reads_the_buckets_of_the_batch(spark, tmp_path, values):
    levels = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("level"))
    write_lookup(levels, "k", str(tmp_path / "l"), bucket_rows=100)
    write_lookup(levels.limit(1), "k", str(tmp_path / "l"), bucket_rows=100)  # it is there already
    batch = spark.createDataFrame([("7", 1), ("12", 2), ("none", 3), (None, 4)], "k string, n int")
    joined = joined_levels(batch, "k", str(tmp_path / "l"))
    assert sorted(values(joined, "k", "n", "level")) == [("12", 2, 0), ("7", 1, 1)]
    filters = re.search(r"PartitionFilters: \[(.*?)\]", joined._jdf.queryExecution().executedPlan().toString())
    assert "_bucket" in filters.group(1)
    assert len(children(spark, str(tmp_path / "l" / "of=11"))) > 8


def test_no_files_yet(spark, tmp_path, values):
    empty = str(tmp_path / "none")
    (tmp_path / "none").mkdir()
    schema = spark.createDataFrame([], "k string, t string, n int").schema
    stream = stream_parquet(spark, empty, schema)
    assert values(incremental_token_counts(stream, "k", "t", "n", work_folder(spark, "s"))) == []
    counts = stream_token_counts(stream_parquet(spark, empty, schema), "k", "t")
    assert values(run_complete(counts, work_folder(spark, "s"))) == []


def test_complete_results_keep_few_state_partitions(spark, arriving, tmp_path, values):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        stream = stream_parquet(spark, arriving, files_per_trigger=1)
        counts = run_complete(stream.groupBy("k").count(), str(tmp_path / "few"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
        # Every state partition is a task in every batch, and its report goes to the driver.
        assert len([n for n in os.listdir(tmp_path / "few/checkpoint/state/0") if n.isdigit()]) == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    expected = Counter(k for k, _ in ROWS)
    assert dict(values(counts, "k", "count")) == expected
