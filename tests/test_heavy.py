"""Joins with heavy keys, first rows in place and numbered rows: the same rows as the plain ways, spread over tasks."""

import pytest
from pyspark.sql import functions as F

from laborscope.operators import (
    first_by_key,
    heavy_keys,
    join_heavy,
    join_heavy_null_safe,
    join_null_safe,
    lookup,
    lookup_heavy,
    number_rows,
)
from laborscope.sources import SOURCE_ORDER, first_rows_in_place, read_parquet


@pytest.fixture
def plain_settings(spark):
    """No adaptive execution and no broadcast by size."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def sides(spark):
    """A third of the left rows has one key, a third has none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
    left = spark.range(30_000).select(key.alias("k"), "id")
    right = spark.range(9_000).select(
        F.when(F.col("id") < 3, "hot").when(F.col("id") == 5, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("other"),
    )
    return left, right


def rows(df):
    return sorted(map(str, df.collect()))


def largest(df):
    counts = df.groupBy(F.spark_partition_id().alias("p")).count()
    return max(r["count"] for r in counts.collect())


def test_heavy_joins_equal_plain_ones(sides, plain_settings):
    left, right = sides
    for how in ("inner", "left"):
        assert rows(join_heavy(left, right, "k", how).select("k", "id", "other")) == rows(left.join(right, "k", how))
        got = join_heavy_null_safe(left, right, "k", how).select("k", "id", "other")
        assert rows(got) == rows(join_null_safe(left, right, "k", how).select("k", "id", "other"))
    fill = {"other": -1}
    assert rows(lookup_heavy(left, right, "k", fill).select("k", "id", "other")) == rows(lookup(left, right, "k", fill))
    with pytest.raises(ValueError):
        join_heavy(left, right, "k", "full")


def test_heavy_keys_spread_over_tasks(sides, plain_settings):
    left, right = sides
    assert largest(left.join(right, "k", "left")) >= 30_000
    # 30,000 joined rows of the hot key and 20,000 others, over 32 tasks.
    for joined in (join_heavy(left, right, "k", "left"), join_heavy_null_safe(left, right, "k", "left")):
        assert largest(joined) < 8_000
    assert [r.k for r in heavy_keys(left, ["k"]).collect()] == ["hot"]
    assert heavy_keys(left.limit(0), ["k"]).collect() == []
    assert heavy_keys(left.filter("id % 3 = 1").limit(500), ["k"]).collect() == []


def test_heavy_key_on_both_sides_adds_up(spark, plain_settings):
    """A product of 2,000 by 3,000 rows, of which the join makes at most a row per piece and right row."""
    key = F.when(F.col("id") % 5 == 0, F.lit(7)).when(F.col("id") % 5 > 1, F.col("id"))
    left = spark.range(10_000).select(key.alias("k"), (F.col("id") % 4).alias("x"))
    right = spark.range(5_000).select(
        F.when(F.col("id") < 3_000, F.lit(7)).when(F.col("id") % 10 != 8, F.col("id")).alias("k"),
        (F.col("id") % 7).alias("name"),
    )
    sums = {"n": F.count("*"), "with_key": F.count("k"), "total": F.sum("x")}
    plain = [F.count("*").alias("n"), F.count("k").alias("with_key"), F.sum("x").alias("total")]
    added = [F.sum(n).alias(n) for n in sums]
    for how in ("inner", "left"):
        for heavy, wanted in (
            (join_heavy(left, right, "k", how, sums=sums), left.join(right, "k", how)),
            (join_heavy_null_safe(left, right, "k", how, sums=sums), join_null_safe(left, right, "k", how)),
        ):
            assert rows(heavy.groupBy("name").agg(*added)) == rows(wanted.groupBy("name").agg(*plain))
    filled = lookup_heavy(left, right, "k", {"name": -1}, sums=sums)
    assert rows(filled.groupBy("name").agg(*added)) == rows(lookup(left, right, "k", {"name": -1}).groupBy("name").agg(*plain))
    assert join_heavy(left, right, "k", sums=sums).count() <= 64 * 5_000
    assert filled.filter("k is null").count() <= 64


def test_keys_at_the_threshold(spark):
    left = spark.range(600).select((F.col("id") % 200).alias("k"))
    assert heavy_keys(left, ["k"]).count() == 200
    assert heavy_keys(left.filter("k < 150 OR id < 200"), ["k"]).count() == 150


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_first_rows_in_place(spark, tmp_path, text_table, limit):
    data = [(f"k{i % 40}" if i % 7 else None, f"text {i}") for i in range(200)] + [("", "blank"), ("once", "x"), ("", "again")]
    text_table(["k", "t"], data).repartition(5).write.parquet(str(tmp_path / "in"))
    scan = read_parquet(spark, str(tmp_path / "in"), ["k", "t"], source_order=True)
    got = first_rows_in_place(scan, "k", ["t"], broadcast_bytes=limit)
    assert rows(got) == rows(first_by_key(scan, "k", ["t"], SOURCE_ORDER))
    assert first_rows_in_place(scan.limit(0), "k", ["t"]).collect() == []


def test_first_rows_in_place_move_no_text(spark, tmp_path, text_table, plain_settings):
    text_table(["k", "t"], [("a", "x"), ("a", "y"), ("b", "z")]).write.parquet(str(tmp_path / "in"))
    scan = read_parquet(spark, str(tmp_path / "in"), ["k", "t"], source_order=True)
    text = first_rows_in_place(scan, "k", ["t"])._jdf.queryExecution().executedPlan().toString()
    # Repeated keys and the files' numbers are broadcast, behind checks of their sizes.
    assert text.count("BroadcastExchange") == 2
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_numbered_rows(spark):
    for n in (0, 1, 5_000):
        some = spark.range(n).select((F.col("id") * 7919 % 5003).alias("x"), "id").repartition(6)
        got = [tuple(r) for r in number_rows(some, ["x", "id"]).select("x", "id", "place").collect()]
        wanted = sorted((r.x, r.id) for r in some.collect())
        assert sorted(got) == [(*w, i) for i, w in enumerate(wanted, 1)]
    ties = number_rows(spark.range(300).select(F.lit(1).alias("x")), "x")
    assert sorted(r.place for r in ties.collect()) == list(range(1, 301))
    plan = number_rows(spark.range(300), "id")._jdf.queryExecution().executedPlan().toString()
    # Only the counts of the ranges are in one partition.
    assert plan.count("Exchange SinglePartition") == 1 and "Window" in plan
