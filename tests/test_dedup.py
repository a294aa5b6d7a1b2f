import pytest
from pyspark.sql import functions as F

from laborscope.operators import (
    dedup_summary,
    first_by_key,
    keep_any,
    keep_first,
    keep_last,
)

SKILLS = [
    ("a", "Python, SQL"),
    ("b", "SQL, SQL"),
    ("c", None),
    ("d", "  "),
    ("a", "IGNORAR"),
    ("e", "Go, , Rust"),
    ("f", "C++,Python"),
]


def test_first_row_wins(text_table, values):
    first = keep_first(text_table(["k", "t"], SKILLS), "k", "n").orderBy("n")
    assert values(first, "k", "t") == [r for r in SKILLS if r[1] != "IGNORAR"]


def test_last_row_wins(text_table, values):
    last = keep_last(text_table(["k", "t"], SKILLS), "k", "n")
    assert dict(values(last, "k", "t"))["a"] == "IGNORAR"
    assert last.count() == 6


def test_null_and_empty_keys_are_different_groups(text_table, values):
    rows = [(k, t) for t in ("0", "1") for k in (None, "", "x")]
    table = text_table(["k", "t"], rows)
    first = keep_first(table, "k", "n").orderBy("n")
    assert values(first, "k", "t") == [(None, "0"), ("", "0"), ("x", "0")]
    assert values(dedup_summary(table, "k")) == [(6, 3, 3)]


def test_summary_of_nothing(text_table, values):
    assert values(dedup_summary(text_table(["k"], []), "k")) == [(0, 0, 0)]


def test_several_and_computed_keys(text_table, values):
    table = text_table(["a", "b"], [("x", "1"), ("x", "2"), ("X", "1"), ("x", "1")])
    assert keep_first(table, ["a", "b"], "n").count() == 3
    assert keep_first(table, F.lower("a"), "n").count() == 1
    assert values(dedup_summary(table, [F.lower("a"), "b"])) == [(4, 2, 2)]


def test_first_by_key_returns_the_key_once(text_table):
    first = first_by_key(text_table(["k", "t"], SKILLS), "k", ["k", "t"], "n")
    assert first.columns == ["k", "t"]


def test_keep_any_keeps_one_row_per_key(text_table, values):
    kept = keep_any(text_table(["k", "t"], SKILLS), ["k"])
    assert sorted(values(kept, "k")) == [(k,) for k in "abcdef"]
    assert set(values(kept, "k", "t")) <= set(SKILLS)


@pytest.mark.parametrize("share", [3, 1])
def test_hot_key(spark, share):
    """One key with a third, or all, of the rows leaves the result whole."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % share == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (-F.col("id")).alias("o"),
    )
    first = keep_first(rows, "k", "o")
    assert first.count() == rows.select("k").distinct().count()
    hot = rows.filter("k = -1").agg(F.min("o")).first()[0]
    assert first.filter("k = -1").first()["o"] == hot
