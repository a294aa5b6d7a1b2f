"""Counts per value, full rankings, top-k and first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laborscope.functions import has_text
from laborscope.operators.dedup import Keys, _columns, first_by_key


def count_by(df: DataFrame, column: str, name: str = "n", of: str = "*") -> DataFrame:
    """Rows per value; with ``of`` set, the non-null values of that column."""
    return df.groupBy(column).agg(F.count(of).alias(name))


def rank_counts(counts: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Counted values, most frequent first, ties by value."""
    return counts.orderBy(F.col(name).desc(), F.col(column).asc())


def ranking(df: DataFrame, column: str, name: str = "n", of: str = "*") -> DataFrame:
    """All values, most frequent first, ties by value."""
    return rank_counts(count_by(df, column, name, of), column, name)


def labelled_ranking(
    df: DataFrame, labels: DataFrame, key: str, label: str, name: str = "n"
) -> DataFrame:
    """Rank the labels of a key; rows are counted per key before the join."""
    counts = count_by(df, key, "_n").join(labels.select(key, label), key)
    return rank_counts(counts.groupBy(label).agg(F.sum("_n").alias(name)), label, name)


def top_k(df: DataFrame, column: str, k: int, name: str = "n", of: str = "*") -> DataFrame:
    """The head of :func:`ranking`; deterministic at the boundary."""
    return ranking(df, column, name, of).limit(k)


def unique_values(df: DataFrame, key: str, column: str, order: Keys) -> DataFrame:
    """``column`` of the first row per key, without null and blank values.

    The filter comes after the deduplication: a first row with a blank value
    hides the later rows of its key.
    """
    return first_by_key(df, key, [column], order).filter(has_text(column)).select(column)


def count_equal(df: DataFrame, column: str, value, name: str = "n") -> DataFrame:
    """Rows whose column equals ``value`` exactly."""
    return df.filter(F.col(column) == F.lit(value)).agg(F.count("*").alias(name))


def number_rows(df: DataFrame, order: Keys, name: str = "place") -> DataFrame:
    """Add the place of every row in the whole order, from 1.

    The rows are dealt to ranges of the order and sorted there, and written down once, as
    ranges are drawn anew by every run. A row's place is its place in the range plus the
    rows of earlier ranges; only one count per range is gathered.
    """
    # Sources import operators, so here they are imported late.
    from laborscope.sources.storage import work_folder

    by = _columns(order)
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    # The upper bits of the id are the range, the lower 33 the place in it.
    placed = ranged.withColumns({"_range": F.shiftright(at, 33), "_place": at.bitwiseAND(F.lit((1 << 33) - 1))})
    path = work_folder(df.sparkSession, "ranges")
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    counts = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_range")
    return numbered.withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before")


def first_rows(df: DataFrame, order: Keys, n: int = 5) -> DataFrame:
    """The first ``n`` rows in the given order, as a sample."""
    return df.orderBy(*_columns(order)).limit(n)
