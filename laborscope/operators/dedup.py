"""Deduplication by key. Null keys form one group, apart from the empty string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborscope.functions import as_column

Keys = str | Column | Sequence[str | Column]


def _columns(columns: Keys) -> list[Column]:
    if isinstance(columns, (str, Column)):
        columns = [columns]
    return [as_column(c) for c in columns]


def _first_in_order(df: DataFrame, keys: Keys, order: list[Column]) -> DataFrame:
    # A filter on row_number() = 1 lets Spark keep one row per key in every
    # input task, so a hot key reaches its reducer as one row per task.
    rank = F.row_number().over(Window.partitionBy(*_columns(keys)).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """The first row per key. ``order`` should be unique within a key.

    Select the columns you need before calling: the kept rows are shuffled.
    For long text keys pass ``text_digest(column)``.
    """
    return _first_in_order(df, keys, [c.asc() for c in _columns(order)])


def keep_last(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """The last row per key."""
    return _first_in_order(df, keys, [c.desc() for c in _columns(order)])


def narrow(df: DataFrame, columns: Sequence[str | Column], order: Keys) -> tuple[DataFrame, list[str]]:
    """Only ``columns`` and the order, and the names the order columns got."""
    ordered = [c.alias(f"_order{i}") for i, c in enumerate(_columns(order))]
    names = [f"_order{i}" for i in range(len(ordered))]
    return df.select(*columns, *ordered), names


def first_by_key(df: DataFrame, key: str, columns: Sequence[str], order: Keys) -> DataFrame:
    """``key`` and ``columns`` of the first row per key, shuffling nothing else."""
    wanted = list(dict.fromkeys([key, *columns]))
    slim, names = narrow(df, wanted, order)
    return keep_first(slim, key, names).select(*wanted)


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key."""
    return df.dropDuplicates(list(keys))


def dedup_summary(
    df: DataFrame,
    keys: Keys,
    before: str = "rows_before",
    after: str = "rows_after",
    removed: str = "rows_removed",
) -> DataFrame:
    """One row: rows, distinct keys (null counts as a key) and their difference."""
    groups = df.groupBy(*_columns(keys)).agg(F.count("*").alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return groups.agg(
        total.alias(before),
        F.count("*").alias(after),
        (total - F.count("*")).alias(removed),
    )
