"""Statistics over text lengths, delimited lists and arrays.

Texts are reduced to a number before any shuffle, and both sides of a join
are reduced to one row per key first, so a key that holds a large share of
the rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from laborscope.functions import (
    DEFAULT_SEPARATOR,
    as_column,
    has_text,
    list_count,
    not_empty,
    round2,
    strip,
    text_length,
    to_list,
)
from laborscope.operators.dedup import Keys, first_by_key, keep_first, narrow
from laborscope.operators.joins import NULL_SAFE_KEY, null_safe_key
from laborscope.operators.ranking import ranking


def _present(df: DataFrame, column: str):
    if isinstance(df.schema[column].dataType, StringType):
        return not_empty(column)
    return F.col(column).isNotNull()


def add_list(
    df: DataFrame, text: str, name: str = "tokens", separator: str = DEFAULT_SEPARATOR
) -> DataFrame:
    """Add the delimited text as an array."""
    return df.withColumn(name, to_list(text, separator))


def list_summary(
    df: DataFrame,
    text: str,
    separator: str = DEFAULT_SEPARATOR,
    rows: str = "rows",
    items: str = "items",
) -> DataFrame:
    """One row: number of rows and of list items, empty items included."""
    items_sum = F.coalesce(F.sum(list_count(text, separator)), F.lit(0))
    return df.agg(F.count("*").alias(rows), items_sum.alias(items))


def tokens(
    df: DataFrame, text: str, name: str = "token", separator: str = DEFAULT_SEPARATOR
) -> DataFrame:
    """One row per list item, stripped, empty items left out."""
    items = df.select(F.explode(to_list(text, separator)).alias(name))
    return items.filter(has_text(name)).select(strip(name).alias(name))


def token_ranking(
    df: DataFrame,
    text: str,
    name: str = "token",
    count: str = "n",
    separator: str = DEFAULT_SEPARATOR,
) -> DataFrame:
    return ranking(tokens(df, text, name, separator), name, count)


def top_tokens(
    df: DataFrame,
    key: str,
    text: str,
    order: Keys,
    k: int = 20,
    name: str = "token",
    count: str = "n",
    separator: str = DEFAULT_SEPARATOR,
) -> DataFrame:
    """Most frequent list items over the first row per key."""
    first = first_by_key(df, key, [text], order)
    return token_ranking(first, text, name, count, separator).limit(k)


def length_totals(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``key, _n, _total``: texts and characters per key; empty keys and texts are left out."""
    lengths = texts.filter(_present(texts, key) & not_empty(text)).select(
        key, text_length(text).alias("_length")
    )
    return lengths.groupBy(key).agg(F.count("*").alias("_n"), F.sum("_length").alias("_total"))


def first_levels(levels: DataFrame, key: str, level: str, order: Keys) -> DataFrame:
    """``key, level`` of the first row per key, where the level has text."""
    first = first_by_key(levels, key, [level], order)
    return first.filter(_present(levels, key) & has_text(level))


def length_totals_by(
    texts: DataFrame, levels: DataFrame, key: str, text: str, level: str
) -> DataFrame:
    """``level, _n, _total``: mergeable sums; ``levels`` has one row per key."""
    joined = length_totals(texts, key, text).join(levels, key)
    return joined.groupBy(level).agg(F.sum("_n").alias("_n"), F.sum("_total").alias("_total"))


def mean_from_totals(
    totals: DataFrame, level: str, count: str = "n", mean: str = "mean_length"
) -> DataFrame:
    """Merge ``_n`` and ``_total`` rows per level into count and rounded mean, sorted by level."""
    merged = totals.groupBy(level).agg(
        F.sum("_n").alias(count), round2(F.sum("_total") / F.sum("_n")).alias(mean)
    )
    return merged.orderBy(level)


def mean_length_by(
    texts: DataFrame,
    levels: DataFrame,
    key: str,
    text: str,
    level: str,
    order: Keys,
    count: str = "n",
    mean: str = "mean_length",
) -> DataFrame:
    """Texts and mean text length per level. Repeated texts of a key each count.

    ``levels`` is deduplicated by key before blank levels are dropped, and
    the level is grouped as it is, untrimmed.
    """
    joined = length_totals(texts, key, text).join(first_levels(levels, key, level, order), key)
    return mean_from_totals(joined, level, count, mean)


def mean_size_over_keys(
    base: DataFrame, sizes: DataFrame, key: str, rows: str, with_items: str, mean: str
) -> DataFrame:
    """Mean of ``_size`` over the distinct keys of ``base``; ``sizes`` has one row per key."""
    # Grouping, window and join all partition by the same two columns.
    keys = base.select(*null_safe_key(base, key)).distinct()
    size = F.coalesce(F.col("_size"), F.lit(0))
    return keys.join(sizes, NULL_SAFE_KEY, "left").agg(
        F.count("*").alias(rows),
        F.count_if(size > 0).alias(with_items),
        round2(F.sum(size) / F.when(F.count("*") > 0, F.count("*"))).alias(mean),
    )


def mean_list_size(
    base: DataFrame,
    lists: DataFrame,
    key: str,
    text: str,
    order: Keys,
    separator: str = DEFAULT_SEPARATOR,
    rows: str = "rows",
    with_items: str = "rows_with_items",
    mean: str = "mean_items",
) -> DataFrame:
    """Mean list size over the distinct keys of ``base``; a key without a list counts as 0.

    The list of a key is its first row in ``lists``. A null key matches a null key.
    """
    counted = lists.withColumns({"_size": list_count(text, separator)})
    slim, names = narrow(counted, [*null_safe_key(lists, key), "_size"], order)
    sizes = keep_first(slim, NULL_SAFE_KEY, names).drop(*names)
    return mean_size_over_keys(base, sizes, key, rows, with_items, mean)


def mean_list_size_by(
    base: DataFrame,
    lists: DataFrame,
    key: str,
    text: str,
    group: str,
    order: Keys,
    separator: str = DEFAULT_SEPARATOR,
    mean: str = "mean_items",
) -> DataFrame:
    """Unrounded mean list size per group over the matching rows of ``lists``.

    ``base`` is deduplicated by key, ``lists`` is not: its rows are summed per
    key before the join.
    """
    sizes = lists.select(key, list_count(text, separator).alias("_size"))
    totals = sizes.groupBy(key).agg(F.count("*").alias("_n"), F.sum("_size").alias("_total"))
    first = first_by_key(base, key, [group], order)
    return (
        first.join(totals, key)
        .groupBy(group)
        .agg((F.sum("_total") / F.sum("_n")).alias(mean))
    )


def array_mean(
    df: DataFrame, array: str, count: str = "n", mean: str = "mean"
) -> DataFrame:
    """Number and mean of all elements of an array column."""
    elements = df.select(F.explode(as_column(array)).alias("_x"))
    return elements.agg(F.count("_x").alias(count), F.avg(F.col("_x").cast("double")).alias(mean))


def mean_by(df: DataFrame, group: str, value: str, mean: str = "mean") -> DataFrame:
    """Unrounded mean per group."""
    return df.groupBy(group).agg(F.avg(value).alias(mean))
