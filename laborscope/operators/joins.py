"""Equi-joins on one key. No side is hinted: Spark broadcasts by measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join; null keys match nothing, repeated left rows are kept."""
    return left.join(right, key, "inner")


def lookup(left: DataFrame, right: DataFrame, key: str, fill: dict[str, object]) -> DataFrame:
    """Left join that fills the unmatched columns of ``right``."""
    joined = left.join(right, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


_STAND_IN = {
    "date": "1970-01-01",
    "timestamp": "1970-01-01",
    "timestamp_ntz": "1970-01-01",
    "boolean": False,
    "string": "",
    "binary": "",
}


def null_safe_key(df: DataFrame, key: str) -> list[Column]:
    """Two non-null columns ``_key`` and ``_no_key`` that stand for a nullable key.

    Joining and grouping on both treats null as a value of its own, like
    ``<=>``, but shares one hash partitioning between grouping and join.
    """
    kind = df.schema[key].dataType
    # Any value of the type will do, as the second column tells it from a null.
    value = _STAND_IN.get(kind.typeName(), 0)
    stand_in = F.lit(value).cast(kind)
    return [
        F.coalesce(F.col(key), stand_in).alias("_key"),
        F.col(key).isNull().alias("_no_key"),
    ]


NULL_SAFE_KEY = ["_key", "_no_key"]


def join_null_safe(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join in which a null key matches a null key; the key column comes from ``left``.

    All null keys of a side meet in one task, so filter them first if they are many.
    """
    renamed = right.withColumnRenamed(key, "_right_key")
    condition = F.col(key).eqNullSafe(F.col("_right_key"))
    return left.join(renamed, condition, how).drop("_right_key")
