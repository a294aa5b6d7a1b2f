"""Null and blank profiling and treatment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborscope.functions import (
    MISSING_LABEL,
    NULL_LABEL,
    blank_to_null,
    fill_missing,
    has_text,
    is_blank,
)


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Keep the rows whose key is neither null nor blank."""
    return df.filter(has_text(key))


def blanks_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Blank text becomes null in every column (or the given ones)."""
    return df.withColumns({c: blank_to_null(c) for c in columns or df.columns})


def impute(
    df: DataFrame,
    key: str,
    label: str = MISSING_LABEL,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Drop rows without a key and label null or blank text in the other columns."""
    columns = [c for c in (columns or df.columns) if c != key]
    return drop_missing_key(df, key).withColumns({c: fill_missing(c, label) for c in columns})


def impute_nulls(df: DataFrame, columns: Sequence[str], label: str = NULL_LABEL) -> DataFrame:
    """Label nulls, but not blanks, in the given columns."""
    return df.na.fill(label, subset=list(columns))


def _rows(measures: DataFrame, columns: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """Turn one wide row with a struct per column into one row per column."""
    entries = [
        F.struct(F.lit(c).alias(name), *[F.col(f"`{i}.{f}`").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ]
    return measures.select(F.inline(F.array(*entries)))


def null_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    column: str = "column",
    nulls: str = "nulls",
    blanks: str = "blanks",
) -> DataFrame:
    """Nulls and blanks per column, all counted in one pass."""
    columns = list(columns or df.columns)
    measures = []
    for i, c in enumerate(columns):
        measures.append(F.count_if(F.col(c).isNull()).alias(f"{i}.{nulls}"))
        measures.append(F.count_if(is_blank(c)).alias(f"{i}.{blanks}"))
    return _rows(df.agg(*measures), columns, [nulls, blanks], column)


def treatment_report(
    df: DataFrame,
    key: str,
    label: str = MISSING_LABEL,
    columns: Sequence[str] | None = None,
    column: str = "column",
    nulls_before: str = "nulls_before",
    blanks_before: str = "blanks_before",
    nulls_after: str = "nulls_after",
    dropped: str = "rows_dropped",
) -> DataFrame:
    """Profile before and after :func:`impute`, from one scan and one aggregation."""
    columns = list(columns or df.columns)
    kept = F.coalesce(has_text(key), F.lit(False))
    dropped_rows = F.count_if(~kept)
    measures = []
    for i, c in enumerate(columns):
        treated = F.col(c) if c == key else fill_missing(c, label)
        measures += [
            F.count_if(F.col(c).isNull()).alias(f"{i}.{nulls_before}"),
            F.count_if(is_blank(c)).alias(f"{i}.{blanks_before}"),
            F.count_if(kept & treated.isNull()).alias(f"{i}.{nulls_after}"),
            dropped_rows.alias(f"{i}.{dropped}"),
        ]
    fields = [nulls_before, blanks_before, nulls_after, dropped]
    return _rows(df.agg(*measures), columns, fields, column)
