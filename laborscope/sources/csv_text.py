"""Scans of CSV as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.sources.files import csv_reader, with_position
from laborscope.sources.large_csv import read_large_csv


def _carriage_returns(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Does any line end in CR LF? Stops at the first one found."""
    lines = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return not lines.filter(F.col("value").endswith("\r")).isEmpty()


def read_csv_text(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    multiline: bool = False,
    missing: str = "distinct",
    infer_types: bool = False,
    strict: bool = False,
    source_order: bool = False,
) -> DataFrame:
    """Scan CSV with a header; every field stays text, also ``NA`` and ``null``.

    ``missing`` says what an absent field becomes: ``"distinct"`` keeps an
    unquoted empty field as null and a quoted one as ``""``, ``"null"`` makes
    both null, ``"blank"`` makes both ``""``. ``multiline`` accepts quoted line
    breaks of any kind and keeps them. Every line may end in LF or CR LF: where
    any does in CR LF, each record shows by itself whether its CR is quoted, and
    the files are read by :func:`read_large_csv`; others by one task per file.
    ``strict`` fails on a record with more or fewer fields than the header.
    ``source_order`` adds a sortable position column.
    """
    reader = csv_reader(spark, missing, multiline=multiline, infer_types=infer_types)
    if multiline and _carriage_returns(spark, path):
        table = read_large_csv(spark, path, columns, missing=missing, strict=strict, source_order=source_order)
        if infer_types:
            # The reader sees the CR in the last column, which stays text.
            types = dict(reader.csv(path if isinstance(path, str) else list(path)).dtypes[:-1])
            table = table.withColumns({c: F.col(f"`{c}`").cast(types[c]) for c in table.columns if c in types})
        return table
    if strict:
        reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
    scan = reader.csv(path if isinstance(path, str) else list(path))
    selected = {c: F.col(f"`{c}`") for c in columns or scan.columns}
    if missing == "blank" and not infer_types:
        selected = {n: F.coalesce(c, F.lit("")) for n, c in selected.items()}
    if not source_order:
        return scan.select(*(c.alias(n) for n, c in selected.items()))
    # Rows of one block are read in order by one task.
    within = {"block": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()}
    return with_position(scan, selected, within)
