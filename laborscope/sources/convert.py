"""Conversion of CSV to Parquet parts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laborscope.sources import storage
from laborscope.sources.csv_text import read_csv_text
from laborscope.sources.files import PART_GLOB
from laborscope.sources.large_csv import read_large_csv

# Fixed values
ROWS_PER_PART = 20_000


def write_parts(
    df: DataFrame, target: str, rows_per_part: int = ROWS_PER_PART, *, marked: bool = True
) -> int:
    """Write a new Parquet folder of bounded parts and return the number of rows.

    ``marked=False`` leaves the completion marker to the caller.
    """
    if rows_per_part < 1:
        raise ValueError("rows_per_part must be at least 1")
    counted = Observation()
    observed = df.observe(counted, F.count("*").alias("rows"))
    writer = observed.write.option("maxRecordsPerFile", rows_per_part)
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", marked)
    writer.mode("errorifexists").parquet(target)
    return counted.get["rows"]


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str] | None = None,
    rows_per_part: int = ROWS_PER_PART,
    *,
    split: bool = False,
) -> tuple[int, int]:
    """Convert a multi-line CSV to Parquet parts; returns ``(parts, rows)``.

    Refuses an existing target and a source without rows. The completion
    marker is written last and records source, parts and rows. Records with
    more or fewer fields than the header are an error. One task reads one file;
    ``split`` reads each with many, which asks for files that follow RFC 4180.
    """
    if rows_per_part < 1:
        raise ValueError("rows_per_part must be at least 1")
    if storage.exists(spark, target):
        raise FileExistsError(f"{target} already exists")
    if read_csv_text(spark, source, columns, multiline=True).isEmpty():
        raise ValueError(f"{source} has no data rows")
    if split:
        frame = read_large_csv(spark, source, columns, missing="blank")
    else:
        frame = read_csv_text(spark, source, columns, multiline=True, missing="blank", strict=True)
    rows = write_parts(frame, target, rows_per_part, marked=False)
    folder = target.rstrip("/")
    parts = storage.matches(spark, f"{folder}/{PART_GLOB}")
    marker = {"origen": source, "partes": parts, "filas": rows}
    storage.write_text(spark, f"{folder}/{storage.SUCCESS_MARKER}", json.dumps(marker))
    return parts, rows
