"""Scans of Parquet, and what they share with those of CSV: source order and reader options."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from laborscope.sources import storage

# Fixed values
PART_GLOB = "part*.parquet"

# A text no field holds, so that Spark keeps "" apart from an absent field.
_NO_NULL_TEXT = "\x01no null text\x01"

SOURCE_ORDER = "source_order"

#: The list of files goes to all tasks up to this size.
BROADCAST_BYTES = 64 * 1024 * 1024

# Names that no scanned column should have.
_FILE, _NUMBER, _WITHIN = "_source_file", "_source_number", "_source_within"


def input_files(scan: DataFrame) -> list[str]:
    """Files of a scan in source order: numbers in paths compare as numbers, ties as text."""
    # One string, so that the list costs one call.
    joined = scan.sparkSession._jvm.org.apache.hadoop.util.StringUtils.join("\n", scan._jdf.inputFiles())
    files = [f for f in joined.split("\n") if f]

    def place(path: str) -> list[tuple]:
        # Folder by folder: one name with its numbers, then as it is, before the next.
        names = [(re.split("([0-9]+)", name), name) for name in path.split("/")]
        return [([int(x) if i % 2 else x for i, x in enumerate(parts)], name) for parts, name in names]

    return sorted(files, key=place)


def file_ordinals(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``_source_file, _source_number`` of each file, broadcast up to ``BROADCAST_BYTES`` of paths.

    A path without a host is in it in both spellings, ``file:/a`` and ``file:///a``. A longer
    list is joined as Spark sees fit.
    """
    numbers = {}
    for i, f in enumerate(files):
        numbers[f] = numbers[re.sub("^([^:/]+):///", r"\1:/", f)] = i
    table = spark.createDataFrame(
        pa.table({_FILE: pa.array(numbers.keys(), pa.string()), _NUMBER: pa.array(numbers.values(), pa.int64())})
    )
    return F.broadcast(table) if sum(len(f) + 32 for f in numbers) <= BROADCAST_BYTES else table


def with_position(
    scan: DataFrame, selected: dict[str, Column], within: dict[str, Column], ordinals: DataFrame | None = None
) -> DataFrame:
    """``selected`` columns of a scan and ``source_order``: the file's number, and ``within`` it.

    The numbers are looked up by path, so no path is taken apart or compared per row.
    """
    if ordinals is None:
        ordinals = file_ordinals(scan.sparkSession, input_files(scan))
    placed = scan.select(
        *(c.alias(n) for n, c in selected.items()),
        F.col("_metadata.file_path").alias(_FILE),
        *(c.alias(f"{_WITHIN}_{n}") for n, c in within.items()),
    )
    unknown = F.raise_error(F.lit("a file is not in the list of the scan")).cast("bigint")
    position = F.struct(
        F.coalesce(F.col(_NUMBER), unknown).alias("file"), *(F.col(f"{_WITHIN}_{n}").alias(n) for n in within)
    )
    numbered = placed.join(ordinals, _FILE, "left")
    return numbered.select(*(F.col(f"`{n}`") for n in selected), position.alias(SOURCE_ORDER))


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def csv_reader(
    spark: SparkSession, missing: str, *, multiline: bool = False, infer_types: bool = False
) -> DataFrameReader:
    """A reader for CSV with a header and doubled quotes; see :func:`read_csv_text` for ``missing``."""
    if missing not in ("distinct", "null", "blank"):
        raise ValueError("missing must be 'distinct', 'null' or 'blank'")
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("inferSchema", infer_types)
    )
    if missing != "null":
        reader = reader.option("nullValue", _NO_NULL_TEXT)
    if multiline:
        # Any other separator would change the line breaks inside of fields.
        reader = reader.option("lineSep", "\n")
    return reader


def project(
    scan: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    source_order: bool = False,
    ordinals: DataFrame | None = None,
) -> DataFrame:
    """Columns of a Parquet scan, with the position of the row if wanted.

    ``ordinals`` are the scan's :func:`file_ordinals`, if they are known already.
    """
    selected = {c: F.col(f"`{c}`") for c in columns or scan.columns}
    if not source_order:
        return scan.select(*selected.values())
    return with_position(scan, selected, {"row": F.col("_metadata.row_index")}, ordinals)


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    source_order: bool = False,
) -> DataFrame:
    """Scan Parquet with projection; ``source_order`` adds file and row position."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return project(df, columns, source_order=source_order)


def read_complete_parquet(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    *,
    parts: str = PART_GLOB,
    source_order: bool = False,
) -> DataFrame:
    """Scan a folder only if its writer finished and left part files."""
    folder = path.rstrip("/")
    if not storage.exists(spark, f"{folder}/{storage.SUCCESS_MARKER}"):
        raise FileNotFoundError(f"{path} has no {storage.SUCCESS_MARKER}: it is not complete")
    if not storage.matches(spark, f"{folder}/{parts}"):
        raise FileNotFoundError(f"{path} has no {parts} files")
    df = spark.read.option("pathGlobFilter", parts).parquet(folder)
    return project(df, columns, source_order=source_order)


def per_file(df: DataFrame, **measures) -> DataFrame:
    """Aggregate per source file of a scan, with the row count as ``rows``."""
    extra = [m.alias(name) for name, m in measures.items()]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), *extra
    )
