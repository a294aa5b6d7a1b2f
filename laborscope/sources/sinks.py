"""Result tables, samples and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from laborscope.operators.dedup import Keys
from laborscope.operators.ranking import first_rows


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Write CSV with a header. ``single_file`` is for bounded results only."""
    if single_file:
        df = df.coalesce(1)
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_sample_csv(
    df: DataFrame, path: str, order: Keys, n: int = 5, drop: Sequence[str] = ()
) -> None:
    """Write the first ``n`` rows as CSV, without the columns in ``drop``."""
    write_csv(first_rows(df, order, n).drop(*drop), path, single_file=True)


def sample_json(df: DataFrame, order: Keys, n: int = 5, drop: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows as one JSON array of objects, in order."""
    rows = first_rows(df, order, n).drop(*drop)
    fields = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    numbered = rows.select(F.struct(F.monotonically_increasing_id(), fields.alias("row")).alias("r"))
    entries = F.transform(F.sort_array(F.collect_list("r")), lambda r: r["row"])
    return numbered.agg(F.to_json(entries, {"ignoreNullFields": "false"}).alias("json"))


def write_sample_json(
    df: DataFrame, path: str, order: Keys, n: int = 5, drop: Sequence[str] = ()
) -> None:
    """Write the first ``n`` rows as a JSON array of objects."""
    sample_json(df, order, n, drop).coalesce(1).write.text(path)


def head_and_count(df: DataFrame, n: int = 20) -> tuple[list[Row], int]:
    """The first ``n`` rows and the number of all, from one run over the input.

    Every task keeps its first ``n`` rows while it counts, so ``n`` rows come to the driver.
    """
    counted = Observation()
    observed = df.observe(counted, F.count("*").alias("rows"))
    at = F.monotonically_increasing_id()
    numbered = observed.select(at.alias("_at"), F.struct("*").alias("_row"))
    first = [r["_row"] for r in numbered.orderBy("_at").limit(n + 1).collect()]
    total = len(first) if len(first) <= n else counted.get["rows"]
    if total == 2 * len(first):
        # Spark knew that there are no more rows and sorted them all, which reads them twice to draw ranges.
        total = df.count()
    return first[:n], total


def preview(df: DataFrame, n: int = 20) -> int:
    """Show the first rows and return the number of rows."""
    first, rows = head_and_count(df, n)
    df.sparkSession.createDataFrame(first, df.schema).show(n, truncate=False)
    print(f"rows: {rows}")
    return rows


def collect_small(df: DataFrame, limit: int = 10_000) -> list[Row]:
    """Collect a bounded result; a larger one is an error, not a truncation."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: write the result instead of collecting it")
    return rows
