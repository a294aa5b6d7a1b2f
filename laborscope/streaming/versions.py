"""A table that micro-batches add to, merged when it is read.

Every batch writes one folder, ``batch=N``, anew if it is repeated, so it counts once.
When the batches have grown as large as what was merged before, they are merged with it
into ``upto=N``, and what that replaces is dropped. A merge thus handles at most twice
what came since the last one: over all batches the work follows the rows that came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from laborscope.sources import storage

#: Batches that are merged together, at least.
FOLD_BATCHES = 8

Merge = Callable[[DataFrame], DataFrame]


def latest_per_key(keys: Sequence[str]) -> Merge:
    """The row of the latest batch for each key."""

    def merge(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in (*keys, "batch")]
        newest = F.max_by(F.struct(*(F.col(f"`{c}`") for c in others)), "batch").alias("_row")
        return rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(newest).select(
            *(F.col(f"`{k}`") for k in keys), *(F.col(f"_row.`{c}`").alias(c) for c in others)
        )

    return merge


def summed_per_key(keys: Sequence[str]) -> Merge:
    """The sums of all other columns for each key."""

    def merge(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in (*keys, "batch")]
        return rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(*(F.sum(f"`{c}`").alias(c) for c in others))

    return merge


class Versions:
    """The table in ``folder``; ``merge`` takes its rows with their ``batch`` and must not mind their order."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, merge: Merge | None = None):
        self.spark, self.folder, self.schema, self.merge = spark, folder, schema, merge

    def save(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")
        if self.merge is not None:
            self._fold()

    def _parts(self) -> tuple[tuple[int, int], dict[int, int]]:
        """Number and bytes of the newest merged part (-1 and 0 if none), and of each later batch."""
        merged, batches = {-1: 0}, {}
        for name in storage.children(self.spark, self.folder):
            kind, _, number = name.partition("=")
            # What a job that died has left has no marker.
            if kind in ("upto", "batch") and storage.exists(self.spark, f"{self.folder}/{name}/{storage.SUCCESS_MARKER}"):
                size = storage.total_bytes(self.spark, f"{self.folder}/{name}")
                (merged if kind == "upto" else batches)[int(number)] = size
        newest = max(merged)
        return (newest, merged[newest]), {n: b for n, b in batches.items() if n > newest}

    def _rows(self, newest: int, batches: Sequence[int]) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField("batch", IntegerType())])
        rows = self.spark.createDataFrame([], whole)
        if newest >= 0:
            merged = self.spark.read.schema(self.schema).parquet(f"{self.folder}/upto={newest}")
            rows = merged.withColumn("batch", F.lit(newest))
        if batches:
            paths = [f"{self.folder}/batch={n}" for n in batches]
            later = self.spark.read.schema(whole).option("basePath", self.folder).parquet(*paths)
            rows = later if newest < 0 else rows.unionByName(later)
        return rows

    def _fold(self) -> None:
        (newest, held), batches = self._parts()
        if len(batches) < FOLD_BATCHES or sum(batches.values()) < held:
            return
        upto = max(batches)
        self.merge(self._rows(newest, list(batches))).write.mode("overwrite").parquet(f"{self.folder}/upto={upto}")
        for n in batches:
            storage.delete(self.spark, f"{self.folder}/batch={n}")
        if newest >= 0:
            storage.delete(self.spark, f"{self.folder}/upto={newest}")

    def read(self) -> DataFrame:
        """All rows so far, merged. Read again after further batches: they drop what they replace."""
        (newest, _), batches = self._parts()
        rows = self._rows(newest, list(batches))
        return (rows.drop("batch") if self.merge is None else self.merge(rows)).select(
            *(F.col(f"`{c}`") for c in self.schema.names)
        )
