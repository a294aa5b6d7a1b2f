"""Where the three job-market tables are and how they are read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from laborscope.operators import keep_first
from laborscope.sources import (
    SOURCE_ORDER,
    project,
    read_complete_parquet,
    read_csv_text,
)
from laborscope.sources.files import file_ordinals, input_files

KEY = "job_link"


@dataclass(frozen=True)
class JobDataset:
    """Tables below one folder or URI; names ending in ``.csv`` are read as CSV.

    ``prepared_summary`` names a converted Parquet folder for the long texts,
    which is read only when its conversion finished. ``unique_folder`` names
    postings that :meth:`with_unique_postings` deduplicated before.

    Parquet files are listed once per dataset object; make a new one to see new files.
    """

    spark: SparkSession
    folder: str
    postings_name: str = "postings"
    skills_name: str = "skills"
    summary_name: str = "summary"
    prepared_summary: str | None = None
    unique_folder: str | None = None
    _scans: dict[str, DataFrame] = field(default_factory=dict, init=False, repr=False, compare=False)
    _ordinals: dict[str, DataFrame] = field(default_factory=dict, init=False, repr=False, compare=False)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(self, name: str, columns: Sequence[str] | None = None, ordered: bool = False) -> DataFrame:
        if name.endswith(".csv"):
            return read_csv_text(
                self.spark,
                self.path(name),
                columns,
                multiline=True,
                missing="blank",
                strict=True,
                source_order=ordered,
            )
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(self.path(name))
        scan = self._scans[name]
        if ordered and name not in self._ordinals:
            self._ordinals[name] = file_ordinals(self.spark, input_files(scan))
        return project(scan, columns, source_order=ordered, ordinals=self._ordinals.get(name))

    def postings(self, *columns: str, ordered: bool = True) -> DataFrame:
        """All columns, or the key and the given ones."""
        wanted = list(dict.fromkeys([KEY, *columns])) if columns else None
        return self.read(self.postings_name, wanted, ordered)

    def unique_postings(self, *columns: str) -> DataFrame:
        """The first posting per link, with the key, the given columns and the source order."""
        if self.unique_folder is None:
            return keep_first(self.postings(*columns), KEY, SOURCE_ORDER)
        if self.unique_folder not in self._scans:
            scan = read_complete_parquet(self.spark, self.unique_folder)
            self._scans[self.unique_folder] = scan
        scan = self._scans[self.unique_folder]
        return scan.select(*dict.fromkeys([KEY, *columns, SOURCE_ORDER])) if columns else scan

    def with_unique_postings(self, folder: str) -> JobDataset:
        """Deduplicate the postings once, into ``folder``, for all reports that follow."""
        keep_first(self.postings(), KEY, SOURCE_ORDER).write.parquet(folder)
        return replace(self, unique_folder=folder)

    def skills(self, ordered: bool = True) -> DataFrame:
        return self.read(self.skills_name, [KEY, "job_skills"], ordered)

    def summary(self) -> DataFrame:
        columns = [KEY, "job_summary"]
        if self.prepared_summary:
            return read_complete_parquet(self.spark, self.prepared_summary, columns, parts="part*.parquet")
        if self.summary_name.endswith(".csv"):
            return self.read(self.summary_name, columns)
        return self.read(self.summary_name, columns)
