"""The ten job-market queries and the benchmark variants of two of them.

Each takes a :class:`JobDataset` and returns a :class:`Report` of lazy
DataFrames. Column names and labels of the results are fixed values.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborscope.functions import has_text, to_list
from laborscope.operators import (
    count_equal,
    dedup_summary,
    first_rows,
    impute_nulls,
    keep_any,
    list_summary,
    mean_length_by,
    mean_list_size,
    mean_list_size_by,
    ranking,
    token_ranking,
    top_k,
    treatment_report,
)
from laborscope.plans.dataset import KEY, JobDataset
from laborscope.sources import (
    SOURCE_ORDER,
    first_rows_in_place,
    preview,
    read_csv_text,
    write_csv,
    write_sample_csv,
    write_sample_json,
)


@dataclass(frozen=True)
class Report:
    """A result table, and for some queries how to get the rows to take a sample from."""

    result: DataFrame
    rows: Callable[[], DataFrame] | None = None
    order: str = SOURCE_ORDER
    bounded: bool = True
    json_sample: bool = False

    def sample(self, n: int = 5) -> DataFrame | None:
        return None if self.rows is None else first_rows(self.rows(), self.order, n).drop(self.order)


def duplicates(data: JobDataset) -> Report:
    """1: rows before and after keeping the first posting per link."""
    result = dedup_summary(
        data.postings(KEY, ordered=False),
        KEY,
        before="filas_originales",
        after="filas_sin_duplicados",
        removed="duplicados_eliminados",
    )
    return Report(result, lambda: data.unique_postings("job_title", "company"))


def missing_values(data: JobDataset) -> Report:
    """2: nulls and blanks per column before and after the treatment."""
    result = treatment_report(
        data.postings(ordered=False),
        KEY,
        column="columna",
        nulls_before="nulos_antes",
        blanks_before="vacios_antes",
        nulls_after="nulos_despues",
        dropped="filas_sin_job_link_descartadas",
    )
    return Report(result)


def skill_lists(data: JobDataset) -> Report:
    """3: skills text as lists; rows and list items."""
    result = list_summary(
        data.skills(ordered=False), "job_skills", rows="filas", items="habilidades_totales"
    )

    def lists() -> DataFrame:
        return data.skills().select(KEY, to_list("job_skills").alias("habilidades"), SOURCE_ORDER)

    return Report(result, lists, json_sample=True)


def remote_postings(data: JobDataset) -> Report:
    """4: distinct postings with one exact job type."""
    wanted = "Remote"
    result = count_equal(data.unique_postings("job_type"), "job_type", wanted, "ofertas_remotas")

    def rows() -> DataFrame:
        detailed = data.unique_postings("job_title", "company", "job_type")
        return detailed.filter(F.col("job_type") == wanted)

    return Report(result, rows)


def _present(data: JobDataset, column: str) -> DataFrame:
    """The column over distinct postings, blanks left out after the deduplication."""
    return data.unique_postings(column).filter(has_text(column)).select(column)


def top_companies(data: JobDataset) -> Report:
    """5: the ten companies with most distinct postings."""
    return Report(top_k(_present(data, "company"), "company", 10, "ofertas"))


def top_countries(data: JobDataset) -> Report:
    """6: the ten countries with most distinct postings."""
    return Report(top_k(_present(data, "search_country"), "search_country", 10, "ofertas"))


def length_by_level(data: JobDataset) -> Report:
    """7: mean description length per job level."""
    result = mean_length_by(
        data.summary(),
        data.unique_postings("job_level") if data.unique_folder else data.postings("job_level"),
        KEY,
        "job_summary",
        "job_level",
        SOURCE_ORDER,
        count="descripciones",
        mean="promedio_caracteres",
    )
    return Report(result)


def top_skills(data: JobDataset) -> Report:
    """8: the twenty most frequent skills."""
    first = first_rows_in_place(data.skills(), KEY, ["job_skills"])
    return Report(token_ranking(first, "job_skills", "habilidad", "apariciones").limit(20))


def company_ranking(data: JobDataset) -> Report:
    """9: all companies by distinct postings."""
    return Report(ranking(_present(data, "company"), "company", "ofertas"), bounded=False)


def skills_per_posting(data: JobDataset) -> Report:
    """10: mean number of skills over all distinct postings."""
    result = mean_list_size(
        data.postings(KEY, ordered=False),
        data.skills(),
        KEY,
        "job_skills",
        SOURCE_ORDER,
        rows="ofertas",
        with_items="ofertas_con_habilidades",
        mean="promedio_habilidades_por_oferta",
    )
    return Report(result)


QUERIES: dict[int, Callable[[JobDataset], Report]] = {
    1: duplicates,
    2: missing_values,
    3: skill_lists,
    4: remote_postings,
    5: top_companies,
    6: top_countries,
    7: length_by_level,
    8: top_skills,
    9: company_ranking,
    10: skills_per_posting,
}


def labelled_postings(data: JobDataset) -> DataFrame:
    """Variant of 2: any row per link, nulls of two columns labelled."""
    unique = keep_any(data.postings(ordered=False), [KEY])
    labelled = [c for c in ("company", "job_location") if c in unique.columns]
    return impute_nulls(unique, labelled)


def skills_by_type(data: JobDataset, separator: str = ",") -> DataFrame:
    """Variant of 10: mean number of skills per job type, matched postings only."""
    return mean_list_size_by(
        data.postings("job_type"),
        data.skills(ordered=False),
        KEY,
        "job_skills",
        "job_type",
        SOURCE_ORDER,
        separator=separator,
        mean="avg(num_skills)",
    )


def run_query(number: int, data: JobDataset, folder: str) -> float:
    """Write result and sample of one query below ``folder``; returns the seconds taken."""
    started = time.perf_counter()
    report = QUERIES[number](data)
    target = f"{folder.rstrip('/')}/consulta{number}"
    write_csv(report.result, target, single_file=report.bounded)
    seconds = time.perf_counter() - started
    if report.rows is not None:
        write_sample = write_sample_json if report.json_sample else write_sample_csv
        write_sample(report.rows(), f"{target}_muestra", report.order, drop=[report.order])
    preview(read_csv_text(data.spark, target, multiline=True))
    return seconds
