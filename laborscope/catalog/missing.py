"""The reports on postings and skills without links, companies or skills.

Some line items stand for postings with a null or blank link or company, and some
conversation turns for skills rows with a null or blank link or text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.catalog.base import WS, query, table
from laborscope.catalog.jobs import _written
from laborscope.functions import MISSING_LABEL
from laborscope.plans import QUERIES as REPORTS
from laborscope.plans import JobDataset

_BY = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]

POSTINGS_SQL = f"""(
    SELECT *, row_number() OVER (PARTITION BY job_link ORDER BY {", ".join(_BY)}) AS place
    FROM (SELECT {", ".join(_BY)},
                 CASE l_linenumber WHEN 3 THEN NULL WHEN 4 THEN '  ' ELSE 'job/' || l_orderkey END AS job_link,
                 CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN chr(9) WHEN 5 THEN '' ELSE 'company ' || l_suppkey END AS company
          FROM lineitem)) p"""
SKILLS_SQL = """(
    SELECT *, row_number() OVER (PARTITION BY job_link ORDER BY conv_id, turn) AS place
    FROM (SELECT conv_id, turn, CASE WHEN turn = 2 THEN NULL WHEN turn = 3 THEN ' ' ELSE 'job/' || conv_id END AS job_link,
                 CASE WHEN conv_id % 5 = 0 THEN NULL WHEN conv_id % 5 = 1 THEN '  ' WHEN conv_id % 5 = 2 THEN ''
                      ELSE text END AS job_skills
          FROM conversations)) s"""


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_linenumber")
    link = F.when(number == 4, "  ").when(number != 3, F.concat(F.lit("job/"), F.col("l_orderkey").cast("string")))
    name = F.concat(F.lit("company "), F.col("l_suppkey").cast("string"))
    company = F.when(number == 2, "\t").when(number == 5, "").when(number != 1, name)
    lines = table(spark, folder, "lineitem", *_BY).orderBy(*_BY)
    return lines.select(link.alias("job_link"), company.alias("company"))


def _skills(spark: SparkSession, folder: str) -> DataFrame:
    turn, rest = F.col("turn"), F.col("conv_id") % 5
    link = F.when(turn == 3, " ").when(turn != 2, F.concat(F.lit("job/"), F.col("conv_id").cast("string")))
    skills = F.when(rest == 1, "  ").when(rest == 2, "").when(rest > 2, F.col("text"))
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text").orderBy("conv_id", "turn")
    return turns.select(link.alias("job_link"), skills.alias("job_skills"))


def _dataset(spark: SparkSession, folder: str) -> JobDataset:
    postings = _written(spark, folder, "postings-with-gaps", _postings)
    skills = _written(spark, folder, "skills-with-gaps", _skills)
    base, name = postings.rsplit("/", 1)
    return JobDataset(spark, base, postings_name=name, skills_name=skills.rsplit("/", 1)[1])


@query(f"""
    SELECT count(*) AS filas_originales, count(*) FILTER (place = 1) AS filas_sin_duplicados,
           count(*) FILTER (place > 1) AS duplicados_eliminados
    FROM {POSTINGS_SQL}""")
def job_q1_missing(spark, folder):
    """A null link is one key, apart from blank ones."""
    return REPORTS[1](_dataset(spark, folder)).result


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS columna, count(*) FILTER ({c} IS NULL) AS nulos_antes,
            count(*) FILTER (trim({c}, {WS}) = '') AS vacios_antes,
            count(*) FILTER (trim(job_link, {WS}) <> '' AND {after} IS NULL) AS nulos_despues,
            count(*) FILTER (job_link IS NULL OR trim(job_link, {WS}) = '') AS filas_sin_job_link_descartadas
            FROM {POSTINGS_SQL}"""
        for c, after in (
            ("job_link", "job_link"),
            ("company", f"CASE WHEN trim(company, {WS}) <> '' THEN company ELSE '{MISSING_LABEL}' END"),
        )
    )
)
def job_q2_missing(spark, folder):
    return REPORTS[2](_dataset(spark, folder)).result


@query(f"""
    SELECT count(*) AS filas, CAST(sum(CASE WHEN trim(job_skills, {WS}) <> '' THEN len(string_split(job_skills, ', ')) ELSE 0 END)
                                   AS BIGINT) AS habilidades_totales
    FROM {SKILLS_SQL}""")
def job_q3_missing(spark, folder):
    return REPORTS[3](_dataset(spark, folder)).result


@query(f"""
    SELECT company, count(*) AS ofertas FROM {POSTINGS_SQL} WHERE place = 1 AND trim(company, {WS}) <> ''
    GROUP BY company ORDER BY ofertas DESC, company LIMIT 10""")
def job_q5_missing(spark, folder):
    """Companies are left out after the deduplication, not before."""
    return REPORTS[5](_dataset(spark, folder)).result


@query(f"""
    SELECT trim(h, {WS}) AS habilidad, count(*) AS apariciones
    FROM (SELECT unnest(string_split(job_skills, ', ')) AS h FROM {SKILLS_SQL} WHERE place = 1)
    WHERE trim(h, {WS}) <> ''
    GROUP BY 1 ORDER BY apariciones DESC, habilidad LIMIT 20""")
def job_q8_missing(spark, folder):
    return REPORTS[8](_dataset(spark, folder)).result


@query(f"""
    SELECT count(*) AS ofertas, count(*) FILTER (n > 0) AS ofertas_con_habilidades,
           round(sum(n) / count(*), 2) AS promedio_habilidades_por_oferta
    FROM (SELECT CASE WHEN trim(s.job_skills, {WS}) <> '' THEN len(string_split(s.job_skills, ', ')) ELSE 0 END AS n
          FROM {POSTINGS_SQL} LEFT JOIN {SKILLS_SQL} ON s.place = 1 AND s.job_link IS NOT DISTINCT FROM p.job_link
          WHERE p.place = 1)""")
def job_q10_missing(spark, folder):
    """A null link has the skills of the null link."""
    return REPORTS[10](_dataset(spark, folder)).result
