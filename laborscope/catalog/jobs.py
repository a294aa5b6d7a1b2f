"""The ten job-market queries on postings, skills and summaries derived from the test tables.

Line items stand for postings (repeated per order), documents and conversations
for skills, and documents, conversations and pages for summaries. The tables
are written once per application, the rows of a link sorted in one file, and then
read in source order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.catalog.base import WS, query, table
from laborscope.plans import QUERIES as REPORTS
from laborscope.plans import JobDataset, labelled_postings, skills_by_type
from laborscope.sources import total_bytes, work_folder

POSTING_COLUMNS = ["job_link", "job_title", "company", "search_country", "job_level", "job_type"]

#: Suppliers go to all tasks up to this size of their file.
SUPPLIER_BYTES = 16 * 1024 * 1024

# A posting without a return flag 'A' or 'R' has no company, and some levels
# are null or blank.
POSTINGS_SQL = """(
    SELECT 'job/' || l_orderkey AS job_link,
           'line ' || l_linenumber AS job_title,
           CASE l_returnflag WHEN 'N' THEN NULL ELSE s_name END AS company,
           n_name AS search_country,
           CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '  '
                ELSE o_orderpriority END AS job_level,
           CASE l_returnflag WHEN 'R' THEN 'Remote' WHEN 'A' THEN 'remote' ELSE 'Onsite' END AS job_type,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS place
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) p"""

SKILLS_SQL = """(
    SELECT 'job/' || id AS job_link, text AS job_skills,
           row_number() OVER (PARTITION BY id ORDER BY turn) AS place
    FROM (SELECT doc_id AS id, -1 AS turn, text FROM documents
          UNION ALL SELECT conv_id, turn, text FROM conversations)) s"""

SUMMARY_SQL = """(
    SELECT 'job/' || doc_id AS job_link, text AS job_summary FROM documents
    UNION ALL SELECT 'job/' || conv_id, text FROM conversations
    UNION ALL SELECT 'job/' || page_id, html FROM pages) t"""

FIRST_POSTINGS_SQL = f"(SELECT * FROM {POSTINGS_SQL} WHERE place = 1) f"
FIRST_SKILLS_SQL = f"(SELECT * FROM {SKILLS_SQL} WHERE place = 1) g"


def _link(key: str):
    return F.concat(F.lit("job/"), F.col(key).cast("string")).alias("job_link")


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]
    priority, flag = F.col("o_orderpriority"), F.col("l_returnflag")
    lines = table(spark, folder, "lineitem", *order, "l_returnflag")
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nations = table(spark, folder, "nation", "n_nationkey", "n_name")
    places = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).drop("s_nationkey", "n_nationkey")
    same_place = F.col("l_suppkey") == F.col("s_suppkey")
    # Line items are shuffled once: the join, the order of the lines and their file share this partitioning.
    # Names are added behind it, or before it if there are too many suppliers to broadcast.
    late = total_bytes(spark, f"{folder}/supplier.parquet") <= SUPPLIER_BYTES
    rows = (lines if late else lines.join(places, same_place)).repartition("l_orderkey")
    rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        (rows.join(F.broadcast(places), same_place) if late else rows)
        .sortWithinPartitions(*order)
        .select(
            _link("l_orderkey"),
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("job_title"),
            F.when(flag != "N", F.col("s_name")).alias("company"),
            F.col("n_name").alias("search_country"),
            F.when(priority == "5-LOW", "  ")
            .when(priority != "4-NOT SPECIFIED", priority)
            .alias("job_level"),
            F.when(flag == "R", "Remote")
            .when(flag == "A", "remote")
            .otherwise("Onsite")
            .alias("job_type"),
        )
    )


def _skills(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    rows = documents.select(F.col("doc_id").alias("id"), F.lit(-1).cast("long").alias("turn"), "text")
    both = rows.unionByName(turns.withColumnRenamed("conv_id", "id"))
    return both.orderBy("id", "turn").select(_link("id"), F.col("text").alias("job_skills"))


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    sources = [
        ("documents", "doc_id", "text"),
        ("conversations", "conv_id", "text"),
        ("pages", "page_id", "html"),
    ]
    parts = [
        table(spark, folder, name, key, text).select(_link(key), F.col(text).alias("job_summary"))
        for name, key, text in sources
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark: SparkSession, folder: str, name: str, build) -> str:
    """Write a derived table once per application and return its path."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _WRITTEN:
        target = work_folder(spark, name)
        build(spark, folder).write.parquet(target)
        _WRITTEN[key] = target
    return _WRITTEN[key]


def job_dataset(spark: SparkSession, folder: str, *needed: str) -> JobDataset:
    build = {"postings": _postings, "skills": _skills, "summary": _summary}
    paths = {name: _written(spark, folder, name, build[name]) for name in needed}
    base = next(iter(paths.values())).rsplit("/", 1)[0]
    names = {f"{name}_name": path.rsplit("/", 1)[1] for name, path in paths.items()}
    return JobDataset(spark, base, **names)


@query(f"""
    SELECT count(*) AS filas_originales, count(DISTINCT job_link) AS filas_sin_duplicados,
           count(*) - count(DISTINCT job_link) AS duplicados_eliminados
    FROM {POSTINGS_SQL}""")
def job_q1(spark, folder):
    return REPORTS[1](job_dataset(spark, folder, "postings")).result


@query(f"""
    SELECT job_link, job_title, company FROM {FIRST_POSTINGS_SQL}""")
def job_q1_rows(spark, folder):
    rows = REPORTS[1](job_dataset(spark, folder, "postings")).rows()
    return rows.select("job_link", "job_title", "company")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS columna, count(*) FILTER ({c} IS NULL) AS nulos_antes,"
        f" count(*) FILTER (trim({c}, {WS}) = '') AS vacios_antes, 0::BIGINT AS nulos_despues,"
        f" 0::BIGINT AS filas_sin_job_link_descartadas FROM {POSTINGS_SQL}"
        for c in POSTING_COLUMNS
    )
)
def job_q2(spark, folder):
    return REPORTS[2](job_dataset(spark, folder, "postings")).result


@query(f"""
    SELECT count(DISTINCT job_link) AS rows, 0::BIGINT AS nulls FROM {POSTINGS_SQL}""")
def job_q2_labelled(spark, folder):
    """Which row of a link survives is open, so only rows and nulls are compared."""
    rows = labelled_postings(job_dataset(spark, folder, "postings"))
    return rows.agg(
        F.count("*").alias("rows"), F.count_if(F.col("company").isNull()).alias("nulls")
    )


@query(f"""
    SELECT count(*) AS filas, CAST(sum(len(string_split(job_skills, ', '))) AS BIGINT) AS habilidades_totales
    FROM {SKILLS_SQL}""")
def job_q3(spark, folder):
    return REPORTS[3](job_dataset(spark, folder, "skills")).result


@query(f"SELECT count(*) AS ofertas_remotas FROM {FIRST_POSTINGS_SQL} WHERE job_type = 'Remote'")
def job_q4(spark, folder):
    return REPORTS[4](job_dataset(spark, folder, "postings")).result


@query(f"""
    SELECT company, count(*) AS ofertas FROM {FIRST_POSTINGS_SQL} WHERE trim(company, {WS}) <> ''
    GROUP BY company ORDER BY ofertas DESC, company LIMIT 10""")
def job_q5(spark, folder):
    return REPORTS[5](job_dataset(spark, folder, "postings")).result


@query(f"""
    SELECT search_country, count(*) AS ofertas FROM {FIRST_POSTINGS_SQL}
    GROUP BY search_country ORDER BY ofertas DESC, search_country LIMIT 10""")
def job_q6(spark, folder):
    return REPORTS[6](job_dataset(spark, folder, "postings")).result


@query(f"""
    SELECT job_level, count(*) AS descripciones,
           round(sum(length(job_summary)) / count(*), 2) AS promedio_caracteres
    FROM {SUMMARY_SQL} JOIN {FIRST_POSTINGS_SQL} USING (job_link)
    WHERE job_summary <> '' AND trim(job_level, {WS}) <> ''
    GROUP BY job_level ORDER BY job_level""")
def job_q7(spark, folder):
    return REPORTS[7](job_dataset(spark, folder, "summary", "postings")).result


@query(f"""
    SELECT trim(h, {WS}) AS habilidad, count(*) AS apariciones
    FROM (SELECT unnest(string_split(job_skills, ', ')) AS h FROM {FIRST_SKILLS_SQL})
    WHERE trim(h, {WS}) <> ''
    GROUP BY 1 ORDER BY apariciones DESC, habilidad LIMIT 20""")
def job_q8(spark, folder):
    return REPORTS[8](job_dataset(spark, folder, "skills")).result


@query(f"""
    SELECT company, count(*) AS ofertas FROM {FIRST_POSTINGS_SQL} WHERE trim(company, {WS}) <> ''
    GROUP BY company ORDER BY ofertas DESC, company""")
def job_q9(spark, folder):
    return REPORTS[9](job_dataset(spark, folder, "postings")).result


@query(f"""
    SELECT count(*) AS ofertas, count(*) FILTER (n > 0) AS ofertas_con_habilidades,
           round(sum(n) / count(*), 2) AS promedio_habilidades_por_oferta
    FROM (SELECT coalesce(len(string_split(job_skills, ', ')), 0) AS n
          FROM {FIRST_POSTINGS_SQL} LEFT JOIN {FIRST_SKILLS_SQL} USING (job_link))""")
def job_q10(spark, folder):
    return REPORTS[10](job_dataset(spark, folder, "postings", "skills")).result


@query(f"""
    SELECT job_type, avg(len(string_split(job_skills, ','))) AS "avg(num_skills)"
    FROM {FIRST_POSTINGS_SQL} JOIN {SKILLS_SQL} USING (job_link) GROUP BY job_type""")
def job_q10_by_type(spark, folder):
    return skills_by_type(job_dataset(spark, folder, "postings", "skills"))
