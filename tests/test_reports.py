"""The ten queries on small job tables, read from Parquet and CSV files."""

import json

import pytest
from pyspark.sql import functions as F

from laborscope.operators import (
    array_mean,
    count_by,
    count_equal,
    first_rows,
    join_null_safe,
    labelled_ranking,
    lookup,
    mean_by,
    mean_length_by,
    mean_list_size,
    ranking,
    top_k,
    top_tokens,
    unique_values,
)
from laborscope.plans import QUERIES, JobDataset, labelled_postings, run_query, skills_by_type

SKILLS = [
    ("a", "Python, SQL"),
    ("b", "SQL, SQL"),
    ("c", None),
    ("d", "  "),
    ("a", "IGNORAR"),
    ("e", "Go, , Rust"),
    ("f", "C++,Python"),
]
COMPANIES = [
    ("a", "A"), ("b", "B"), ("c", "A"), ("d", None),
    ("e", " "), ("f", "A"), ("z", "A"), ("a", "IGNORAR"),
]
LEVELS = [
    ("a", "Senior"), ("a", "Otro"), ("b", "Senior"), ("c", " Senior "),
    ("d", " "), ("e", None), ("e", "Junior"),
]


def write_parts(df, path, parts):
    """Write rows in order into numbered files."""
    size = -(-max(df.count(), 1) // parts)
    for i in range(parts):
        rows = df.filter((F.col("n") >= i * size) & (F.col("n") < (i + 1) * size))
        rows.orderBy("n").drop("n").coalesce(1).write.mode("append").parquet(f"{path}/part{i}")
    return [f"{path}/part{i}" for i in range(parts)]


@pytest.fixture
def jobs(spark, text_table, tmp_path):
    kinds = ["Remote", "remote", "Onsite", "Remote", None, "Remote", "Remote", "Remote"]
    countries = ["P", "P", "Q", "Q", "R", "", " ", "S"]
    postings = [
        (link, f"title {i}", company, countries[i], LEVELS[i][1] if i < len(LEVELS) else "x", kinds[i])
        for i, (link, company) in enumerate(COMPANIES)
    ]
    columns = ["job_link", "job_title", "company", "search_country", "job_level", "job_type"]
    summary = [("a", "á😀"), ("a", "abcd"), ("b", "123456789"), ("b", " "), ("b", ""), ("", "x"), ("q", "x"), ("a", None)]
    tables = {
        "postings": text_table(columns, postings),
        "skills": text_table(["job_link", "job_skills"], SKILLS),
        "summary": text_table(["job_link", "job_summary"], summary),
    }
    for name, df in tables.items():
        df.orderBy("n").drop("n").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    return JobDataset(spark, str(tmp_path))


def test_reports(jobs, values):
    got = {n: values(QUERIES[n](jobs).result) for n in QUERIES}
    assert got[1] == [(8, 7, 1)]
    assert got[2] == [
        ("job_link", 0, 0, 0, 0),
        ("job_title", 0, 0, 0, 0),
        ("company", 1, 1, 0, 0),
        ("search_country", 0, 2, 0, 0),
        ("job_level", 1, 1, 0, 0),
        ("job_type", 1, 0, 0, 0),
    ]
    assert got[3] == [(7, 9)]
    assert got[4] == [(4,)]
    assert got[5] == got[9] == [("A", 4), ("B", 1)]
    assert got[6] == [("P", 2), ("Q", 2), ("R", 1)]
    assert got[7] == [("Otro", 2, 5.0), ("Senior", 2, 3.0)]
    assert got[8] == [("SQL", 3), ("C++,Python", 1), ("Go", 1), ("Python", 1), ("Rust", 1)]
    assert got[10] == [(7, 4, 1.14)]


def test_result_columns(jobs):
    names = {n: QUERIES[n](jobs).result.dtypes for n in QUERIES}
    assert names[1] == [(c, "bigint") for c in ("filas_originales", "filas_sin_duplicados", "duplicados_eliminados")]
    assert [c for c, _ in names[2]] == [
        "columna", "nulos_antes", "vacios_antes", "nulos_despues", "filas_sin_job_link_descartadas",
    ]
    assert names[3] == [("filas", "bigint"), ("habilidades_totales", "bigint")]
    assert names[4] == [("ofertas_remotas", "bigint")]
    assert names[5] == names[9] == [("company", "string"), ("ofertas", "bigint")]
    assert names[6] == [("search_country", "string"), ("ofertas", "bigint")]
    assert names[7] == [("job_level", "string"), ("descripciones", "bigint"), ("promedio_caracteres", "double")]
    assert names[8] == [("habilidad", "string"), ("apariciones", "bigint")]
    assert names[10] == [
        ("ofertas", "bigint"), ("ofertas_con_habilidades", "bigint"),
        ("promedio_habilidades_por_oferta", "double"),
    ]


def test_samples(jobs, values):
    assert values(QUERIES[1](jobs).sample(2)) == [("a", "title 0", "A"), ("b", "title 1", "B")]
    assert values(QUERIES[3](jobs).sample(3)) == [("a", ["Python", "SQL"]), ("b", ["SQL", "SQL"]), ("c", [])]
    assert values(QUERIES[4](jobs).sample(), "job_link") == [("a",), ("d",), ("f",), ("z",)]
    assert QUERIES[5](jobs).sample() is None


def test_variants(jobs, values):
    labelled = labelled_postings(jobs)
    assert labelled.count() == 7
    assert ("d", "Not Specified") in values(labelled, "job_link", "company")
    # Every skills row of a link counts, and an absent text has no items.
    by_type = dict(values(skills_by_type(jobs)))
    assert by_type == {"Remote": 1.25, "remote": 2.0, "Onsite": 0.0, None: 3.0}


def test_written_results(jobs, tmp_path, capsys):
    out = f"{tmp_path}/out"
    for number in (3, 4, 9):
        assert run_query(number, jobs, out) > 0
    read = jobs.spark.read.option("header", True).csv
    assert [tuple(r) for r in read(f"{out}/consulta9").collect()] == [("A", "4"), ("B", "1")]
    assert read(f"{out}/consulta4_muestra").columns == ["job_link", "job_title", "company", "job_type"]
    sample = jobs.spark.read.text(f"{out}/consulta3_muestra").collect()
    assert len(sample) == 1
    assert json.loads(sample[0][0])[:2] == [
        {"job_link": "a", "habilidades": ["Python", "SQL"]},
        {"job_link": "b", "habilidades": ["SQL", "SQL"]},
    ]
    assert "rows: 2" in capsys.readouterr().out


def test_csv_and_parquet_agree(jobs, spark, tmp_path, values):
    from laborscope.sources import write_csv

    out = f"{tmp_path}/csv"
    for name in ("postings", "skills", "summary"):
        table = spark.read.parquet(f"{tmp_path}/{name}").na.fill("")
        write_csv(table.coalesce(1), f"{out}/{name}.csv")
    csv = JobDataset(spark, out, "postings.csv", "skills.csv", "summary.csv")
    for n in (1, 3, 4, 5, 6, 7, 8, 9, 10):
        assert values(QUERIES[n](csv).result) == values(QUERIES[n](jobs).result), n


def test_postings_deduplicated_once(jobs, spark, tmp_path, values):
    once = jobs.with_unique_postings(f"{tmp_path}/unique")
    for n in QUERIES:
        assert values(QUERIES[n](once).result) == values(QUERIES[n](jobs).result), n
    for n in (1, 4):
        assert values(QUERIES[n](once).sample()) == values(QUERIES[n](jobs).sample())
    text = QUERIES[4](once).result._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(job_type,Remote)" in text and "Window" not in text


def test_source_order_spans_files(spark, text_table, tmp_path, values):
    from laborscope.sources import SOURCE_ORDER, read_parquet

    paths = write_parts(text_table(["job_link", "job_skills"], SKILLS), str(tmp_path), 3)
    for order in (paths, paths[::-1]):
        rows = read_parquet(spark, order, source_order=True)
        top = top_tokens(rows, "job_link", "job_skills", SOURCE_ORDER)
        assert values(top)[0] == ("SQL", 3)
        assert ("IGNORAR", 1) not in values(top)


def test_mean_length_rules(text_table, spark, values):
    lengths = [("a", 2), ("a", 4), ("b", 9), ("c", 7), ("d", 5), ("e", 5), ("sin_oferta", 3)]
    texts = text_table(["job_link", "t"], [(k, "x" * n) for k, n in lengths])
    levels = text_table(["job_link", "level"], LEVELS)
    got = mean_length_by(texts, levels, "job_link", "t", "level", "n")
    assert values(got) == [(" Senior ", 1, 7.0), ("Senior", 3, 5.0)]
    nobody = texts.filter("job_link = 'sin_oferta'")
    assert values(mean_length_by(nobody, levels, "job_link", "t", "level", "n")) == []


def test_top_is_global(text_table, values):
    rows = [
        (p, ", ".join([f"{p}{i:02}" for i in range(21)] * 3 + ["Ganadora"] * 2)) for p in ("A", "B")
    ]
    top = values(top_tokens(text_table(["k", "t"], rows), "k", "t", "n"))
    assert top == [("Ganadora", 4)] + [(f"A{i:02}", 3) for i in range(19)]


def test_unicode_tokens(text_table, values):
    texts = [None, "", "  ", "á, 😀", "\x1cSQL\x1f, \u2003Python\u3000", "SQL, SQL", "a,b"]
    table = text_table(["k", "t"], [(str(i), t) for i, t in enumerate(texts)])
    assert values(top_tokens(table, "k", "t", "n")) == [
        ("SQL", 3), ("Python", 1), ("a,b", 1), ("á", 1), ("😀", 1),
    ]


def test_empty_inputs(text_table, values):
    postings, skills = text_table(["k"], []), text_table(["k", "t"], [])
    assert values(top_tokens(skills, "k", "t", "n")) == []
    assert values(mean_list_size(postings, skills, "k", "t", "n")) == [(0, 0, None)]
    assert values(mean_list_size(text_table(["k"], [("a",)]), skills, "k", "t", "n")) == [(1, 0, 0.0)]


def test_null_keys_match_in_mean_list_size(text_table, values):
    postings = text_table(["k"], [(None,), ("",), ("0",), (None,)])
    skills = text_table(["k", "t"], [(None, "a, b, c"), ("", "a"), (None, "a")])
    assert values(mean_list_size(postings, skills, "k", "t", "n")) == [(3, 2, 1.33)]


def test_ranking_has_no_limit_and_ties_by_value(text_table, values):
    table = text_table(["k", "c"], [(str(i), f"C{i:02}") for i in range(25)])
    assert [r[0] for r in values(ranking(table, "c"))] == [f"C{i:02}" for i in range(25)]
    assert [r[0] for r in values(top_k(table, "c", 10))] == [f"C{i:02}" for i in range(10)]


def test_counts(text_table, values):
    table = text_table(["k", "c"], [("a", "x"), ("b", "x"), (None, "x"), ("d", None)])
    assert dict(values(count_by(table, "c", of="k"))) == {"x": 2, None: 1}
    assert values(count_equal(table, "c", "X")) == [(0,)]
    assert values(first_rows(table, "n", 2), "k") == [("a",), ("b",)]
    assert values(unique_values(table, "c", "k", "n").orderBy("k")) == [("a",), ("d",)]


def test_joins(text_table, spark, values):
    left = text_table(["k", "a"], [("x", "1"), (None, "2"), ("y", "3")]).drop("n")
    right = text_table(["k", "b"], [("x", "p"), (None, "q")]).drop("n")
    assert sorted(values(join_null_safe(left, right, "k"), "a", "b")) == [("1", "p"), ("2", "q")]
    filled = lookup(left, right, "k", {"b": "-"})
    assert sorted(values(filled, "a", "b")) == [("1", "p"), ("2", "-"), ("3", "-")]
    names = text_table(["k", "label"], [("x", "same"), ("y", "same")]).drop("n")
    assert values(labelled_ranking(left, names, "k", "label")) == [("same", 2)]


def test_means(spark, values):
    arrays = spark.createDataFrame([([1.0, 2.0],), ([],), (None,), ([6.0],)], "x array<double>")
    assert values(array_mean(arrays, "x")) == [(3, 3.0)]
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "g string, v int")
    assert dict(values(mean_by(table, "g", "v"))) == {"a": 1.5, "b": None}
