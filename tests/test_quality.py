from laborscope.operators import (
    blanks_to_null,
    drop_missing_key,
    impute,
    impute_nulls,
    null_profile,
    treatment_report,
)

COLUMNS = ["job_link", "company", "place"]
ROWS = [
    ("a", "A", None),
    ("a", "", "x"),
    (None, None, "y"),
    (" \u3000", "B", ""),
    ("c", " \t", None),
    ("d", " D ", "z"),
]


def test_profile_counts_nulls_and_blanks(text_table, values):
    profile = null_profile(text_table(COLUMNS, ROWS), COLUMNS)
    assert values(profile) == [("job_link", 1, 1), ("company", 1, 2), ("place", 2, 1)]


def test_report_before_and_after(text_table, values):
    report = treatment_report(text_table(COLUMNS, ROWS).drop("n"), "job_link")
    assert values(report) == [
        ("job_link", 1, 1, 0, 2),
        ("company", 1, 2, 0, 2),
        ("place", 2, 1, 0, 2),
    ]
    assert report.columns == ["column", "nulls_before", "blanks_before", "nulls_after", "rows_dropped"]


def test_report_on_nothing(text_table, values):
    report = treatment_report(text_table(COLUMNS, []).drop("n"), "job_link")
    assert values(report) == [(c, 0, 0, 0, 0) for c in COLUMNS]


def test_impute_keeps_real_values_untrimmed(text_table, values):
    treated = impute(text_table(COLUMNS, ROWS).drop("n"), "job_link")
    label = "No especificado"
    assert values(treated) == [
        ("a", "A", label),
        ("a", label, "x"),
        ("c", label, label),
        ("d", " D ", "z"),
    ]


def test_impute_chosen_columns_and_label(text_table, values):
    treated = impute(text_table(COLUMNS, ROWS).drop("n"), "job_link", "?", ["company"])
    assert values(treated, "company", "place") == [("A", None), ("?", "x"), ("?", None), (" D ", "z")]


def test_impute_nulls_leaves_blanks(text_table, values):
    treated = impute_nulls(text_table(COLUMNS, ROWS), ["company"])
    assert [r[0] for r in values(treated, "company")] == ["A", "", "Not Specified", "B", " \t", " D "]


def test_missing_keys_and_blanks(text_table, values):
    table = text_table(COLUMNS, ROWS)
    assert [r[0] for r in values(drop_missing_key(table, "job_link"), "job_link")] == list("aacd")
    assert values(blanks_to_null(table, ["place"]), "place") == [
        (None,), ("x",), ("y",), (None,), (None,), ("z",),
    ]


def test_column_names_with_dots(spark, values):
    table = spark.createDataFrame([("a", None)], "`k` string, `x y` string")
    assert values(null_profile(table)) == [("k", 0, 0), ("x y", 1, 0)]
