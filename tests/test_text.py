from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from laborscope.functions import (
    WHITESPACE,
    blank_to_null,
    fill_missing,
    has_text,
    is_missing,
    list_count,
    list_size,
    not_empty,
    strip,
    strip_spaces,
    text_digest,
    text_length,
    to_list,
)

TEXTS = [None, "", " ", "Python", "a,b", "a, b", ", ", "a, , b", "a,  b", "a, ", "á, 😀"]
ODD = ["\x1cSQL\x1f", "\u2003Python\u3000", "\t\n", "\x85x\xa0", "\u200bz", "a\u2028", "\ufeff", "  in  side "]

alphabet = st.sampled_from(list("ab, ,.😀á\t\n\x1c\u2003\u3000\u200b") + [", "])
texts = st.lists(st.one_of(st.none(), st.lists(alphabet, max_size=12).map("".join)), min_size=1, max_size=30)
quick = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def evaluate(spark, rows, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def split(text, separator=", "):
    return text.split(separator) if text and text.strip() else []


def test_whitespace_is_what_python_strips():
    assert len(WHITESPACE) == 29
    assert all(c.isspace() for c in WHITESPACE)


def test_list_sizes_of_edge_texts(spark):
    counts = [r[0] for r in evaluate(spark, TEXTS, list_count("t"))]
    assert counts == [0, 0, 0, 1, 1, 2, 2, 3, 2, 2, 2]
    assert counts == [r[0] for r in evaluate(spark, TEXTS, list_size(to_list("t")))]


def test_lists_keep_empty_items(spark):
    assert [r[0] for r in evaluate(spark, TEXTS, to_list("t"))] == [split(t) for t in TEXTS]


@quick
@given(rows=texts)
def test_text_functions_match_python(spark, rows):
    got = evaluate(
        spark,
        rows + ODD,
        strip("t"),
        has_text("t"),
        is_missing("t"),
        not_empty("t"),
        blank_to_null("t"),
        fill_missing("t", "?"),
        to_list("t"),
        list_count("t"),
        text_length("t"),
    )
    for text, row in zip(rows + ODD, got):
        if text is None:
            assert row == (None, None, True, None, None, "?", [], 0, None)
            continue
        filled = text.strip() != ""
        assert row == (
            text.strip(),
            filled,
            not filled,
            text != "",
            text if filled else None,
            text if filled else "?",
            split(text),
            len(split(text)),
            len(text),
        )


@quick
@given(rows=texts, separator=st.sampled_from([",", ", ", "|", ".", "a", "ab", "[x]", "\\", "^", "😀"]))
def test_any_separator_is_literal(spark, rows, separator):
    rows = rows + [None, "a|b.c[x]d\\e^f😀g", separator * 3]
    got = evaluate(spark, rows, to_list("t", separator), list_count("t", separator))
    for text, (items, count) in zip(rows, got):
        assert items == split(text, separator)
        assert count == len(items)


def test_strip_spaces_leaves_other_whitespace(spark):
    assert evaluate(spark, [" \tx\u3000 "], strip_spaces("t")) == [("\tx\u3000",)]


def test_digest_keeps_null_apart_from_empty(spark):
    null, empty = evaluate(spark, [None, ""], text_digest("t"))
    assert null == (None,) and len(empty[0]) == 64


def test_length_counts_code_points(spark):
    assert evaluate(spark, ["á😀", "abcd", "", " "], text_length("t")) == [(2,), (4,), (0,), (1,)]
    assert spark.range(1).select(text_length(F.lit("x"))).schema[0].dataType.simpleString() == "bigint"
