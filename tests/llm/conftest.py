import os

import duckdb
import pytest

WORDS = "the of and to in a is that it was for on are as with his they at be this".split()


@pytest.fixture(scope="session")
def database(folder):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    return connection


@pytest.fixture(scope="session")
def documents(spark, folder):
    """Ids and texts of the small table."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="session")
def hard(spark):
    """Rows with nulls, blanks, repeats, ties, long texts and columns named like results."""
    long = " ".join(WORDS[i * 7 % 20] + str(i % 997) for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "one"),
        (6, "One two three"),
        (7, long),
        (8, long + " end"),
        (9, f"start {passage} here"),
        (10, f"{passage} there {passage}"),
        (11, "é ünï — çödé " * 20),
        (None, "no key at all"),
        (None, None),
        (12, "twice the same row"),
        (12, "twice the same row"),
        (13, "<|endoftext|>   ﻿ \x00 \x85 end"),
    ]
    rows = [(*r, "x", "src", 0, "y", 1.5, 7, "z") for r in rows]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string"
    return spark.createDataFrame(rows, names + ", score double, predicted int, component_id string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame(
        [], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
