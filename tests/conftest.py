import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("laborscope-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def text_table(spark):
    """Build a table of nullable text columns, with its row number as ``n``."""

    def build(columns, rows):
        schema = ", ".join(f"`{c}` string" for c in columns) + ", n int"
        numbered = [(*row, i) for i, row in enumerate(rows)]
        return spark.createDataFrame(numbered, schema)

    return build


@pytest.fixture
def values():
    """Rows of a result as tuples, in order."""

    def collect(df, *columns):
        return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]

    return collect
