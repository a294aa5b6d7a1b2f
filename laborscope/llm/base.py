"""Registration of the queries of this subpackage, and what they share."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborscope.llm.words import slices
from laborscope.sources.storage import work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


@functools.cache
def _ship(application: str) -> str:
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="laborscope-"), "laborscope")
    return shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))


def ship(spark: SparkSession) -> None:
    """Send the package's code to the executors, once per application.

    Also gives a session on one machine a checkpoint folder if it has none.
    """
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        context.setCheckpointDir(work_folder(spark, "checkpoint"))
    if not any("laborscope" in f for f in context.listFiles):
        context.addPyFile(_ship(context.applicationId))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its name, with its SQL if SQL can express it."""

    def add(function: Query) -> Query:
        @functools.wraps(function)
        def shipped(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return function(spark, folder)

        QUERIES[function.__name__] = shipped
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def annotate(
    df: DataFrame,
    text: str,
    fields: str,
    prepare: Callable[[], Callable[[list[bytes]], list]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns computed from the whole text of each row, inside its task.

    ``prepare()`` runs once per task and gives a function from texts (a missing
    one is empty) to one Arrow array per field. Columns of ``df`` named in
    ``keep`` stay (default: all); one with the name of a new field is replaced.
    """
    new = T._parse_datatype_string(fields).fieldNames()
    taken = {n.lower() for n in new}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    # The text travels under a name no other column has.
    source = next(n for n in (f"_text{i}" for i in range(len(kept) + 2)) if n not in kept)
    chosen = df.select(
        *(F.col(f"`{c}`") for c in kept if c != text), F.col(f"`{text}`").cast("string").alias(source)
    )
    out = [F.col(f"`{source}`").alias(text) if c == text else F.col(f"`{c}`") for c in kept]
    types = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    carried = [c for c in chosen.columns if c != source or text in kept]
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carried), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = prepare()
        for part, texts in slices(batches, source):
            columns = [part.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*columns, *compute(texts)], names=[*carried, *new])

    return chosen.mapInArrow(run, schema).select(*out, *(F.col(f"`{n}`") for n in new))
