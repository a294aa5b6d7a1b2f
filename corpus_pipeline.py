"""From raw documents to packed training sequences, stage by stage.

Every stage works on all rows that the one before kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import ship, table
from laborscope.llm.decontamination import mark_contamination
from laborscope.llm.jaccard_join import similar_components
from laborscope.llm.packing import packed_digests, tokenizer_path
from laborscope.llm.quality import quality_model, remainder, score_quality
from laborscope.llm.secret_scan import redact_secrets
from laborscope.sources.storage import work_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels' documents."""
    ship(spark)
    # The same labels as for the query: the held-out rows are never learnt from.
    model = quality_model(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) == 2)
    return score_quality(docs.select(*COLUMNS), model).filter("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Five words a shingle, a similarity of 0.8 or more. Rows that repeat an id and
    documents without id all stay.
    """
    ship(spark)
    found = similar_components(docs, shingle=5, percent=80)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    ship(spark)
    marked = mark_contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return marked.filter("NOT contaminated").select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    ship(spark)
    clean = redact_secrets(docs.select(*COLUMNS))
    # The length follows the text; without text it stays as it was.
    length = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences."""
    ship(spark)
    return packed_digests(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: Classifier, decoding and tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
