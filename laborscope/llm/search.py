"""Ranked lexical search over an index in strata of equal length.

A term's impact in a text depends only on its count there and on the text's length
normaliser. Texts are therefore grouped by equal normaliser: in a stratum, the
impact is computed once for each count, and the largest count of a term bounds what
the term can add to any score. For a query the strata are visited in order of the
sum of these bounds, and those that can't reach the scores already found are left out.

Only the terms of the queries are indexed; their counts and the lengths of all texts
come from one scan. The strata, in order of the normaliser, are cut into parts of about
``PART_PAIRS`` postings: short strata share a part, and one that holds many texts is
split by a hash. Each part gives its best texts for every query, and Spark merges them.

Queries are taken in blocks of a bounded number of terms, so what is broadcast has a
fixed bound; every further block is a further scan. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.llm.words import ALPHANUMERIC, slices, words

BEST = 50
#: Postings per part of the index; a text counts as ``TEXT_PAIRS`` more.
PART_PAIRS = 4_000_000
TEXT_PAIRS = 16
#: Terms of the queries in a block, each counted once per query.
BLOCK_TERMS = 2_000_000

# Fixed values of the score, all integers.
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
COUNT_FACTOR = 1000
LENGTH_FACTOR = 20
#: The normaliser is ``FLAT`` plus ``STEEP`` times the length over the mean length.
FLAT, STEEP = 50, 50


def query_terms(items: DataFrame, text: str) -> DataFrame:
    """``items`` without the text, with ``_terms``: the distinct hashes of its terms."""
    kept = [c for c in items.columns if c != text]
    chosen = items.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("_text"))
    types = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "_text"):
            w = words(texts, ALPHANUMERIC, lower=True)
            own = [np.unique(w.hashes[a:b]).view(np.int64) for a, b in zip(w.first, w.first[1:])]
            found = pa.array([x.tolist() for x in own], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), found], names=[*kept, "_terms"])

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "`_terms` array<bigint>"])
    return chosen.mapInArrow(run, schema)


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of numbers as little-endian data."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(bounds) - 1,
        [None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(values.tobytes())],
    ).cast(pa.binary())


def postings(docs: DataFrame, key: str, text: str, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, counts`` per row.

    ``n`` counts the text's terms with repeats; ``terms`` are the places in the sorted
    ``vocabulary`` of those it has, and ``counts`` their occurrences, both as 32-bit numbers.
    """
    chosen = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part, texts in slices(batches):
            w = words(texts, ALPHANUMERIC, lower=True)
            at = np.searchsorted(known, w.hashes)
            at[at == len(known)] = 0
            held = known[at] == w.hashes if len(known) else np.zeros(len(at), dtype=bool)
            pairs, count = np.unique((w.rows()[held] << 32) | at[held], return_counts=True)
            bounds = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(w.counts, pa.int64()),
                    _packed((pairs & 0xFFFFFFFF).astype("<u4"), bounds),
                    _packed(np.minimum(count, 0xFFFFFFFF).astype("<u4"), bounds),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    kind = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(run, f"doc_id {kind}, n bigint, terms binary, counts binary")


def document_counts(index: DataFrame, size: int) -> np.ndarray:
    """Texts that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for x in batch.column("terms").to_pylist():
                # A text has a term once.
                total[np.frombuffer(x, "<u4")] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    found = index.select("terms").mapInArrow(run, "term bigint, n bigint")
    counted = found.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(size, dtype=np.int64)
    total[counted["term"].to_numpy()] = counted["n"].to_numpy()
    return total


#: Normalisers are dealt singly up to this one, and above it in classes of 1 / 64 of a doubling.
_SINGLE = 4096


def length_class(m: Column) -> Column:
    """A number for equal or, if large, similar normalisers, in their order; below 8,192."""
    rest = F.floor(64 * F.log2(F.greatest(m, F.lit(_SINGLE)) / F.lit(_SINGLE)))
    return F.when(m < _SINGLE, m).otherwise(F.lit(_SINGLE) + rest).cast("int")


def dealt(index: DataFrame, size: int) -> DataFrame:
    """``index`` with its ``part``: strata in order, one that holds a lot cut by a hash of the key."""
    held = F.octet_length("terms") / 4 + TEXT_PAIRS
    classes = index.groupBy("class").agg(F.sum(held).cast("bigint").alias("held")).collect()
    amount = [0] * (max((r["class"] for r in classes), default=0) + 1)
    for r in classes:
        amount[r["class"]] = r["held"]
    before = [0, *accumulate(amount)]
    own = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def of_class(values: list[int]) -> Column:
        return F.get(F.from_json(F.lit(json.dumps(values)), "array<bigint>"), F.col("class"))

    part = F.floor((of_class(before) + own * of_class(amount)) / F.lit(size)).cast("int")
    parts = before[-1] // size + 1
    return index.withColumn("part", part).drop("class").repartition(parts, "part")


class Stratified:
    """The postings of one part, by term, stratum and count."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, row: np.ndarray, m: np.ndarray, size: int):
        self.rows = len(m)
        self.strata, stratum = np.unique(m, return_inverse=True)
        self.held = np.bincount(stratum, minlength=len(self.strata))
        order = np.lexsort((counts, stratum[row], terms))
        self.row, counts = row[order], counts[order]
        self.stratum = stratum[self.row]
        terms = terms[order]
        # One impact for each stratum and count.
        pairs, at = np.unique((self.stratum << 32) | counts, return_inverse=True)
        tf, length = pairs & 0xFFFFFFFF, self.strata[pairs >> 32]
        self.impact = (IMPACT_SCALE * tf // (COUNT_FACTOR * tf + LENGTH_FACTOR * length))[at]
        self.first = np.searchsorted(terms, np.arange(size + 1))
        # The last posting of a term in a stratum has its largest count, and so the bound.
        ends = (terms[1:] != terms[:-1]) | (self.stratum[1:] != self.stratum[:-1])
        last = np.flatnonzero(np.append(ends, True)[: len(terms)])
        self.most, self.of = self.impact[last], self.stratum[last]
        self.begin = np.searchsorted(last, self.first)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores above 0 of the ``k`` best texts, the best first, ties by row."""
        bound = np.zeros(len(self.strata), dtype=np.int64)
        for t, w in zip(terms, weights):
            a, b = self.begin[t], self.begin[t + 1]
            bound[self.of[a:b]] += w * self.most[a:b]
        order = np.argsort(-bound, kind="stable")
        enough = np.searchsorted(np.cumsum(self.held[order]), max(4 * k, self.rows // 8)) + 1
        scores = np.zeros(self.rows, dtype=np.int64)
        open_ = np.zeros(len(self.strata), dtype=bool)
        open_[order[:enough]] = bound[order[:enough]] > 0
        self._visit(terms, weights, open_, scores)
        if enough < len(order):
            least = np.partition(scores, self.rows - k)[self.rows - k] if self.rows > k else 0
            # A bound equal to the least score may still win by its key.
            rest = np.zeros(len(self.strata), dtype=bool)
            rest[order[enough:]] = bound[order[enough:]] >= max(1, least)
            if rest.any():
                self._visit(terms, weights, rest, scores)
        found = np.flatnonzero(scores)
        if len(found) > k:
            least = np.partition(scores[found], len(found) - k)[len(found) - k]
            found = found[scores[found] >= least]
        found = found[np.lexsort((found, -scores[found]))][:k]
        return found, scores[found]

    def _visit(self, terms: np.ndarray, weights: np.ndarray, strata: np.ndarray, scores: np.ndarray) -> None:
        every = strata.all()
        for t, w in zip(terms, weights):
            a, b = self.first[t], self.first[t + 1]
            row, impact = self.row[a:b], self.impact[a:b]
            if not every:
                inside = strata[self.stratum[a:b]]
                row, impact = row[inside], impact[inside]
            scores[row] += w * impact


def _search(docs: DataFrame, items: DataFrame, key: str, text: str, k: int, part_pairs: int) -> DataFrame:
    """``_number, doc_id, score`` of the best texts in each part; ``items`` has ``_number, _terms``."""
    found = items.select("_number", "_terms").collect()
    hashes = [np.array(r["_terms"], dtype=np.int64).view(np.uint64) for r in found]
    vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]))
    index = postings(docs, key, text, vocabulary).checkpoint()
    total = index.agg(F.count_if(F.col("n") > 0).alias("texts"), F.sum("n").alias("terms")).first()
    texts, terms = total["texts"], total["terms"] or 1
    holders = document_counts(index, len(vocabulary))
    weight = np.array(
        [math.floor(WEIGHT_SCALE * math.log((2 * texts + 2) / (2 * int(d) + 1))) for d in holders], dtype=np.int64
    )
    queries = []
    for r, own in zip(found, hashes):
        at = np.searchsorted(vocabulary, own)
        at = at[weight[at] > 0]
        queries.append((r["_number"], at, weight[at]))
    shared = docs.sparkSession.sparkContext.broadcast(queries)
    m = F.expr(f"{FLAT} + ({STEEP} * n * {texts}L) div {terms}L")
    strata = index.filter(F.octet_length("terms") > 0).withColumn("m", m).withColumn("class", length_class(F.col("m")))
    kind = dict(index.dtypes)["doc_id"]

    def best(part: pa.Table) -> pa.Table:
        # Ties go by key, nulls first, as in Spark.
        part = part.take(pc.sort_indices(part, sort_keys=[("doc_id", "ascending")], null_placement="at_start"))
        runs = [np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4").astype(np.int64) for c in ("terms", "counts")]
        lengths = pc.binary_length(part.column("terms")).to_numpy() // 4
        row = np.repeat(np.arange(len(lengths)), lengths)
        strata = Stratified(*runs, row, part.column("m").to_numpy(), len(vocabulary))
        numbers, rows, scores = [], [], []
        for number, own, weights in shared.value:
            at, score = strata.best(own, weights, k)
            numbers.append(np.full(len(at), number))
            rows.append(at)
            scores.append(score)
        rows = np.concatenate([np.empty(0, np.int64), *rows])
        return pa.table(
            {
                "_number": pa.array(np.concatenate([np.empty(0, np.int64), *numbers])),
                "doc_id": part.column("doc_id").take(pa.array(rows)),
                "score": pa.array(np.concatenate([np.empty(0, np.int64), *scores])),
            }
        )

    parts = dealt(strata.select("doc_id", "n", "terms", "counts", "m", "class"), part_pairs)
    return parts.groupBy("part").applyInArrow(best, f"_number bigint, doc_id {kind}, score bigint")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = BEST,
    part_pairs: int = PART_PAIRS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best texts of all ``docs`` for each row of ``items``.

    Scores are above 0; equal ones go by ascending key, a null key first. A null or empty
    text has no terms: it is never found, and as an item it finds nothing. Every row counts,
    also a repeated one, and repeated items are answered each. Other columns don't matter.
    """
    chosen = items.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{item_text}`").alias("_text"))
    queries = query_terms(chosen, "_text").withColumn("_number", F.monotonically_increasing_id()).checkpoint()
    size = queries.agg(F.sum(F.size("_terms"))).first()[0] or 0
    blocks = size // block_terms + 1
    in_order = Window.partitionBy("_number").orderBy(F.desc("score"), "doc_id")
    answers = []
    for i in range(blocks):
        own = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("_number"), F.lit(blocks)) == i)
        found = _search(docs, own, key, text, k, part_pairs).withColumn("rank", F.row_number().over(in_order))
        answers.append(found.filter(F.col("rank") <= k).join(own.select("_number", "item_id"), "_number"))
    every = functools.reduce(DataFrame.unionAll, answers)
    return every.select("item_id", "rank", "doc_id", "score")


_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
c AS (SELECT count(*) AS texts, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
m AS (SELECT doc_id, 50 + (50 * len(w)::BIGINT * texts) // terms AS m FROM d, c WHERE len(w) > 0),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
v AS (SELECT term, floor(1000 * ln((2 * texts + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM t, c GROUP BY term, texts),
s AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN v USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""


@query(_SQL)
def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
