"""Stupid-backoff language model scores, with the whole corpus as the model.

The score of a word after its context is its n-gram's count over the context's
count; an n-gram below the cutoff falls back to the shorter context, at a factor.
Texts are dealt to batches of about ``BATCH_BYTES``. Each batch explodes its
texts to n-grams, counts them, and sends every distinct one to the partition of
its hash, which holds that part of the count tables. The counts come back to
the batch, where they are joined to its n-grams and summed per text. The texts
are shuffled once, compressed, and both steps read that shuffle. Hashes travel in
order, as the steps from one to the next.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.llm.rules import _packed
from laborscope.llm.words import Words, mixed, randoms, shingles, words

ORDER = 3
CUTOFF = 2
FACTOR = 0.4
BATCH_BYTES = 1 << 23
#: Bytes of text per partition of the count tables.
TABLE_BYTES = 1 << 22


def _ngrams(w: Words, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length: the hash of the n-gram ending at each word, and where it is whole."""
    out = []
    for n, seed in zip(range(1, order + 1), randoms(order, 31)):
        hashes, whole = shingles(w, n)
        shift = n - 1
        ending = np.zeros_like(hashes)
        inside = np.zeros(len(hashes), dtype=bool)
        ending[shift:] = mixed(hashes[: len(hashes) - shift] ^ seed)
        inside[shift:] = whole[: len(hashes) - shift]
        out.append((ending, inside))
    return out


def _distinct(grams: list[tuple[np.ndarray, np.ndarray]], starts: np.ndarray, **also) -> tuple[np.ndarray, ...]:
    """Distinct hashes in order, what :func:`numpy.unique` returns ``also``, and where each part begins."""
    hashes, other = np.unique(np.concatenate([h[ok] for h, ok in grams]), **also)
    return hashes, other, np.append(np.searchsorted(hashes, starts), len(hashes))


@functools.cache
def _zstandard() -> tuple:
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress, zstandard.ZstdDecompressor().decompress


def _texts(part: pa.Table) -> list[bytes]:
    unpack = _zstandard()[1]
    return [unpack(x) for x in part.column("text").to_pylist()]


def _small(values: np.ndarray) -> bytes:
    return _zstandard()[0](values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes())


def _values(packed: bytes, count: int) -> np.ndarray:
    raw = _zstandard()[1](packed)
    return np.frombuffer(raw, dtype=f"u{len(raw) // max(1, count) or 1}").astype(np.int64)


#: Low bytes of the steps between sorted hashes, which don't compress; the others are small.
_RAW = 5


def _steps(hashes: np.ndarray, start: np.uint64) -> bytes:
    """Sorted hashes of a part as steps from one to the next, byte by byte."""
    steps = np.diff(hashes, prepend=start).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return planes[:_RAW].tobytes() + _zstandard()[0](planes[_RAW:].tobytes())


def _unstepped(packed: bytes, count: int, start: np.uint64) -> np.ndarray:
    planes = np.empty((8, count), dtype=np.uint8)
    planes[:_RAW] = np.frombuffer(packed, np.uint8, _RAW * count).reshape(_RAW, count)
    planes[_RAW:] = np.frombuffer(_zstandard()[1](packed[_RAW * count :]), np.uint8).reshape(8 - _RAW, count)
    steps = np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)
    return np.cumsum(steps, dtype=np.uint64) + start


def backoff_scores(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    cutoff: int = CUTOFF,
    factor: float = FACTOR,
    batch_bytes: int = BATCH_BYTES,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """``doc_id, n_words, n_backoff, score_micro`` per row.

    ``score_micro`` is the sum over all words of the natural logarithm of their
    score, in millionths and rounded per word, so the sum is exact.
    ``n_backoff`` counts words scored by a shorter context than there was.
    Words are runs without ASCII white space. A null or empty text has no words
    and score 0; repeated rows count each, and a null key stays null.
    """
    source = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches, parts = int(size // batch_bytes) + 1, int(size // table_bytes) + 1
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    dealt = _packed(source.withColumn("batch", batch)).repartition(batches, "batch")
    # A part of the count tables is a range of hashes, so sorted hashes are sorted by part.
    starts = np.array([(i << 64) // parts for i in range(parts)], dtype=np.uint64)
    key_type = dict(source.dtypes)["doc_id"]

    def explode(own: pa.Table) -> pa.Table:
        hashes, count, first = _distinct(_ngrams(words(_texts(own)), order), starts, return_counts=True)
        at = np.flatnonzero(np.diff(first))
        return pa.table(
            {
                "batch": pa.array([own.column("batch")[0].as_py()] * len(at), pa.int32()),
                "part": pa.array(at, pa.int32()),
                "n": pa.array(np.diff(first)[at], pa.int32()),
                "hashes": pa.array([_steps(hashes[first[i] : first[i + 1]], starts[i]) for i in at], pa.binary()),
                "counts": pa.array([_small(count[first[i] : first[i + 1]]) for i in at], pa.binary()),
            }
        )

    def tables(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, gathered = None, []
        for batch in rows:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1] != current and gathered:
                    yield answer(gathered)
                    gathered = []
                current = row[1]
                gathered.append(row)
        if gathered:
            yield answer(gathered)

    def answer(gathered: list[tuple]) -> pa.RecordBatch:
        hashes = [_unstepped(r[3], r[2], starts[r[1]]) for r in gathered]
        counts = [_values(r[4], r[2]) for r in gathered]
        known, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), minlength=len(known)).astype(np.int64)[at]
        cut = np.split(total, np.cumsum([len(h) for h in hashes])[:-1])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in gathered], pa.int32()),
                pa.array([r[1] for r in gathered], pa.int32()),
                pa.array([_small(c) for c in cut], pa.binary()),
            ],
            names=["batch", "part", "totals"],
        )

    total_words = source.sparkSession.sparkContext.broadcast(_count_words(source))

    def score(own: pa.Table, answers: pa.Table) -> pa.Table:
        w = words(_texts(own))
        grams = _ngrams(w, order)
        hashes, place, first = _distinct(grams, starts, return_inverse=True)
        total = np.zeros(len(hashes), dtype=np.int64)
        for part, packed in zip(answers.column("part").to_pylist(), answers.column("totals").to_pylist()):
            a, b = first[part], first[part + 1]
            total[a:b] = _values(packed, b - a)
        counts, begin = [], 0
        for h, ok in grams:
            found, end = np.zeros(len(h), dtype=np.int64), begin + np.count_nonzero(ok)
            found[ok] = total[place[begin:end]]
            counts.append(found)
            begin = end
        # The best length for each word, tried from the longest on.
        value = np.zeros(len(w.hashes))
        backed = np.zeros(len(w.hashes), dtype=np.int64)
        open_word = np.ones(len(w.hashes), dtype=bool)
        steps = np.zeros(len(w.hashes))
        for n in range(order, 1, -1):
            whole = grams[n - 1][1]
            hit = open_word & whole & (counts[n - 1] >= cutoff)
            context = np.zeros(len(w.hashes), dtype=np.int64)
            context[1:] = counts[n - 2][:-1]
            value[hit] = np.log(factor ** steps[hit] * counts[n - 1][hit] / context[hit])
            open_word &= ~hit
            missed = open_word & whole
            steps[missed] += 1
            backed[missed] = 1
        value[open_word] = np.log(factor ** steps[open_word] * counts[0][open_word] / total_words.value)
        micro = np.concatenate([[0], np.cumsum(np.rint(value * 1e6).astype(np.int64))])
        back = np.concatenate([[0], np.cumsum(backed)])
        return pa.table(
            {
                "doc_id": own.column("doc_id"),
                "n_words": pa.array(w.counts, pa.int64()),
                "n_backoff": pa.array(back[w.first[1:]] - back[w.first[:-1]], pa.int64()),
                "score_micro": pa.array(micro[w.first[1:]] - micro[w.first[:-1]], pa.int64()),
            }
        )

    exploded = dealt.groupBy("batch").applyInArrow(explode, "batch int, part int, n int, hashes binary, counts binary")
    answers = (
        exploded.repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(tables, "batch int, part int, totals binary")
    )
    fields = f"doc_id {key_type}, n_words bigint, n_backoff bigint, score_micro bigint"
    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, fields)


def _count_words(source: DataFrame) -> int:
    """Words of all texts."""
    ends = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    return source.agg(F.sum(ends)).first()[0] or 0


_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, w[p] AS word, CASE WHEN p > 1 THEN w[p - 1] END AS prev, CASE WHEN p > 2 THEN w[p - 2] END AS prev2
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
one AS (SELECT word, count(*) AS n FROM t GROUP BY word),
two AS (SELECT prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY prev, word),
three AS (SELECT prev2, prev, word, count(*) AS n FROM t WHERE prev2 IS NOT NULL GROUP BY prev2, prev, word),
total AS (SELECT count(*) AS n FROM t),
s AS (SELECT doc_id, (t.prev2 IS NOT NULL AND three.n < 2) OR (t.prev2 IS NULL AND t.prev IS NOT NULL AND two.n < 2) AS backed,
        CASE WHEN three.n >= 2 THEN ln(three.n / before2.n)
             WHEN two.n >= 2 THEN ln(CASE WHEN t.prev2 IS NULL THEN 1 ELSE 0.4::DOUBLE END * two.n / before.n)
             WHEN t.prev2 IS NOT NULL THEN ln(0.4::DOUBLE * 0.4::DOUBLE * one.n / total.n)
             WHEN t.prev IS NOT NULL THEN ln(0.4::DOUBLE * one.n / total.n)
             ELSE ln(one.n / total.n) END AS v
      FROM t JOIN one ON one.word = t.word CROSS JOIN total
      LEFT JOIN two ON two.word = t.word AND two.prev = t.prev
      LEFT JOIN three ON three.word = t.word AND three.prev = t.prev AND three.prev2 = t.prev2
      LEFT JOIN one AS before ON before.word = t.prev
      LEFT JOIN two AS before2 ON before2.word = t.prev AND before2.prev = t.prev2)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_backoff, 0) AS n_backoff,
       coalesce(score_micro, 0) AS score_micro
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (backed) AS n_backoff,
                         CAST(sum(CAST(round(v * 1e6) AS BIGINT)) AS BIGINT) AS score_micro
                  FROM s GROUP BY doc_id) x USING (doc_id)"""


@query(_SQL)
def op9_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return backoff_scores(table(spark, folder, "documents"))
