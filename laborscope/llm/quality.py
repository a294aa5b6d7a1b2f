"""Quality classifier: logistic regression on hashed word n-grams.

Features are hashes of one and two consecutive words and of one to three
consecutive word shapes (letter case, digits, other characters, a repeat of the
word before), in a table of ``2 ** BITS`` places. A text is a sparse vector of
counts scaled to length one, whatever its length. Training follows the
regularised leader (FTRL-proximal) over a bounded sample of labelled rows; the
weights, of fixed size, go to all tasks, where a score is a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import annotate, query, table
from laborscope.llm.words import NOT_SPACE, Words, mixed, slices, words

BITS = 20
#: At most so many labelled texts of each class are learnt from.
SAMPLE_PER_CLASS = 2500
EPOCHS = 4
THRESHOLD = 0.7

# Kinds of bytes in a word's shape: lower case, upper case, digit, high byte, comma or stop, other.
_ALL = np.arange(256)
_KIND = np.select(
    [
        (_ALL >= 0x61) & (_ALL <= 0x7A),
        (_ALL >= 0x41) & (_ALL <= 0x5A),
        (_ALL >= 0x30) & (_ALL <= 0x39),
        _ALL >= 0x80,
        np.isin(_ALL, [0x2C, 0x2E]),
    ],
    [1, 2, 4, 8, 16],
    32,
).astype(np.uint8)


def _shapes(w: Words) -> np.ndarray:
    """Kinds of bytes in each word, its first kind, and whether it repeats the word before."""
    if not len(w.hashes):
        return np.empty(0, dtype=np.uint64)
    bounds = np.column_stack([w.starts, w.ends]).ravel()
    seen = np.bitwise_or.reduceat(np.append(_KIND[w.buffer], np.uint8(0)), bounds)[::2]
    repeat = np.zeros(len(w.hashes), dtype=np.uint64)
    repeat[1:] = w.hashes[1:] == w.hashes[:-1]
    repeat[w.first[:-1][w.counts > 0]] = 0
    first = _KIND[w.buffer[w.starts]].astype(np.uint64)
    return seen.astype(np.uint64) | (first << np.uint64(8)) | (repeat << np.uint64(16))


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of the non-zero features of each text; rows have length one."""
    w = words(texts, NOT_SPACE)
    row, shape, n = w.rows(), _shapes(w), len(w.hashes)
    found_row, found_hash = [], []
    for kind, base, sizes in ((1, w.hashes, (1, 2)), (2, shape, (1, 2, 3))):
        for size in sizes:
            whole = n - size + 1
            if whole <= 0:
                continue
            gram = np.full(whole, kind * 8 + size, dtype=np.uint64)
            for i in range(size):
                gram = mixed(gram * np.uint64(0x9E3779B97F4A7C15) + base[i : i + whole])
            same = row[:whole] == row[size - 1 :]
            found_row.append(row[:whole][same])
            found_hash.append(gram[same])
    if not found_row:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    key = np.concatenate(found_row) << bits
    key |= (np.concatenate(found_hash) >> np.uint64(64 - bits)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    at, place = key >> bits, key & ((1 << bits) - 1)
    value = np.sqrt(count)
    length = np.sqrt(np.bincount(at, count, minlength=len(texts)))
    return at, place, value / length[at]


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    bits: int = BITS,
    epochs: int = EPOCHS,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.01,
    l2: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Weights and bias after following the regularised leader over the rows, in their order."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias = n_bias = 0.0

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) > l1, w, 0.0)

    for _ in range(epochs):
        for place, value, label in rows:
            w = weights(z[place], n[place])
            p = 1 / (1 + np.exp(-np.clip(w @ value + bias, -35, 35)))
            g = (p - label) * value
            sigma = (np.sqrt(n[place] + g * g) - np.sqrt(n[place])) / alpha
            z[place] += g - sigma * w
            n[place] += g * g
            n_bias += (p - label) ** 2
            bias -= alpha * (p - label) / (beta + np.sqrt(n_bias))
    return weights(z, n).astype(np.float32), float(bias)


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``."""
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % of


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int,
    *,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, text, label`` for at most ``per_class`` labelled rows of each class.

    Chosen by a hash of the key, so alike on every run and at every size. Rows
    without key or label are left out; repeated keys count once, with their
    smallest label and text.
    """
    known = (
        labels.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    parts = [known.filter(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    # At most twice per_class pairs of numbers: small whatever the input.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    source = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    found = source.join(chosen, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train_quality(sample: DataFrame, bits: int = BITS) -> tuple[np.ndarray, float]:
    """Fit the bounded sample in one task; without both classes the score is the prior."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part, texts in slices(batches):
            at, place, value = features(texts, bits)
            bounds = np.searchsorted(at, np.arange(len(texts) + 1))
            ids, label = part.column("doc_id").to_pylist(), part.column("label").to_pylist()
            for i in range(len(texts)):
                own = slice(bounds[i], bounds[i + 1])
                rows.append((ids[i], place[own], value[own].astype(np.float32), label[i]))
        # An order that mixes the classes and doesn't depend on the partitions.
        order = mixed(np.array([r[0] for r in rows], dtype=np.int64).astype(np.uint64))
        rows = [rows[i][1:] for i in np.argsort(order, kind="stable")]
        # Both classes weigh the same: the rarer one is repeated.
        by_class = [[r for r in rows if r[2] == c] for c in (0, 1)]
        most = max(map(len, by_class))
        even = [x for i in range(most) for own in by_class if own for x in [own[i % len(own)]]]
        weights, bias = train_ftrl(even, bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([bias], pa.float64())],
            names=["weights", "bias"],
        )

    found = sample.repartition(1).mapInArrow(run, "weights binary, bias double").collect()
    if not found:
        return np.zeros(1 << bits, dtype=np.float32), 0.0
    return np.frombuffer(found[0]["weights"], dtype=np.float32), found[0]["bias"]


def score_quality(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    *,
    text: str = "text",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``score`` (0 to 1, higher is better) and ``predicted`` to every row.

    A null or empty text has no features and gets the score of the bias alone.
    Repeated rows get equal scores; columns named like the new ones are replaced.
    """
    weights, bias = model
    bits = int(len(weights)).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def prepare() -> Callable[[list[bytes]], list]:
        known = shared.value

        def compute(texts: list[bytes]) -> list:
            at, place, value = features(texts, bits)
            total = np.bincount(at, known[place] * value, minlength=len(texts)) + bias
            score = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

        return compute

    return annotate(docs, text, "score double, predicted int", prepare, keep)


def quality_model(docs: DataFrame, labels: DataFrame, held: Column) -> tuple[np.ndarray, float]:
    """Learn from labelled rows for which ``held`` is false.

    The classes weigh the same in training; the bias then gets the odds they
    have among all rows that may be learnt from.
    """
    usable = labels.filter(~held)
    weights, bias = train_quality(labelled_sample(docs, usable, "quality", SAMPLE_PER_CLASS))
    good, bad = usable.agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    return weights, bias + float(np.log((good + 1) / (bad + 1)))


@query()
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held = remainder("doc_id", 4) == 2
    model = quality_model(docs, table(spark, folder, "labels"), held)
    scored = score_quality(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
