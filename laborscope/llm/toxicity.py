"""Toxicity by compression distance with two zstandard dictionaries.

A text is a sequence of stems: its words in lower case, whole up to ``LONGEST``
characters and else as overlapping pieces of ``PIECE`` characters through to the end.
So scripts without spaces are read to the end as well; punctuation and spaces of any
script end a word. Each stem is written as a code of ``CODE`` random bytes, so that it
compresses well only if a dictionary has exactly this stem.

There is a dictionary for each class, made by one rule: the stems that its own texts have
and that are rare in the other's, after the frequent stems of all texts, which are the same
in both. Windows of ``WINDOW`` stems are compressed with both. The bytes that the toxic
dictionary saves against the ordinary one, in windows in which it saves a calibrated
number or more, give the score.

The dictionaries are trained on a bounded sample of labelled rows; the threshold
and the score on each half of it, with the dictionaries of the other half. All
have a fixed size.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import annotate, query, table
from laborscope.llm.quality import labelled_sample, remainder
from laborscope.llm.words import LETTERS, mixed, slices, words

LONGEST = 12
PIECE = 4
CODE = 16
WINDOW = 8
LEVEL = 1
#: At most so many labelled texts of each class are learnt from.
SAMPLE_PER_CLASS = 2000
#: Frequent stems of all texts, and stems of one class, in a dictionary.
COMMON_STEMS = 2000
CLASS_STEMS = 1000
#: A stem of a class is in this share of its texts, and so many times as often as in the other's.
LEAST_SHARE = 0.005
TIMES = 10
THRESHOLD = 0.7


@functools.cache
def _separators() -> dict[int, str]:
    """Characters outside ASCII that are not part of a word (spaces, punctuation, symbols), each to a space."""
    return {c: " " for c in range(0x80, 0x110000) if unicodedata.category(chr(c))[0] in "ZPS"}


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    saved: int
    weights: tuple[float, float, float]


def stems(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Stem hashes of all texts one after another, and where each text begins."""
    table = _separators()
    spaced = [x if x.isascii() else x.decode(errors="replace").translate(table).encode() for x in texts]
    w = words(spaced, LETTERS, lower=True)
    # Where the characters of each word begin.
    heads = np.flatnonzero((w.buffer & 0xC0) != 0x80)
    low, high = np.searchsorted(heads, w.starts), np.searchsorted(heads, w.ends)
    long = high - low > LONGEST
    if not long.any():
        return w.hashes, w.first
    count = np.where(long, high - low - PIECE + 1, 1)
    word = np.repeat(np.arange(len(count)), count)
    begin = np.cumsum(count) - count
    hashes = w.hashes[word]
    piece = np.flatnonzero(long[word])
    at = low[word[piece]] + piece - begin[word[piece]]
    # A character is at most four bytes; together with its neighbours it makes a piece.
    ends = np.append(heads, len(w.buffer))
    value = np.zeros(len(heads), dtype=np.uint64)
    for i in range(4):
        place = np.minimum(heads + i, len(w.buffer) - 1)
        inside = heads + i < ends[1:]
        value = np.where(inside, (value << np.uint64(8)) | w.buffer[place], value)
    total = np.zeros(len(piece), dtype=np.uint64)
    for i in range(PIECE):
        total = mixed(total + value[at + i] + np.uint64(i + 1))
    hashes[piece] = total
    return hashes, np.concatenate([[0], np.cumsum(count)])[w.first]


def codes(hashes: np.ndarray) -> bytes:
    return np.column_stack([mixed(hashes + np.uint64(i)) for i in range(CODE // 8)]).tobytes()


class Distance:
    """Bytes that the toxic dictionary saves, per window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(
                dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
            )

        self.pair = (compressor(ordinary), compressor(toxic)) if ordinary and toxic else None

    def saved(self, hashes: np.ndarray) -> np.ndarray:
        if not self.pair or not len(hashes):
            return np.zeros(0, dtype=np.int64)
        packed, step = codes(hashes), CODE * WINDOW
        plain, other = (c.compress for c in self.pair)
        parts = [packed[i : i + step] for i in range(0, len(packed), step)]
        return np.array([len(plain(x)) - len(other(x)) for x in parts], dtype=np.int64)


def evidence(saved: np.ndarray, count: int, least: int) -> tuple[float, float]:
    """Codes saved in windows with at least ``least`` bytes saved, and their share of all stems."""
    hits = float(saved[saved >= least].sum()) / CODE
    return float(np.log1p(hits)), float(np.sqrt(hits / max(1, count)))


def _dictionaries(texts: list[bytes], toxic: np.ndarray) -> tuple[bytes, bytes]:
    """Codes of the stems for ordinary and for toxic texts, the most frequent last, where they cost least."""
    hashes, first = stems(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    # Texts of each class that have a stem.
    both = np.unique(np.column_stack([hashes, row.astype(np.uint64)]), axis=0)
    known, number = np.unique(both[:, 0], return_inverse=True)
    of_class = toxic[both[:, 1].astype(np.int64)].astype(np.int64)
    held = [np.bincount(number[of_class == c], minlength=len(known)) for c in (0, 1)]
    texts_of = [int((toxic == c).sum()) for c in (0, 1)]
    typical = []
    for own, other in ((0, 1), (1, 0)):
        found = (held[own] >= np.maximum(3, LEAST_SHARE * texts_of[own])) & (
            (held[own] + 0.5) * (texts_of[other] + 1) >= TIMES * (held[other] + 0.5) * (texts_of[own] + 1)
        )
        typical.append(found)
    # Both classes weigh the same.
    share = sum(h / max(1, t) for h, t in zip(held, texts_of))
    shared = np.flatnonzero(~typical[0] & ~typical[1])
    common = known[shared[np.lexsort((known[shared], -share[shared]))][:COMMON_STEMS]][::-1]
    out = []
    for own in (0, 1):
        at = np.flatnonzero(typical[own])
        at = at[np.lexsort((known[at], -held[own][at]))][:CLASS_STEMS]
        out.append(codes(np.concatenate([common, known[at][::-1]])))
    return out[0], out[1]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    # Both classes weigh the same.
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        slope = x.T @ (share * (p - y)) + ridge * weights
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights -= np.linalg.solve(curve, slope)
    return weights


def fit(texts: list[bytes], toxic: np.ndarray) -> ToxicityModel:
    """Dictionaries from all rows; threshold and weights from rows scored by the other half's."""
    saved, counts, label = [], [], []
    for half in (0, 1):
        distance = Distance(*_dictionaries(texts[half::2], toxic[half::2]))
        hashes, first = stems(texts[1 - half :: 2])
        saved += [distance.saved(hashes[a:b]) for a, b in zip(first, first[1:])]
        counts += np.diff(first).tolist()
        label += toxic[1 - half :: 2].astype(int).tolist()
    label = np.array(label)
    best = None
    for least in range(1, CODE * 2):
        x = np.array([evidence(s, n, least) for s, n in zip(saved, counts)]).reshape(-1, 2)
        weights = _logistic(x, label)
        z = x @ weights[:2] + weights[2]
        # Mean log loss per class.
        loss = np.log1p(np.exp(-np.clip(np.where(label == 1, z, -z), -35, 35)))
        total = sum(loss[label == c].mean() for c in (0, 1) if (label == c).any())
        if best is None or total < best[0]:
            best = (total, least, weights)
    return ToxicityModel(*_dictionaries(texts, toxic), best[1], tuple(float(v) for v in best[2]))


def train_toxicity(sample: DataFrame) -> ToxicityModel:
    """Fit the bounded sample in one task; without both classes every score is low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part, texts in slices(batches):
            rows += zip(part.column("doc_id").to_pylist(), part.column("label").to_pylist(), texts)
        if len({r[1] for r in rows}) < 2 or len(rows) < 8:
            return
        order = np.argsort(mixed(np.array([r[0] for r in rows], dtype=np.int64).astype(np.uint64)))
        # One class after the other, so that both halves have both.
        rows = sorted((rows[i] for i in order), key=lambda r: r[1])
        model = fit([r[2] for r in rows], np.array([r[1] == 1 for r in rows]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([model.ordinary], pa.binary()),
                pa.array([model.toxic], pa.binary()),
                pa.array([model.saved], pa.int64()),
                pa.array([list(model.weights)], pa.list_(pa.float64())),
            ],
            names=["ordinary", "toxic", "saved", "weights"],
        )

    fields = "ordinary binary, toxic binary, saved bigint, weights array<double>"
    found = sample.repartition(1).mapInArrow(run, fields).collect()
    if not found:
        return ToxicityModel(b"", b"", 1, (0.0, 0.0, -2.0))
    x = found[0]
    return ToxicityModel(bytes(x["ordinary"]), bytes(x["toxic"]), x["saved"], tuple(x["weights"]))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    *,
    text: str = "text",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``score`` (0 to 1, higher is more toxic) and ``predicted`` to every row.

    A null or empty text has no windows and gets the score of no evidence.
    Repeated rows get equal scores; columns named like the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare() -> Callable[[list[bytes]], list]:
        known = shared.value
        distance = Distance(known.ordinary, known.toxic)
        a, b, c = known.weights

        def compute(texts: list[bytes]) -> list:
            hashes, first = stems(texts)
            x = np.array(
                [evidence(distance.saved(hashes[i:j]), j - i, known.saved) for i, j in zip(first, first[1:])]
            ).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(x @ np.array([a, b]) + c, -35, 35)))
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

        return compute

    return annotate(docs, text, "score double, predicted int", prepare, keep)


def toxicity_model(docs: DataFrame, labels: DataFrame, held: Column) -> ToxicityModel:
    """Learn from labelled rows for which ``held`` is false; both classes weigh the same."""
    return train_toxicity(labelled_sample(docs, labels.filter(~held), "toxic", SAMPLE_PER_CLASS))


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held = remainder("doc_id", 3) == 1
    model = toxicity_model(docs, table(spark, folder, "labels"), held)
    scored = score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
