"""Words of whole texts as numpy arrays, for use inside tasks.

Spark hands a task Arrow batches; :func:`slices` cuts them into runs of rows of
about ``SLICE_BYTES`` of text, so memory is bounded by that or by the longest
single text. A word is a maximal run of bytes of a class; its 64-bit hash is a
sum of fixed random numbers per byte and place, mixed at the end.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_UPPER = np.arange(256)
#: Bytes that are not one of the six ASCII white-space characters.
NOT_SPACE = ~np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
#: ASCII digits and lower-case letters, and all bytes of other characters.
ALPHANUMERIC = (
    ((_UPPER >= 0x30) & (_UPPER <= 0x39)) | ((_UPPER >= 0x61) & (_UPPER <= 0x7A)) | (_UPPER >= 0x80)
)
#: ASCII letters, and all bytes of other characters.
LETTERS = (
    ((_UPPER >= 0x41) & (_UPPER <= 0x5A)) | ((_UPPER >= 0x61) & (_UPPER <= 0x7A)) | (_UPPER >= 0x80)
)
LOWER = np.where((_UPPER >= 0x41) & (_UPPER <= 0x5A), _UPPER + 32, _UPPER).astype(np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + mixed(np.array([seed], dtype=np.uint64)))


@functools.cache
def _bytes() -> np.ndarray:
    return randoms(256, 1)


@functools.lru_cache(maxsize=4)
def _places(n: int) -> np.ndarray:
    return randoms(n, 2) | np.uint64(1)


@dataclass
class Words:
    """The words of some rows: ``hashes``, and row ``i`` has words ``first[i]:first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """Row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(
    texts: list[bytes], kind: np.ndarray = NOT_SPACE, lower: bool = False, characters: int | None = None
) -> Words:
    """Words of bytes of one ``kind``; with ``characters``, only so many first ones of each count."""
    joined = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    buffer = LOWER[joined] if lower else joined
    inside = kind[buffer]
    if characters:
        begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        number = np.cumsum((buffer & 0xC0) != 0x80)
        before = np.repeat(number[begins], np.diff(np.append(begins, len(buffer))))
        inside[begins[0] if len(begins) else len(buffer) :] &= number[len(number) - len(before) :] - before < characters
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[0::2], edges[1::2]
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return Words(np.empty(0, np.uint64), first, buffer, starts, ends)
    sizes = ends - starts
    begins = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    longest = 1 << int(sizes.max()).bit_length()
    terms = _bytes()[buffer[inside]] * _places(max(64, longest))[place]
    return Words(mixed(np.add.reduceat(terms, begins)), first, buffer, starts, ends)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words starting at each word, and where all are of one row."""
    n = len(w.hashes)
    total = np.zeros(n, dtype=np.uint64)
    factors = randoms(size, 3) | np.uint64(1)
    for i in range(min(size, n)):
        total[: n - i] += w.hashes[i:] * factors[i]
    last = np.repeat(w.first[1:], w.counts) - size
    return mixed(total), np.arange(n) <= last


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with their texts in UTF-8; a missing text is empty."""
    for batch in batches:
        column = batch.column(text)
        if column.type != pa.binary():
            column = column.cast(pa.binary())
        lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        begin = size = 0
        for i in range(len(lengths) + 1):
            if i == len(lengths) or (size and size + lengths[i] > limit):
                if i > begin:
                    yield batch.slice(begin, i - begin), [x or b"" for x in column.slice(begin, i - begin).to_pylist()]
                begin, size = i, 0
            if i < len(lengths):
                size += lengths[i] + 1
