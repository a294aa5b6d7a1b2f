"""Substring deduplication: words in windows that an earlier text also has.

Every window of ``window`` words has a Rabin-Karp hash. To keep the shuffle
small, windows are first told apart by their minimizer, the smallest hash of
``GRAM`` consecutive words inside: equal windows have equal minimizers, and a
run of windows shares one. So only windows whose minimizer occurs in two texts
or more can repeat, and only those are counted:

1. ``(minimizer, text)`` pairs are counted in Spark; they are a few percent of
   all words.
2. Texts with shared minimizers give the hashes of the windows concerned, packed
   by minimizer. Among the texts of one slice repeats are settled at once and
   only the first text of a window goes on.
3. Per minimizer the first text of every window is found; windows of later
   texts become intervals, and these merge to maximal ones per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.llm.words import SLICE_BYTES, Words, mixed, randoms, shingles, slices, words

WINDOW = 50
GRAM = 8
#: A minimizer of more texts is dealt to several tasks, by the hash of the window.
TEXTS_PER_TASK = 1000
#: Longest run of windows in one row; offsets in a run are two bytes.
_LONGEST = 1 << 16
_MULTIPLIER = randoms(1, 21)[0] | np.uint64(1)


def rolling(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of the ``size`` words from each word on, and which lie in one row."""
    n = len(w.hashes)
    last = np.repeat(w.first[1:], w.counts) - size
    whole = np.arange(n) <= last
    # Powers of an odd number modulo 2**64, and the inverse to shift them back.
    power = np.cumprod(np.full(n, _MULTIPLIER), dtype=np.uint64)
    inverse = np.cumprod(np.full(n, np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))), dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(w.hashes * power, dtype=np.uint64)])
    at = np.minimum(np.arange(n) + size, n)
    return mixed((total[at] - total[:n]) * inverse), whole


def minimizers(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest hash of ``gram`` words in the window from each word on, and where it is whole."""
    hashes, _ = shingles(w, gram)
    least, width, wanted = hashes.copy(), 1, window - gram + 1
    while width < wanted:
        step = min(width, wanted - width)
        least[:-step or None] = np.minimum(least[:-step or None], least[step:])
        width += step
    last = np.repeat(w.first[1:], w.counts) - window
    return least, np.arange(len(hashes)) <= last


def _runs(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word, end and minimizer of each run of windows with one minimizer."""
    least, whole = minimizers(w, window, gram)
    row = w.rows()
    at = np.flatnonzero(whole)
    if not len(at):
        return at, at, at, np.empty(0, np.uint64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[at][1:] != least[at][:-1]) | (row[at][1:] != row[at][:-1]) | (np.diff(at) != 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))
    return row[at[begin]], at[begin], at[end - 1] + 1, least[at[begin]]


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def _compressed(texts: DataFrame) -> DataFrame:
    """The texts as zstandard data, about half of what a shuffle writes of them otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False).compress
        for part, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([pack(x) for x in texts], pa.binary())], names=["doc_id", "packed"]
            )

    return texts.mapInArrow(run, "doc_id bigint, packed binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        # Packed texts are small; their slices bound the unpacked ones.
        for part, packed in slices([batch], "packed", SLICE_BYTES // 4):
            yield part, [unpack(x) for x in packed]


def shared_minimizers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, minimizer, parts`` of minimizers that two texts or more have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            row, _, _, least = _runs(words(texts), window, gram)
            both = np.unique(np.column_stack([row.astype(np.uint64), least]), axis=0)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[both[:, 0].astype(np.int64)], pa.int64()),
                    pa.array(np.ascontiguousarray(both[:, 1]).view(np.int64)),
                ],
                names=["doc_id", "minimizer"],
            )

    pairs = docs.filter(F.col("doc_id").isNotNull()).mapInArrow(run, "doc_id bigint, minimizer bigint")
    pairs = pairs.checkpoint()
    counted = pairs.groupBy("minimizer").agg(
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
        F.ceil(F.count("*") / TEXTS_PER_TASK).alias("parts"),
    )
    shared = counted.filter("low < high").select("minimizer", "parts")
    return pairs.join(shared, "minimizer").select("doc_id", "minimizer", "parts")


def _window_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """From ``doc_id, packed, wanted`` (minimizers and their parts): settled intervals and open windows.

    An interval has ``doc_id, start, stop``; open windows of one run have
    ``minimizer, part, doc_id, start`` with their ``offsets`` from there (null if
    they follow one another) and ``hashes``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _unpacked(batches):
            w = words(texts)
            row, begin, end, least = _runs(w, window, gram)
            wanted = part.column("wanted")
            values = wanted.flatten()
            owner = np.repeat(np.arange(len(texts)), np.diff(wanted.offsets.to_numpy()))
            # A run is open if its text asks for its minimizer.
            step = np.uint64(0x9E3779B97F4A7C15)
            asked = mixed(values.field("minimizer").to_numpy().view(np.uint64) + owner.astype(np.uint64) * step)
            order = np.argsort(asked)
            asked, parts = asked[order], values.field("parts").to_numpy()[order]
            have = mixed(least + row.astype(np.uint64) * step)
            at = np.minimum(np.searchsorted(asked, have), len(asked) - 1)
            found = asked[at] == have
            row, begin, end, least, parts = row[found], begin[found], end[found], least[found], parts[at[found]]
            hashes, _ = rolling(w, window)
            ids = part.column("doc_id").to_numpy()
            size = end - begin
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            run_of = np.repeat(np.arange(len(begin)), size)
            place = np.repeat(begin, size) + inside
            own, doc, start = hashes[place], ids[row[run_of]], place - w.first[row[run_of]]
            # Windows of a later text of this slice repeat one of an earlier text.
            order = np.lexsort((doc, own))
            first = np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1]))[: len(own)]
            count = np.diff(np.append(first, len(own)))
            repeats = np.zeros(len(own), dtype=bool)
            repeats[order] = doc[order] > np.repeat(doc[order][first], count)
            late = np.flatnonzero(repeats)
            new = np.append(True, (np.diff(late) != 1) | (np.diff(row[run_of[late]]) != 0))[: len(late)]
            low = late[new]
            high = late[np.append(np.flatnonzero(new)[1:] - 1, len(late) - 1)[: len(low)]]
            yield _rows(doc_id=doc[low], start=start[low], stop=start[high] + window)
            rest = np.flatnonzero(~repeats)
            salt = ((own[rest] >> np.uint64(32)) % parts[run_of[rest]].astype(np.uint64)).astype(np.int64)
            block = inside[rest] // _LONGEST
            order = np.lexsort((rest, block, salt, run_of[rest]))
            rest, salt, block = rest[order], salt[order], block[order]
            owner = run_of[rest]
            new = np.append(True, (np.diff(owner) != 0) | (np.diff(salt) != 0) | (np.diff(block) != 0))[: len(rest)]
            low = np.flatnonzero(new)
            high = np.append(low[1:], len(rest))[: len(low)]
            offset = (inside[rest] % _LONGEST).astype(np.uint16)
            own = own[rest]
            gapless = offset[high - 1].astype(np.int64) - offset[low] == high - low - 1 if len(low) else low
            yield _rows(
                doc_id=doc[rest[low]],
                start=start[rest[low]] - np.where(gapless, 0, offset[low]),
                minimizer=least[owner[low]].view(np.int64),
                part=salt[low],
                offsets=[None if g else offset[a:b].tobytes() for g, a, b in zip(gapless, low, high)],
                hashes=[own[a:b].tobytes() for a, b in zip(low, high)],
            )

    return texts.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _FIELDS.items()))


_FIELDS = {
    "doc_id": "bigint",
    "start": "bigint",
    "stop": "bigint",
    "minimizer": "bigint",
    "part": "bigint",
    "offsets": "binary",
    "hashes": "binary",
}


def _rows(**columns) -> pa.RecordBatch:
    kinds = {n: pa.binary() if t == "binary" else pa.int64() for n, t in _FIELDS.items()}
    size = len(columns["doc_id"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in kinds.items()],
        names=list(_FIELDS),
    )


def _repeated(runs: DataFrame, window: int) -> DataFrame:
    """``doc_id, start, stop`` of words in windows that an earlier text has."""

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by minimizer, part and text: the first text with a hash keeps it.
        current, owner = None, {}
        names = ("minimizer", "part", "doc_id", "start", "offsets", "hashes")
        for batch in batches:
            out = []
            for least, part, doc, start, offsets, packed in zip(*(batch.column(n).to_pylist() for n in names)):
                if (least, part) != current:
                    current, owner = (least, part), {}
                late = [owner.setdefault(h, doc) < doc for h in np.frombuffer(packed, np.uint64).tolist()]
                if not any(late):
                    continue
                places = np.flatnonzero(late)
                if offsets is not None:
                    places = np.frombuffer(offsets, np.uint16).astype(np.int64)[places]
                cut = np.flatnonzero(np.diff(places, prepend=-2, append=1 << 20) != 1)
                for a, b in zip(cut, cut[1:]):
                    out.append((doc, start + int(places[a]), start + int(places[b - 1]) + window))
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "stop"]
            )

    keys = ["minimizer", "part"]
    dealt = runs.repartition(*keys).sortWithinPartitions(*keys, "doc_id")
    return dealt.mapInArrow(intervals, "doc_id bigint, start bigint, stop bigint")


def _merged(ranges: list) -> list[tuple[int, int]]:
    out = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def repeated_intervals(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``doc_id, ranges``: maximal ``start, stop`` word intervals that an earlier text covers.

    Earlier means a smaller key. Texts without such words, without ``window``
    words or without key have no row. Rows that repeat a key never cover each
    other.
    """
    texts = _texts(docs, key, text)
    shared = shared_minimizers(texts, window, gram)
    wanted = shared.groupBy("doc_id").agg(F.collect_set(F.struct("minimizer", "parts")).alias("wanted"))
    rows = _window_rows(_compressed(texts).join(wanted, "doc_id"), window, gram).checkpoint()
    settled = rows.filter(F.col("hashes").isNull()).select("doc_id", "start", "stop")
    later = _repeated(rows.filter(F.col("hashes").isNotNull()), window)
    # At most one interval per word of a text meets here.
    return settled.unionByName(later).groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``doc_id, kept, n_words, n_removed`` per row: the words left, joined by one space.

    A null or empty text has no words; nothing of a row without key is removed.
    """
    ranges = repeated_intervals(docs, key=key, text=text, window=window, gram=gram)
    joined = _compressed(_texts(docs, key, text)).join(ranges, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _unpacked(batches):
            kept, total, removed = [], [], []
            for x, found in zip(texts, part.column("ranges").to_pylist()):
                own = x.split()
                total.append(len(own))
                for a, b in reversed(_merged([(r["start"], r["stop"]) for r in found or []])):
                    del own[a:b]
                removed.append(total[-1] - len(own))
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                ],
                names=["doc_id", "kept", "n_words", "n_removed"],
            )

    return joined.mapInArrow(run, "doc_id bigint, kept string, n_words bigint, n_removed bigint")


# DuckDB: windows as joined words, the smallest text of each, and the words covered.
_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT g, min(doc_id) AS first_doc FROM win GROUP BY g),
late AS (SELECT doc_id, i FROM win JOIN low USING (g) WHERE first_doc < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM late),
words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""


@query(_SQL)
def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
