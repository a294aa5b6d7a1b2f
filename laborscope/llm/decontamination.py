"""Benchmark decontamination: which words of a text occur in windows of benchmark items.

A prefix-filtered containment join. Every window of an item is a set of
shingles; they are counted in the whole corpus and ordered by rarity. As a
window must occur completely, its prefix is its one rarest shingle: only texts
with that shingle are candidates. Its place in the window gives the only
possible alignment, which must lie within the text (length and positional
bounds), and then all words are compared.

The windows go to the tasks in blocks of at most ``block`` windows, so what is
broadcast has a fixed bound; a larger benchmark means more blocks, each a
further pass over the texts within the same job. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import annotate, query, table
from laborscope.llm.words import ALPHANUMERIC, Words, shingles, slices, words

WINDOW = 13
SHINGLE = 3
BLOCK = 200_000
#: Bits of the table that rules out most shingles at once.
_FILTER_BITS = 20


def item_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """``item_id, words``: each window as the hashes of its words; shorter items are one window.

    Items without an id or without words have none.
    """
    chosen = items.select(
        F.col(f"`{item}`").cast("string").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text")
    ).filter(F.col("item_id").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            w = words(texts, ALPHANUMERIC, lower=True)
            ids, found = [], []
            for row, name in enumerate(part.column("item_id").to_pylist()):
                own = w.hashes[w.first[row] : w.first[row + 1]]
                for i in range(max(1, len(own) - window + 1) if len(own) else 0):
                    ids.append(name)
                    found.append(own[i : i + window].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.binary())], names=["item_id", "words"]
            )

    return chosen.mapInArrow(run, "item_id string, words binary").distinct()


def _keys(windows: list[bytes], shingle: int) -> list[np.ndarray]:
    """Hashes of the shingles of each window; one of fewer words is one shingle."""
    out = []
    for x in windows:
        h = np.frombuffer(x, dtype=np.uint64)
        own = Words(h, np.array([0, len(h)]), h, h, h)
        hashes, whole = shingles(own, min(shingle, len(h)))
        out.append(hashes[whole])
    return out


class _Lookup:
    """Finds which of many hashes are in a sorted array."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.mask = np.uint64((1 << _FILTER_BITS) - 1)
        self.flags = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.flags[keys & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` and the places of their keys."""
        places = np.flatnonzero(self.flags[hashes & self.mask])
        if not len(places):
            return places, places
        at = np.minimum(np.searchsorted(self.keys, hashes[places]), len(self.keys) - 1)
        same = self.keys[at] == hashes[places]
        return places[same], at[same]


def _corpus_counts(docs: DataFrame, text: str, keys: dict[int, np.ndarray]) -> dict[int, dict]:
    """How often each of the given shingles occurs in all texts, by shingle length."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {n: _Lookup(k) for n, k in shared.value.items()}
        totals = {n: np.zeros(len(k), dtype=np.int64) for n, k in shared.value.items()}
        for _, texts in slices(batches):
            w = words(texts, ALPHANUMERIC, lower=True)
            for n, lookup in lookups.items():
                hashes, whole = shingles(w, n)
                _, at = lookup.find(hashes[whole])
                totals[n] += np.bincount(at, minlength=len(totals[n]))
        for n, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), n, dtype=np.int32)),
                    pa.array(at.astype(np.int64)),
                    pa.array(total[at]),
                ],
                names=["n", "at", "total"],
            )

    counted = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        run, "n int, at bigint, total bigint"
    )
    found = {n: np.zeros(len(k), dtype=np.int64) for n, k in keys.items()}
    for n, at, total in counted.groupBy("n", "at").agg(F.sum("total")).collect():
        found[n][at] = total
    shared.unpersist()
    return found


def _index(docs: DataFrame, text: str, rows: list, shingle: int) -> dict[int, dict]:
    """Windows of one block by the hash of their rarest shingle, by shingle length."""
    own = {}
    for name, x in rows:
        own.setdefault(bytes(x), []).append(name)
    windows = list(own)
    hashes = _keys(windows, shingle)
    lengths = [len(x) // 8 for x in windows]
    by_size: dict[int, list[int]] = {}
    for i, length in enumerate(lengths):
        by_size.setdefault(min(shingle, length), []).append(i)
    keys = {n: np.unique(np.concatenate([hashes[i] for i in at])) for n, at in by_size.items()}
    counts = _corpus_counts(docs, text, keys)
    width = max(lengths, default=1)
    index = {}
    for n, at in by_size.items():
        prefix, offset = [], []
        for i in at:
            rarity = counts[n][np.searchsorted(keys[n], hashes[i])]
            first = int(np.lexsort((hashes[i], rarity))[0])
            prefix.append(hashes[i][first])
            offset.append(first)
        order = np.argsort(np.array(prefix, dtype=np.uint64), kind="stable")
        known, begin = np.unique(np.array(prefix, dtype=np.uint64)[order], return_index=True)
        matrix = np.zeros((len(at), width), dtype=np.uint64)
        for row, place in enumerate(order):
            matrix[row, : lengths[at[place]]] = np.frombuffer(windows[at[place]], dtype=np.uint64)
        index[n] = {
            "keys": known,
            "begin": np.append(begin, len(at)),
            "offset": np.array(offset)[order],
            "length": np.array([lengths[at[p]] for p in order]),
            "words": matrix,
            "items": [own[windows[at[p]]] for p in order],
        }
    return index


def _matches(w: Words, n: int, x: dict, lookup: _Lookup) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of each window found."""
    hashes, whole = shingles(w, n)
    places, at = lookup.find(hashes)
    inside = whole[places]
    places, at = places[inside], at[inside]
    many = x["begin"][at + 1] - x["begin"][at]
    step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    window = np.repeat(x["begin"][at], many) + step
    places = np.repeat(places, many)
    row = np.searchsorted(w.first, places, side="right") - 1
    begin = places - x["offset"][window]
    fits = (begin >= w.first[row]) & (begin + x["length"][window] <= w.first[row + 1])
    begin, window = begin[fits], window[fits]
    for i in range(x["words"].shape[1]):
        needed = x["length"][window] > i
        same = ~needed
        same[needed] = w.hashes[begin[needed] + i] == x["words"][window[needed], i]
        begin, window = begin[same], window[same]
    return begin, window


def _scan(index) -> callable:
    def compute(texts: list[bytes], hits: list, named: list) -> list:
        w = words(texts, ALPHANUMERIC, lower=True)
        covered = np.zeros(len(w.hashes) + 1, dtype=np.int32)
        for n, x in index.items():
            begin, window = _matches(w, n, x, x["lookup"])
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + x["length"][window], -1)
            row = np.searchsorted(w.first, begin, side="right") - 1
            for r, k in set(zip(row.tolist(), window.tolist())):
                named[r] = sorted({*named[r], *x["items"][k]})
        covered = np.cumsum(covered[:-1]) > 0
        out, total = [], []
        for r in range(len(texts)):
            own = covered[w.first[r] : w.first[r + 1]]
            if hits[r]:
                own = own | np.unpackbits(np.frombuffer(hits[r], np.uint8), count=len(own)).astype(bool)
            out.append(np.packbits(own).tobytes() if own.any() else None)
            total.append(int(own.sum()))
        return [
            pa.array(w.counts, pa.int64()),
            pa.array(total, pa.int64()),
            pa.array(out, pa.binary()),
            pa.array(named, pa.list_(pa.string())),
        ]

    return compute


FIELDS = "n_words bigint, n_hit bigint, hit_words binary, items array<string>"


def _passes(docs: DataFrame, text: str, index: dict, keep, first: bool) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def prepare():
        known = shared.value
        for x in known.values():
            x.setdefault("lookup", _Lookup(x["keys"]))
        scan = _scan(known)

        def compute(texts: list[bytes]) -> list:
            return scan(texts, [None] * len(texts), [[] for _ in texts])

        return compute

    if first:
        return annotate(docs, text, FIELDS, prepare, keep)
    # A later block adds its hits to those of the blocks before.
    before = docs.withColumnsRenamed({"hit_words": "_hits_before", "items": "_items_before"})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for x in known.values():
            x.setdefault("lookup", _Lookup(x["keys"]))
        scan = _scan(known)
        for part, texts in slices(batches, text):
            found = scan(
                texts,
                part.column("_hits_before").to_pylist(),
                [x or [] for x in part.column("_items_before").to_pylist()],
            )
            new = dict(zip(("n_words", "n_hit", "hit_words", "items"), found))
            yield pa.RecordBatch.from_arrays(
                [new[c] if c in new else part.column(c) for c in names], names=names
            )

    return before.mapInArrow(run, schema)


def mark_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block: int = BLOCK,
    min_share: tuple[int, int] = (1, 20),
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``n_words, n_hit, hit_words, items, contaminated`` to every row.

    ``hit_words`` is a bit per word (null if none is hit), ``items`` the sorted
    ids of items with a window in the text. A text is contaminated if it has
    hits on at least ``min_share`` of its words. A null or empty text has no
    words; items without words or without id have no windows; repeated rows
    are judged alike and all stay; no items mean no hits. Columns named like
    the new ones are replaced.
    """
    spark = docs.sparkSession
    windows = item_windows(items, item, item_text, window)
    blocks = max(1, -(-windows.select("words").distinct().count() // block))
    wanted = list(docs.columns if keep is None else keep)
    carried = wanted if text in wanted or blocks == 1 else [*wanted, text]
    marked = docs
    for number in range(blocks):
        # Equal windows of several items are in one block.
        own = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == number).collect()
        marked = _passes(
            marked, text, _index(docs, text, own, shingle), carried, first=number == 0
        )
    share, of = min_share
    hit = (F.col("n_hit") > 0) & (F.col("n_hit") * of >= F.col("n_words") * share)
    fields = ["n_words", "n_hit", "hit_words", "items", "contaminated"]
    rest = [F.col(f"`{c}`") for c in wanted if c.lower() not in fields]
    return marked.withColumn("contaminated", hit).select(*rest, *fields)


# DuckDB: words by regular expression, windows as lists, occurrences by equality.
_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
    SELECT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw USING (k, g)),
per_word AS (SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
per_item AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)"""


@query(_SQL)
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = mark_contamination(docs, table(spark, folder, "benchmark"), keep=["doc_id"])
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
