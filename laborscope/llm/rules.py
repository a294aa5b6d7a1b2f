"""Quality rules with an n-gram perplexity band per language.

The rules count words, symbols, repeated lines and repeated word windows. The
perplexity comes from a modified Kneser-Ney model of byte n-grams for each
language: counts, continuation counts and discounts are Spark aggregations over
the whole corpus. Texts are dealt to batches of one language; every distinct
n-gram of a batch is joined to the full tables, and the batch gets back the counts.

A text is scored by the model without its own counts: they are taken from the
counts of each order, from the totals of the contexts, and, where an n-gram is in
no other text, from the continuation counts below. Discounts stay those of the corpus.

A text is rejected outside the band of its language: bits per byte beyond
``SPREAD`` times the interquartile range from the quartiles of all its texts that
pass the rules.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.llm.words import SLICE_BYTES, shingles, slices, words

ORDER = 5
SPREAD = 3.0
MIN_WORDS = 50
#: Bytes of text per batch that is joined to the tables.
BATCH_BYTES = 1 << 26
#: Distinct n-grams that a task gathers before it hands them on.
GATHERED = 2_000_000
#: Quartiles are taken of bits rounded to so many places: at most 80,000 different values.
BITS_PLACES = 4
#: Stands for a null language, which is one by itself.
_NO_LANGUAGE = "\x01none"

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
# White space is one byte, a digit any digit; other bytes stay.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[9, 10, 11, 12, 13]] = 0x20
_FOLD[0x30:0x3A] = 0x30


def _repeat_words(w, size: int = 3) -> np.ndarray:
    """Words of each row in windows of ``size`` words that the row has twice or more."""
    hashes, whole = shingles(w, size)
    row = w.rows()
    at = np.flatnonzero(whole)
    order = np.lexsort((hashes[at], row[at]))
    h, r = hashes[at][order], row[at][order]
    same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order] = np.append(same, False)[: len(at)] | np.append(False, same)[: len(at)]
    covered = np.zeros(len(hashes) + size, dtype=bool)
    for i in range(size):
        covered[at[twice] + i] = True
    total = np.concatenate([[0], np.cumsum(covered[: len(hashes)])])
    return total[w.first[1:]] - total[w.first[:-1]]


def _repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def base_measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    w = words(texts)
    bounds = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
    inside = np.zeros(len(w.buffer) + 1, dtype=np.int64)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    in_word = np.cumsum(inside[:-1]) > 0

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[bounds[1:]] - total[bounds[:-1]]

    return {
        "n_words": w.counts,
        "word_chars": per_row(in_word & ((w.buffer & 0xC0) != 0x80)),
        "n_symbols": per_row(_SYMBOLS[w.buffer]),
        "n_dup_lines": np.array([_repeated_lines(x) for x in texts]),
        "n_repeat_words": _repeat_words(w),
    }


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The last ``order`` bytes up to each byte as a number, and its row; texts begin with spaces."""
    pad = b" " * (order - 1)
    joined = _FOLD[np.frombuffer(b"".join(pad + x for x in texts), dtype=np.uint8)]
    lengths = np.array([len(x) for x in texts])
    total = np.zeros(len(joined), dtype=np.int64)
    for i in range(order):
        total[order - 1 :] = (total[order - 1 :] << 8) | joined[i : len(joined) - order + 1 + i]
    begins = np.cumsum(lengths + order - 1) - lengths
    row = np.repeat(np.arange(len(texts)), lengths)
    at = np.repeat(begins, lengths) + np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return total[at], row


def _counts(docs: DataFrame, order: int) -> DataFrame:
    """``lang, gram, n`` for the n-grams of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge() -> None:
            for lang, parts in known.items():
                gram = np.concatenate([g for g, _ in parts])
                order = np.argsort(gram, kind="stable")
                gram, n = gram[order], np.concatenate([n for _, n in parts])[order]
                begin = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
                known[lang] = [(gram[begin], np.add.reduceat(n, begin))]

        def out(lang: str) -> Iterator[pa.RecordBatch]:
            for gram, n in known.pop(lang):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

        size = 0
        for part, texts in slices(batches):
            langs = np.array(part.column("lang").to_pylist(), dtype=object)
            gram, row = grams(texts, order)
            if not len(gram):
                continue
            for lang in sorted(set(langs)):
                new, n = np.unique(gram[(langs == lang)[row]], return_counts=True)
                if len(new):
                    known.setdefault(lang, []).append((new, n))
                    size += len(new)
            if size > GATHERED:
                merge()
                size = sum(len(g) for parts in known.values() for g, _ in parts)
                # What stays large after merging goes on as it is.
                if size > GATHERED // 2:
                    for lang in list(known):
                        yield from out(lang)
                    size = 0
        merge()
        for lang in list(known):
            yield from out(lang)

    found = docs.mapInArrow(run, "lang string, gram bigint, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _last(gram: Column, order: int) -> Column:
    """The last ``order`` bytes of a packed n-gram."""
    return gram.bitwiseAND(F.lit((1 << (8 * order)) - 1))


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3``: the discounts of one order, from its counts of counts."""
    ones = [F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in range(1, 5)]
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        value = i - (i + 1) * y * F.try_divide(f"n{i + 1}", f"n{i}")
        # Small or odd counts of counts fall back to a plain discount.
        return F.coalesce(F.when((value > 0) & (value < i), value), F.lit(0.5 * i)).alias(f"d{i}")

    return counts.groupBy("lang").agg(*ones).select("lang", *(discount(i) for i in (1, 2, 3)))


def counted(docs: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """Per order from 1 on: ``lang, gram, n`` for all n-grams.

    ``n`` is the count for the highest order and the number of distinct bytes
    before it for lower ones.
    """
    tables = [_counts(docs, order).checkpoint()]
    for k in range(order - 1, 0, -1):
        below = tables[0].groupBy("lang", _last(F.col("gram"), k).alias("gram"))
        tables.insert(0, below.agg(F.count("*").alias("n")).checkpoint())
    return tables


def _rated(counts: DataFrame) -> DataFrame:
    """``lang, context, gram, n, d``, and of the context ``total`` and the sum ``discount``."""
    context = F.shiftright("gram", 8)
    rated = counts.withColumn("context", context).join(F.broadcast(_discounts(counts)), "lang")
    own = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rated = rated.withColumn("d", own)
    contexts = rated.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("discount"))
    return rated.join(contexts, ["lang", "context"])


def _tagged(gram, k: int):
    """N-grams of different orders ``k`` as different numbers."""
    return gram + (k << 56)


class Perplexity:
    """Scores texts of one language by the counts of all their n-grams.

    ``grams`` are the tagged n-grams of all orders in ascending order, with the
    columns of :func:`_rated`; ``discounts`` has three numbers per order.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray, total: np.ndarray, discount: np.ndarray, discounts: np.ndarray):
        self.grams, self.n, self.total, self.discount = grams, n, total, discount
        # No count, no discount.
        self.discounts = np.column_stack([np.zeros(len(discounts)), discounts])
        # Where the n-gram without its first byte is; nothing is below a single byte.
        k = grams >> 56
        suffix = _tagged(grams & ((1 << (8 * (k - 1))) - 1), k - 1)
        self.below = np.searchsorted(grams, suffix)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits per byte of each text by the counts of all others; NaN for one without bytes."""
        order = len(self.discounts)
        most = 1 << (62 - 8 * order)
        if len(texts) > most:
            return np.concatenate([self.bits(texts[i : i + most]) for i in range(0, len(texts), most)])
        gram, row = grams(texts, order)
        if not len(gram):
            return np.full(len(texts), np.nan)
        # The distinct n-grams of each text, and how much of their counts is its own.
        pairs, own = np.unique((row << (8 * order)) | gram, return_counts=True)
        times, text = own, pairs >> (8 * order)
        at = np.searchsorted(self.grams, _tagged(pairs & ((1 << (8 * order)) - 1), order))
        steps = []
        for k in range(order, 0, -1):
            mask = (1 << (8 * k)) - 1
            n = self.n[at]
            left = n - own
            rate = self.discounts[k - 1]
            kept = rate[np.minimum(left, 3)]
            context = pairs >> 8
            begin = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            size = np.diff(np.append(begin, len(pairs)))
            total = self.total[at] - np.repeat(np.add.reduceat(own, begin), size)
            freed = np.add.reduceat(rate[np.minimum(n, 3)] - kept, begin)
            discount = self.discount[at] - np.repeat(freed, size)
            with np.errstate(invalid="ignore", divide="ignore"):
                # An unknown context leaves all to the order below.
                direct = np.where(total > 0, (left - kept) / total, 0.0)
                back = np.where(total > 0, discount / total, 1.0)
            # An n-gram in no other text is one byte less before its suffix.
            gone = (own > 0) & (left == 0)
            lower = ((pairs >> (8 * k)) << (8 * (k - 1))) | (pairs & (mask >> 8))
            pairs, below = np.unique(lower, return_inverse=True)
            steps.append((direct, back, below))
            lower_at = np.empty(len(pairs), dtype=np.int64)
            lower_at[below] = self.below[at]
            at = lower_at
            own = np.bincount(below, gone, minlength=len(pairs)).astype(np.int64)
        p = np.full(len(pairs), 1 / 256)
        for direct, back, below in reversed(steps):
            p = direct + back * p[below]
        count = np.bincount(row, minlength=len(texts))
        with np.errstate(invalid="ignore", divide="ignore"):
            return -np.bincount(text, times * np.log2(p), minlength=len(texts)) / count


def _packed(docs: DataFrame) -> DataFrame:
    """``text`` as zstandard data: a shuffle writes less of it than by its own compression."""
    types = dict(docs.dtypes) | {"text": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False).compress
        for part, texts in slices(batches):
            packed = pa.array([pack(x) for x in texts], pa.binary())
            yield part.set_column(part.schema.get_field_index("text"), "text", packed)

    return docs.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in docs.columns))


def _unpacked(own: pa.Table) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    unpack = zstandard.ZstdDecompressor().decompress
    for part, packed in slices(own.to_batches(), limit=SLICE_BYTES // 4):
        yield part, [unpack(x) for x in packed]


def judge(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    spread: float = SPREAD,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per row ``doc_id, lang``, the measures, ``base_failed, bits, kept``.

    A null or empty text has no words and fails the rules; a null language is
    one language of its own. Repeated rows are judged alike and count each.
    """
    chosen = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(_NO_LANGUAGE)).alias("lang"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    tables = counted(chosen.select("lang", "text"), order)
    known: dict[str, list] = {}
    for counts in tables:
        for r in _discounts(counts).collect():
            known.setdefault(r.lang, []).append((r.d1, r.d2, r.d3))
    shared = docs.sparkSession.sparkContext.broadcast(known)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    types = dict(chosen.dtypes)
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = int(size // batch_bytes) + 1
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    dealt = _packed(chosen.withColumn("batch", batch)).repartition(batches, "lang", "batch")

    def asked(own: pa.Table) -> pa.Table:
        found, size = [np.empty(0, dtype=np.int64)], 0
        for _, texts in _unpacked(own):
            found.append(np.unique(grams(texts, order)[0]))
            size += len(found[-1])
            if size > GATHERED:
                found, size = [np.unique(np.concatenate(found))], 0
        found = np.concatenate(found)
        every = []
        for k in range(order, 0, -1):
            found = np.unique(found & ((1 << (8 * k)) - 1))
            every.append(_tagged(found, k))
        gram = np.concatenate(every)
        first = [own.column(c)[0].as_py() for c in ("lang", "batch")]
        return pa.table(
            {
                "lang": pa.array([first[0]] * len(gram), pa.string()),
                "batch": pa.array(np.full(len(gram), first[1], dtype=np.int32)),
                "gram": pa.array(gram),
            }
        )

    def score(own: pa.Table, answers: pa.Table) -> pa.Table:
        sort = np.argsort(answers.column("gram").to_numpy())
        columns = [answers.column(c).to_numpy()[sort] for c in ("gram", "n", "total", "discount")]
        discounts = shared.value.get(own.column("lang")[0].as_py(), [(0.0,) * 3] * order)
        model = Perplexity(*columns, np.array(discounts))
        out = []
        for part, texts in _unpacked(own):
            measures = base_measures(texts)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("lang"),
                        *(pa.array(measures[n].astype(np.int64)) for n in names),
                        pa.array(model.bits(texts), pa.float64(), from_pandas=True),
                    ],
                    names=["doc_id", "lang", *names, "bits"],
                )
            )
        return pa.Table.from_batches(out)

    rated = [
        _rated(counts).select("lang", _tagged(F.col("gram"), k).alias("gram"), "n", "total", "discount")
        for k, counts in enumerate(tables, 1)
    ]
    wanted = dealt.groupBy("lang", "batch").applyInArrow(asked, "lang string, batch int, gram bigint")
    answers = wanted.join(functools.reduce(DataFrame.unionAll, rated), ["lang", "gram"])
    fields = ", ".join(f"{n} bigint" for n in names)
    measured = (
        dealt.groupBy("lang", "batch")
        .cogroup(answers.groupBy("lang", "batch"))
        .applyInArrow(score, f"doc_id {types['doc_id']}, lang string, {fields}, bits double")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed).checkpoint()
    # Exact for values rounded to BITS_PLACES, of which there are few, whatever the order of the rows.
    quartiles = F.percentile(F.round("bits", BITS_PLACES), [0.25, 0.75])
    bands = (
        measured.filter(~F.col("base_failed"))
        .groupBy("lang")
        .agg(quartiles.alias("q"))
        .select(
            "lang",
            (F.col("q")[0] - spread * (F.col("q")[1] - F.col("q")[0])).alias("low"),
            (F.col("q")[1] + spread * (F.col("q")[1] - F.col("q")[0])).alias("high"),
        )
    )
    inside = F.coalesce(F.col("bits").between(F.col("low"), F.col("high")), F.lit(False))
    judged = measured.join(bands, "lang", "left").withColumn("kept", ~F.col("base_failed") & inside)
    return judged.withColumn("lang", F.when(F.col("lang") != _NO_LANGUAGE, F.col("lang")))


@query()
def op10_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "bits"
    )
