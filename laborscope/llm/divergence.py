"""Source divergence audit: how far the term shares of the sources of a language lie apart.

Every pair of sources is priced by a sum over all kept terms, and the price of a term
depends only on its count in both sources. So the terms of a language make a one-hot
matrix with a column per source and count level, the level of absent terms included.
The product of its transpose with itself holds, for each two sources, how many terms
have which two levels: the joint tables. It is taken in blocks of terms, as an exact
matrix product of the columns that occur in the block, and each table is priced cell
by cell. Terms of similar frequency share a block, so that few columns occur in it.

Counts are summed inside the tasks before they are shuffled by language and term, so
a source with a large share of the texts sends one row per term and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.llm.words import LETTERS, slices, words

#: A term is kept if so many texts of its language have it.
LEAST_TEXTS = 3
BEST_TERMS = 200
SHARE_SCALE = 1_000_000_000
#: Distinct terms of sources that a task gathers before it hands them on.
GATHERED = 1_000_000
#: Terms times sources that one task takes of a language.
BLOCK_CELLS = 200_000
#: Terms of one matrix product, and columns it should have at most.
BLOCK_ROWS, BLOCK_COLUMNS = 4096, 1024
#: Up to so many sources, their totals are broadcast.
MANY_SOURCES = 100_000


class _Counts:
    """Occurrences and texts of terms per group, merged as they come."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.names: dict[int, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, group: np.ndarray, texts: list[bytes]) -> None:
        w = words(texts, LETTERS, lower=True)
        distinct, at = np.unique(w.hashes, return_index=True)
        for h, i in zip(distinct.tolist(), at.tolist()):
            if h not in self.names:
                self.names[h] = w.buffer[w.starts[i] : w.ends[i]].tobytes()
        rows = w.rows()
        order = np.lexsort((w.hashes, rows))
        rows, hashes = rows[order], w.hashes[order]
        begin = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1]))[: len(rows)])
        n = np.diff(np.append(begin, len(rows)))
        self._merge(group[rows[begin]].astype(np.uint64), hashes[begin], n.astype(np.uint64), np.ones(len(n), np.uint64))

    def _merge(self, *columns: np.ndarray) -> None:
        group, hashes, n, texts = columns
        order = np.lexsort((hashes, group))
        group, hashes, n, texts = group[order], hashes[order], n[order], texts[order]
        begin = np.flatnonzero(
            np.append(True, (group[1:] != group[:-1]) | (hashes[1:] != hashes[:-1]))[: len(group)]
        )
        if len(begin):
            summed = [np.add.reduceat(x, begin) for x in (n, texts)]
            self.parts.append(np.stack([group[begin], hashes[begin], *summed]))
            self.size += len(begin)

    def merge(self) -> None:
        parts = np.concatenate(self.parts, axis=1) if self.parts else np.empty((4, 0), np.uint64)
        self.clear()
        self._merge(*parts)

    def take(self) -> pa.RecordBatch:
        """All rows, which are then forgotten."""
        self.merge()
        group, hashes, n, texts = self.parts[0] if self.parts else np.empty((4, 0), np.uint64)
        known = list(self.groups)
        own = [known[g] for g in group.tolist()]
        terms = pa.array([self.names[h] for h in hashes.tolist()], pa.binary()).cast(pa.string())
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([g[0] for g in own], pa.string()),
                pa.array([g[1] for g in own], pa.string()),
                terms,
                pa.array(n.astype(np.int64)),
                pa.array(texts.astype(np.int64)),
            ],
            names=["lang", "source", "term", "n", "texts"],
        )
        self.clear()
        self.names = {}
        return batch


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, texts``: partial counts, to be summed; no column of ``docs`` is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for part, texts in slices(batches):
            pairs = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            group = np.array([counts.groups.setdefault(p, len(counts.groups)) for p in pairs])
            counts.add(group, texts)
            if counts.size > GATHERED:
                counts.merge()
                # What stays large after merging goes on as it is.
                if counts.size > GATHERED // 2:
                    yield counts.take()
        yield counts.take()

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, texts bigint")


def term_profiles(docs: DataFrame, least: int = LEAST_TEXTS) -> DataFrame:
    """``lang, term, total, counts`` of the kept terms; ``counts`` has ``source, n`` where it occurs."""
    # Both groupings run on the one shuffle by language and term.
    per_source = (
        term_counts(docs)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    )
    return (
        per_source.groupBy("lang", "term")
        .agg(
            F.sum("texts").alias("texts"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("counts"),
        )
        .filter(F.col("texts") >= least)
        .drop("texts")
    )


def source_totals(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """``lang, source, n, lang_n, kept`` of every group: its terms, its language's, and kept terms."""
    own = profiles.select("lang", F.explode("counts").alias("x")).groupBy("lang", "x.source")
    own = own.agg(F.sum("x.n").alias("n"))
    langs = profiles.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("kept"))
    every = docs.select("lang", "source").distinct()
    joined = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    return joined.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "lang_n", "kept")))


def share(count: Column, total: Column) -> Column:
    """1 plus the share of ``count`` + 1 in ``total``, in parts of ``SHARE_SCALE``, rounded down."""
    scaled = (count + 1).cast("decimal(19,0)") * F.lit(SHARE_SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, total.cast("decimal(19,0)")).cast("bigint") + 1


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for arrays, by long division, as the product may exceed 64 bits."""
    rest, found = count + 1, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // total
        rest = rest % total
    return found + 1


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def price_tables(p: np.ndarray) -> np.ndarray:
    """Prices of each two sources, summed over the terms; ``p`` has a row per term and a column per source."""
    terms, sources = p.shape
    value = np.zeros((sources, sources), dtype=np.int64)
    column = np.broadcast_to(np.arange(sources), p.shape)
    at, size = 0, BLOCK_ROWS
    while at < terms:
        size = min(2 * size, BLOCK_ROWS, terms - at)
        while True:
            # One-hot columns: the source and its level.
            own = column[at : at + size].ravel()
            levels, hot = np.unique(own * (2 * SHARE_SCALE) + p[at : at + size].ravel(), return_inverse=True)
            if len(levels) <= BLOCK_COLUMNS or size == 1:
                break
            size = (size + 1) // 2
        source, level = np.divmod(levels, 2 * SHARE_SCALE)
        one = np.zeros((size, len(levels)), dtype=np.float32)
        one[np.repeat(np.arange(size), sources), hot] = 1
        # Exact: no cell exceeds the number of rows, far below 2 ** 24.
        joint = one.T @ one
        a, b = np.nonzero(joint)
        a, b = a[source[a] != source[b]], b[source[a] != source[b]]
        cell = (level[a] - level[b]) ** 2 // level[b] * joint[a, b].astype(np.int64)
        np.add.at(value, (source[a], source[b]), cell)
        at += size
    return value


def _price_block(profiles: pa.Table, totals: pa.Table) -> pa.Table:
    sources = totals.column("source").to_pylist()
    total = (totals.column("n").to_numpy() + totals.column("kept").to_numpy()).astype(np.int64)
    order = np.argsort(-profiles.column("total").to_numpy(), kind="stable")
    counts = profiles.column("counts").combine_chunks().take(pa.array(order))
    place = {s: i for i, s in enumerate(sources)}
    named = counts.flatten().field("source").dictionary_encode()
    known = np.array([place[s] for s in named.dictionary.to_pylist()], dtype=np.int64)
    source = known[named.indices.to_numpy()]
    n = counts.flatten().field("n").to_numpy()
    row = np.repeat(np.arange(len(order)), counts.value_lengths().to_numpy())
    p = np.tile(shares(np.zeros(len(sources), dtype=np.int64), total), (len(order), 1))
    p[row, source] = shares(n, total[source])
    value = price_tables(p)
    a, b = np.nonzero(value)
    return pa.table(
        {
            "lang": pa.array([totals.column("lang")[0].as_py()] * len(a), pa.string()),
            "source": pa.array([sources[i] for i in a], pa.string()),
            "item": pa.array([sources[i] for i in b], pa.string()),
            "value": pa.array(value[a, b]),
        }
    )


def source_pairs(profiles: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each two different sources of a language."""
    sizes = totals.groupBy("lang").agg(F.max("kept").alias("k"), F.count("*").alias("g"))
    sizes = sizes.select("lang", F.ceil(F.col("k") * F.col("g") / BLOCK_CELLS).cast("int").alias("blocks"))
    # The sources of a language go to each of its blocks; a block prices their square.
    numbers = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    blocks = sizes.filter("blocks > 0").select("lang", "blocks", numbers)
    held = totals.join(blocks, "lang").select("lang", "block", "source", "n", "kept")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    # One row per language.
    dealt = profiles.join(sizes.filter("blocks > 0"), "lang").withColumn("block", block)
    priced = (
        dealt.select("lang", "block", "total", "counts")
        .groupBy("lang", "block")
        .cogroup(held.groupBy("lang", "block"))
        .applyInArrow(
            lambda own, other: _price_block(own, other) if len(own) else _EMPTY,
            "lang string, source string, item string, value bigint",
        )
    )
    summed = priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    other = totals.select("lang", F.col("source").alias("item"))
    pairs = totals.select("lang", "source").join(other, "lang").filter("source <> item")
    joined = pairs.join(summed, ["lang", "source", "item"], "left")
    return joined.withColumn("value", F.coalesce("value", F.lit(0).cast("bigint")))


_EMPTY = pa.table(
    {c: pa.array([], pa.int64() if c == "value" else pa.string()) for c in ("lang", "source", "item", "value")}
)


def source_terms(profiles: DataFrame, totals: DataFrame, best: int = BEST_TERMS) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that a source has more of than its language."""
    known = F.broadcast(totals) if totals.count() <= MANY_SOURCES else totals
    counts = profiles.select("lang", "term", "total", F.explode("counts").alias("x"))
    own = counts.select("lang", "term", "total", F.col("x.source").alias("source"), F.col("x.n").alias("count"))
    joined = own.join(known, ["lang", "source"])
    p = share(F.col("count"), F.col("n") + F.col("kept"))
    q = share(F.col("total"), F.col("lang_n") + F.col("kept"))
    priced = joined.withColumns({"p": p, "q": q}).filter("p > q")
    rows = priced.select("lang", "source", F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    return rows.withColumn("rank", F.row_number().over(_in_order())).filter(F.col("rank") <= best)


def _in_order() -> Window:
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")


def audit(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_TEXTS,
    best: int = BEST_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every source of every language.

    Part ``pair`` prices the source against each other one, over all kept terms; part
    ``term`` has the terms that set it apart from its language, at most ``best``. Null
    texts, languages and sources are empty ones, and a source counts without terms too.
    Repeated rows count each; ties go by item; an empty table gives no rows.
    """
    names = {"lang": lang, "source": source, "text": text}
    read = docs.select(
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in names.items())
    )
    profiles = term_profiles(read, least).checkpoint()
    totals = source_totals(read, profiles).checkpoint()
    pairs = source_pairs(profiles, totals).withColumn("rank", F.row_number().over(_in_order()))
    terms = source_terms(profiles, totals, best)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(*columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
    )


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS total FROM t GROUP BY lang, term HAVING count(*) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS kept, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + l.kept) AS p,
             1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.kept) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
v AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM y WHERE part = 'pair' OR rank <= 200"""


@query(_SQL)
def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
