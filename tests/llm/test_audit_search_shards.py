"""Divergence audit, ranked search and sharding on hard rows, and against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from laborscope.llm.base import ship
from laborscope.llm.catalog import QUERIES
from laborscope.llm.divergence import audit, price_tables, shares
from laborscope.llm.search import Stratified, ranked_search
from laborscope.llm.sharding import LARGE, assign_shards, levelled, write_shards
from pyspark.sql import functions as F

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
ALPHANUMERIC = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def expected_audit(rows):
    """``rows`` of text, lang and source."""
    counts, texts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = LETTERS.findall(lowered(text))
        counts[lang, source].update(terms)
        texts[lang].update(set(terms))
        langs[lang].update(terms)
    out = []
    for (lang, source), own in counts.items():
        kept = [t for t, n in texts[lang].items() if n >= 3]

        def p(group, t):
            return 1 + 10**9 * (group[t] + 1) // (sum(group[x] for x in kept) + len(kept))

        def f(a, b):
            return (a - b) ** 2 // b

        found = {"pair": [], "term": []}
        for (other_lang, item), other in counts.items():
            if other_lang == lang and item != source:
                found["pair"].append((item, sum(f(p(own, t), p(other, t)) for t in kept)))
        for t in kept:
            if own[t] and p(own, t) > p(langs[lang], t):
                found["term"].append((t, f(p(own, t), p(langs[lang], t))))
        for part, items in found.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            for rank, (item, value) in enumerate(items, 1):
                if part == "pair" or rank <= 200:
                    out.append((lang, source, part, item, value, rank))
    return sorted(out)


def test_audit_of_hard_rows(spark, hard, empty):
    rows = [
        ("b a a c", "en", "s1"), ("a b É é", "en", "s2"), ("A B 12 x3x é", "en", None), ("é É x", "en", "s1"),
        (None, "en", "silent"), (" ", None, None), ("b b", None, "s1"), ("B", "", "s2"), ("b", "", "s1"),
        ("only here", "xx", "alone"), ("b a a c", "en", "s1"),
    ] * 2
    names = "text string, lang string, source string, rank int, value string, part string"
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], names)
    plain = [(t, lang or "", s or "") for t, lang, s in rows]
    assert sorted(map(tuple, audit(docs).collect())) == expected_audit(plain)
    small = hard.collect()
    got = sorted(map(tuple, audit(hard).collect()))
    assert got == expected_audit([(r.text, r.lang or "", r.source or "") for r in small])
    assert audit(empty).collect() == []


def test_price_tables_are_exact():
    random = np.random.default_rng(5)
    # Levels from rare to huge, in more rows than one block has.
    p = 1 + random.zipf(1.3, (6000, 7)).astype(np.int64) % 10**9
    value = price_tables(p)
    for a in range(7):
        for b in range(7):
            wanted = sum((x - y) ** 2 // y for x, y in zip(p[:, a].tolist(), p[:, b].tolist())) if a != b else 0
            assert value[a, b] == wanted


def test_shares_beyond_64_bits():
    count, total = np.array([0, 5, 3 * 10**12]), np.array([7, 7, 4 * 10**12])
    assert shares(count, total).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(count.tolist(), total.tolist())]


def expected_search(docs, items, k):
    counts = [(key, Counter(ALPHANUMERIC.findall(lowered(text)))) for key, text in docs]
    held = [sum(c.values()) for _, c in counts]
    texts, total = sum(n > 0 for n in held), sum(held)
    holders = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (key, c), n in zip(counts, held):
            score = 0
            for t in set(ALPHANUMERIC.findall(lowered(text))) & set(c):
                m = 50 + 50 * n * texts // total
                weight = math.floor(1000 * math.log((2 * texts + 2) / (2 * holders[t] + 1)))
                score += weight * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, key is not None, key, score))
        for rank, (_, _, key, score) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, key, score))
    return sorted(out, key=str)


def test_search_of_hard_rows(spark, hard, empty):
    items = [(1, "One TWICE same key p7 ünï"), (1, "the of and this"), (2, None), (3, "  "), (None, "row twice p59 p1")]
    queries = spark.createDataFrame([(*r, 5, "x") for r in items], "item_id bigint, text string, doc_id int, score string")
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    for k in (1, 2, 50):
        # Small parts cut strata; small blocks of terms mean more scans.
        for size, block in ((4_000_000, 2_000_000), (30, 4)):
            got = ranked_search(hard, queries, k=k, part_pairs=size, block_terms=block).collect()
            assert sorted(map(tuple, got), key=str) == expected_search(docs, items, k)
    assert ranked_search(empty, queries).collect() == []
    assert ranked_search(hard, queries.limit(0)).collect() == []


def test_search_over_many_parts(spark, folder, documents):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = ranked_search(docs, items, part_pairs=500).collect()
    wanted = QUERIES["op12_search"](spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))


def test_strata_left_out_cost_no_result():
    random = np.random.default_rng(2)
    for _ in range(20):
        rows, size = 400, 30
        m = random.integers(50, 60 + random.integers(1, 3000), rows)
        held = random.random((rows, size)) < 0.3
        row, terms = np.nonzero(held)
        counts = random.zipf(1.8, len(row)).astype(np.int64) % 1000 + 1
        weights = random.integers(1, 9000, size)
        index = Stratified(terms, counts, row, m, size)
        scores = np.zeros(rows, dtype=np.int64)
        np.add.at(scores, row, weights[terms] * (10**9 * counts // (1000 * counts + 20 * m[row])))
        found, score = index.best(np.arange(size), weights, 10)
        wanted = sorted(range(rows), key=lambda i: (-scores[i], i))[:10]
        assert found.tolist() == wanted and score.tolist() == scores[wanted].tolist()


def check_shards(rows, shards, sizes):
    own = defaultdict(list)
    for r in rows:
        own[r["shard"]].append(r)
    loads = []
    for s in range(shards):
        assert sorted(r["slot"] for r in own[s]) == list(range(len(own[s])))
        loads.append(sum(r["size"] for r in own[s]))
    assert set(own) <= set(range(shards)) and sum(loads) == sum(sizes)
    # No record is larger than a share here, or it is alone with its load.
    share = sum(sizes) / shards
    level = max(share, max(sizes, default=0))
    assert max(loads) <= level + share / LARGE * 2 + 1
    return loads


def test_op13(spark, folder, documents):
    rows = QUERIES["op13_sharding"](spark, folder).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    for r in rows:
        data = documents[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert r.law == "bytes" and r.grown_shard is None
    check_shards(rows, 24, [r.size for r in rows])


@pytest.mark.parametrize("range_rows", [3, 40, 100_000])
def test_shards_of_hard_rows(spark, hard, empty, range_rows):
    # One text and key in a third of all rows, and records larger than a share.
    many = hard.unionByName(spark.range(300).selectExpr("1L AS doc_id", "'same text' AS text"), allowMissingColumns=True)
    many = many.unionByName(spark.range(600).selectExpr("id AS doc_id", "repeat('x', int(id)) AS text"), allowMissingColumns=True)
    rows = assign_shards(many, shards=7, range_rows=range_rows).collect()
    assert len(rows) == many.count() and len({r.row for r in rows}) == len(rows)
    check_shards(rows, 7, [r.size for r in rows])
    assert assign_shards(empty, range_rows=range_rows).collect() == []
    assert [(r.shard, r.slot) for r in assign_shards(hard.limit(1), range_rows=range_rows).collect()] == [(0, 0)]


def test_levels():
    assert levelled([0, 0, 0], 10) == [4, 3, 3]
    assert levelled([100, 0, 4], 10) == [0, 7, 3]
    assert levelled([5, 5], 0) == [0, 0]


def test_written_shards(spark, hard, tmp_path):
    write_shards(hard, str(tmp_path / "shards"), shards=3, rows_per_file=2)
    written = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(str, written.select(*hard.columns).collect())) == sorted(map(str, hard.collect()))
    slots = written.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r.s == list(range(len(r.s))) for r in slots)
