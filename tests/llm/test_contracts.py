"""Every registered query against SQL or a brute-force version."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from laborscope.llm.catalog import QUERIES, SQL
from laborscope.llm.packing import cuts, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, folder, database, name):
    result = QUERIES[name](spark, folder)
    expected = database.sql(SQL[name]).to_arrow_table()
    columns = sorted(result.columns)
    assert columns == sorted(expected.column_names)
    got = sorted(str([r[c] for c in columns]) for r in result.collect())
    assert got == sorted(str([r[c] for c in columns]) for r in expected.to_pylist())


def components(texts, size, percent):
    sets = {}
    for key, text in texts.items():
        w = text.encode().lower().split()
        sets[key] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    holders = defaultdict(list)
    for key, own in sets.items():
        for s in own:
            holders[s].append(key)
    shared = Counter((a, b) for own in holders.values() for i, a in enumerate(own) for b in own[:i])
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: (len(sets[k]), find(k)) for k in texts}


def test_op1(spark, folder, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_jaccard"](spark, folder).collect()}
    assert got == components(documents, 4, 85)


def test_op3(spark, folder, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op3_packing"](spark, folder).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(documents)
    for key, text in documents.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            own = struct.pack(f"<{r.length}I", *ids[at : at + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(own))
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 0.03 * total


def test_cuts_are_whole():
    for total in (1, 2, 255, 256, 257, 1000, 4095, 4096, 4097, 20_000):
        assert sum(cuts(total)) == total and max(cuts(total)) <= 4096


def test_op6(spark, folder, documents):
    kinds = {
        "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
        "access": (r"AKIA[A-Z0-9]+", 18, 0),
        "hex": (r"[0-9a-f]+", 16, 0),
    }
    for r in QUERIES["op6_secrets"](spark, folder).collect():
        found = []
        for i, (kind, (pattern, least, group)) in enumerate(kinds.items()):
            own = [m for m in re.finditer(pattern, documents[r.doc_id], re.ASCII) if len(m[group]) >= least]
            assert r[f"n_{kind}"] == len(own)
            found += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in own]
        joined = ",".join(x for *_, x in sorted(found))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert {x for x in joined.split(",") if x} <= set(r.spans.split(","))


def held_out(spark, folder, name, label, rest, of):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES[name](spark, folder).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == rest)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    return np.mean([a == b for a, b in judged])


def test_op7(spark, folder):
    assert held_out(spark, folder, "op7_quality", "quality", 2, 4) >= 0.9


def test_op8(spark):
    assert held_out(spark, "/root/testdata/sf0.01", "op8_toxicity", "toxic", 1, 3) >= 0.9


def test_op10(spark, folder, documents):
    kept = 0
    rows = QUERIES["op10_rules"](spark, folder).collect()
    for r in rows:
        text = documents[r.doc_id]
        w = WORD.findall(text)
        windows = list(zip(w, w[1:], w[2:]))
        count = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (
            len(w),
            sum(map(len, w)),
            len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)),
            len(covered),
        )
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)
        kept += r.kept
    assert kept > 0.9 * sum(not r.base_failed for r in rows)


def test_pipeline(spark, folder, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before, seen = {r.doc_id: r.text for r in docs.collect()}, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) <= set(before)
            if name == "n-gram Jaccard join":
                groups = components({k: v or "" for k, v in before.items()}, 5, 80)
                assert set(after) == {root for _, root in groups.values()}
            if name == "secret scans":
                assert set(after) == set(before)
            seen.append(len(after))
            before = after
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert seen[0] > 0.8 * len(documents)
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(before)


def test_pipeline_on_hard_and_empty_tables(spark, folder, hard, empty):
    """Each stage by itself, with nulls, repeated rows and columns named like results."""
    import corpus_pipeline

    ids = sorted((str(r.doc_id) for r in hard.collect()))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == []
        result = stage(spark, hard, folder)
        if name == "packing":
            pieces = result.collect()
            assert sum(r.start == 0 for r in pieces) == len(ids)
            continue
        rows = result.collect()
        assert result.columns == corpus_pipeline.COLUMNS
        kept = sorted(str(r.doc_id) for r in rows)
        if name == "n-gram Jaccard join":
            # 10 has 9's passage twice, 56 of 63 shingles. Rows without id and rows of an id that repeats stay.
            assert set(kept) == set(ids) - {"5", "8", "10"} and kept.count("12") == kept.count("None") == 2
        if name == "secret scans":
            assert kept == ids
        assert set(kept) <= set(ids)


def contaminated(texts, items):
    """Ids of documents of which a twentieth of the words, or more, lies in windows of items."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def words(text):
        return word.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))

    windows = set()
    for text in items:
        w = words(text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(x) for x in windows}
    out = set()
    for key, text in texts.items():
        w = words(text)
        hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(n)}
        if hit and 20 * len(hit) >= len(w):
            out.add(key)
    return out


def test_decontamination_stage(spark, folder, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, folder).collect()}
    assert kept == set(documents) - contaminated(documents, items)
