"""Nulls, empty tables, repeats, long texts, clashing columns and damaged archives."""

import base64
import gzip
import urllib.parse
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from laborscope.llm.backoff import _steps, _unstepped, backoff_scores
from laborscope.llm.base import ship
from laborscope.llm.decontamination import mark_contamination
from laborscope.llm.jaccard_join import similar_components
from laborscope.llm.packing import pack, packed_digests, tokenizer_path
from laborscope.llm.partenum import signatures
from laborscope.llm.quality import quality_model, remainder, score_quality
from laborscope.llm.rules import judge
from laborscope.llm.secret_scan import find_secrets, redact, redact_secrets, scan_secrets
from laborscope.llm.substrings import remove_repeats
from laborscope.llm.tokens import PieceTokenizer
from laborscope.llm.toxicity import score_toxicity, stems, toxicity_model
from laborscope.llm.warc import _Damaged, _parse, read_archives, record, salvage, write_archives
from laborscope.sources.storage import work_folder
from pyspark.sql import functions as F

PROSE = "the of and to in a is that it was for on are as with his they at be this".split()


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def test_jaccard(hard, empty):
    rows = similar_components(hard).collect()
    assert len(rows) == hard.count()
    got = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3
    assert got[4, 1] == got[5, 1] == 4
    assert [c for (k, n), c in got.items() if k == 8] == [7]
    assert all(c is None for (k, _), c in got.items() if k is None)
    assert similar_components(empty).collect() == []


def test_jaccard_many_blocks(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = similar_components(docs).collect()
    many = similar_components(docs, per_block=300, per_bucket=5000).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_signatures_are_complete():
    random = np.random.default_rng(1)
    for percent in (60, 80, 85, 95):
        for _ in range(150):
            a = random.integers(0, 1 << 63, random.integers(1, 80)).astype(np.uint64)
            b = np.unique(np.concatenate([a[random.random(len(a)) < 0.93], random.integers(0, 1 << 63, 2).astype(np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            found, at = signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), percent)
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert set(found[at == 0]) & set(found[at == 1])


def random_sets(random, count, least, most):
    sizes = random.integers(least, most, count)
    return random.integers(0, (1 << 64) - 1, int(sizes.sum()), dtype=np.uint64), sizes


def test_different_sets_share_no_signatures():
    # Empty subsets are equal in many sets; a list of them grows with the corpus, its pairs with the square.
    for percent in (80, 85):
        elements, sizes = random_sets(np.random.default_rng(7), 4000, 60, 400)
        found, _ = signatures(elements, sizes, percent)
        _, counts = np.unique(found, return_counts=True)
        assert counts.max() < 20 and (counts - 1).sum() < 0.001 * len(found)


def test_signatures_of_tiny_and_uneven_sets():
    random = np.random.default_rng(2)
    assert [len(x) for x in signatures(np.empty(0, np.uint64), np.array([0, 0]), 80)] == [0, 0]
    pairs = 0
    for percent in (50, 80, 85, 90):
        for i in range(400):
            a = np.unique(random.integers(0, 1 << 63, random.integers(1, 14 if i % 2 else 300)).astype(np.uint64))
            more = random.integers(0, 1 << 63, random.integers(0, 1 + len(a) // 6)).astype(np.uint64)
            b = np.unique(np.concatenate([a[random.random(len(a)) < random.choice([0.8, 0.9, 1])], more]))
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
                pairs += 1
                found, at = signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), percent)
                assert set(found[at == 0]) & set(found[at == 1])
    assert pairs > 500


def test_families_cross_in_blocks_and_batches(spark):
    from laborscope.llm import jaccard_join

    random = np.random.default_rng(4)
    base = [random.integers(0, 1 << 62, 120) for _ in range(6)]
    rows = []
    for member in range(300):
        own = np.array(base[member % 6])
        changed = random.choice(120, random.integers(0, 12), replace=False)
        own[changed] = random.integers(0, 1 << 62, len(changed))
        own = own[: random.integers(96, 121)].astype(np.uint64)
        # Rows of one list may have sketches of two widths.
        sketch = jaccard_join._parity(own, np.array([len(own)]), 4 if len(own) < 110 else 8)[0].view(np.int64).tolist()
        for number in {member % 6, member % 4 + 10, 99}:
            rows.append((number, member, member // 2, len(own), sketch))
    sizes = {x: sum(r[0] == x for r in rows) for x in {r[0] for r in rows}}
    rows = [(r[0], sizes[r[0]], *r[1:]) for r in rows]
    schema = "list_id bigint, size bigint, member bigint, family bigint, n bigint, sketch array<bigint>"
    members = spark.createDataFrame(rows, schema)
    one, two = members.alias("x"), members.alias("y")
    both = F.col("x.n") + F.col("y.n")
    every_pair = one.join(
        two,
        (F.col("x.list_id") == F.col("y.list_id"))
        & (F.col("x.family") < F.col("y.family"))
        & (100 * F.least("x.n", "y.n") >= 80 * F.greatest("x.n", "y.n"))
        & (jaccard_join._differing("x.sketch", "y.sketch") * 180 <= both * 20),
    ).select(F.col("x.family").alias("a"), F.col("y.family").alias("b"))
    wanted = sorted(map(tuple, jaccard_join.components(every_pair).collect()))
    assert len({c for _, c in wanted}) < len(wanted) > 100
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows_of_batch, block in ((10_000, 4096), (10_000, 40), (7, 4096), (7, 40)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_of_batch)
            found = jaccard_join._crossing(members, 80, block)
            assert sorted(map(tuple, jaccard_join.components(found).collect())) == wanted
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_jaccard_by_brute_force(spark):
    # Near copies at both sides of the limit, in groups and chains, and short texts.
    random = np.random.default_rng(6)
    texts = []
    for size in (6, 9, 14, 40, 130, 400):
        base = [f"w{x}" for x in random.integers(0, 10_000, size)]
        for _ in range(25):
            own = list(base)
            for i in random.choice(size, random.integers(0, 2 + size // 40), replace=False):
                own[i] = f"x{random.integers(10_000)}"
            texts.append(" ".join(own[: size - int(random.integers(0, 2 + size // 30))]))
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    wanted = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and wanted[i] != wanted[j]:
                old, new = max(wanted[i], wanted[j]), min(wanted[i], wanted[j])
                wanted = [new if x == old else x for x in wanted]
    assert 10 < len(set(wanted)) < len(wanted) - 10
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    for sizes in ({}, {"list_block": 5, "per_bucket": 2000}):
        rows = similar_components(docs, shingle=5, percent=80, **sizes).collect()
        assert [c for _, c in sorted((r.doc_id, r.component_id) for r in rows)] == wanted


def test_packing(spark, hard, empty):
    pieces = pack(hard, tokenizer_path(), work_folder(spark, "pack")).collect()
    assert sum(r.length for r in pieces if r.start == 0 and r.doc_id in (1, 2, 3)) == 3
    assert all(len(r.ids) == 4 * r.length for r in pieces)
    assert packed_digests(empty, tokenizer_path()).collect() == []


def test_tokens_of_hard_texts():
    tokenizer = PieceTokenizer(tokenizer_path())
    texts = [
        "Aéro H̱ Å é don't I'LL x'sy 'tis l'é",
        "a≠b —*** a—** ≠ ≠ 12ab,cd 3.5e7   　 한글 a‍b",
        "<|endoftext|>x <|ENDOFTEXT|> <| |> <|startoftext|>",
        "\x1c \x85 \x00 İ ΣΑΣ Σας ǅ ſ K",
        "",
    ]
    for text in texts:
        ids = tokenizer.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokenizer.ids([text.encode()])[0], "<u4").tolist() == ids


def test_substrings(hard, empty):
    rows = remove_repeats(hard).collect()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == hard.count()
    assert got[9].n_removed == 0 and got[10].n_removed == 120 and got[10].kept == "there"
    assert got[7].n_removed == 0 and got[8].n_removed == 30_000 and got[8].kept == "end"
    assert (got[1].n_words, got[1].kept) == (0, "")
    assert remove_repeats(empty).collect() == []


def test_substrings_in_parts(spark, folder, monkeypatch):
    from laborscope.llm import substrings

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = sorted(map(tuple, remove_repeats(docs).collect()))
    monkeypatch.setattr(substrings, "TEXTS_PER_TASK", 2)
    assert sorted(map(tuple, remove_repeats(docs).collect())) == whole


def test_contamination(spark, hard, empty):
    items = [("a", "P0 p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13"), ("b", "one"), ("b", "one"), (None, "two"), ("c", None), ("d", "")]
    items = spark.createDataFrame(items, "item_id string, text string")
    for block in (1, 200_000):
        rows = mark_contamination(hard, items, block=block).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in rows}
        assert len(rows) == hard.count()
        assert got[9] == (62, 14, ["a"], True) and got[10] == (121, 28, ["a"], True)
        assert got[4] == (1, 1, ["b"], True) and got[6] == (3, 1, ["b"], True)
        assert got[1] == (0, 0, [], False)
    assert not any(r.n_hit for r in mark_contamination(hard, empty.withColumnRenamed("doc_id", "item_id")).collect())
    assert mark_contamination(empty, items).collect() == []


def test_secret_layers():
    inner = "é token = 'abcdefghijklmnop1' z"
    once = base64.b64encode(inner.encode()).decode()
    twice = base64.urlsafe_b64encode(gzip.compress(once.encode())).decode()
    url = urllib.parse.quote("password: password='x y' secret=ABCDEFGHIJKLMNOP")
    text = f"é {once} | {twice} | {url} | \\u0070assword\\u003dabcdefghijklmnopq"
    data = text.encode()
    found = [data[f.start : f.end].decode() for f in find_secrets(data) if not f.base]
    assert found == [once, twice, "secret%3DABCDEFGHIJKLMNOP", "\\u0070assword\\u003dabcdefghijklmnopq"]
    assert redact(data).decode().count("[assign]") == 4
    # A failing match takes its text with it.
    assert find_secrets(b"secret: password: abcdefghijklmnop") == []
    assert find_secrets(base64.b64encode(b"%25%32%35 nothing here at all")) == []


def test_secrets(hard, empty):
    assert all(r.secrets == [] for r in scan_secrets(hard).collect())
    clean = redact_secrets(hard)
    assert clean.columns == hard.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, hard.collect()))
    assert scan_secrets(empty).collect() == []


def test_classifiers(spark, hard, empty):
    labels = spark.createDataFrame(
        [(4, 1, 0), (7, 0, 1), (None, 1, 1), (9, None, None), (12, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    for known in (labels, labels.limit(0)):
        model = quality_model(hard, known, remainder("doc_id", 4) == 2)
        rows = score_quality(hard, model).collect()
        assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
        tox = toxicity_model(hard, known, remainder("doc_id", 3) == 1)
        assert all(0 <= r.score <= 1 for r in score_toxicity(hard, tox).collect())
    assert score_quality(empty, model).collect() == [] and score_toxicity(empty, tox).collect() == []


def test_backoff(hard, empty):
    for order in (1, 2, 3):
        rows = backoff_scores(hard, order=order, batch_bytes=100_000, table_bytes=200_000).collect()
        assert len(rows) == hard.count()
        got = {r.doc_id: r for r in rows}
        assert (got[1].n_words, got[1].score_micro) == (0, 0) and got[7].score_micro < 0
    assert backoff_scores(empty).collect() == []


def test_backoff_over_many_parts_and_batches(hard):
    def rows(**sizes):
        return sorted(map(str, backoff_scores(hard, **sizes).collect()))

    assert rows(batch_bytes=60_000, table_bytes=40_000) == rows()


def test_backoff_sends_steps_between_hashes():
    start = np.uint64(5 << 50)
    for n in (0, 1, 50_000):
        hashes = start + np.sort(np.random.default_rng(n).integers(0, 1 << 58, n).astype(np.uint64))
        packed = _steps(hashes, start)
        assert np.array_equal(_unstepped(packed, n, start), hashes)
    # A hash by itself takes eight bytes.
    assert len(packed) < 6 * n
    ends = np.array([0, 0, (1 << 64) - 1], dtype=np.uint64)
    assert np.array_equal(_unstepped(_steps(ends, np.uint64(0)), 3, np.uint64(0)), ends)


def test_rules(hard, empty):
    rows = judge(hard).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == hard.count() and got[1].base_failed and not got[1].kept and got[7].n_words == 30_000
    assert judge(empty).collect() == []


def expected_bits(texts, order):
    """Bits per byte of each text by a modified Kneser-Ney model of the others, with the discounts of all."""
    from collections import Counter, defaultdict

    from laborscope.llm.rules import _FOLD

    folded = [bytes(_FOLD[np.frombuffer(b" " * (order - 1) + t, np.uint8)]) for t in texts]
    own = [Counter(t[i : i + order] for i in range(len(t) - order + 1)) for t in folded]

    def tables(counts):
        out = {order: Counter({g: n for g, n in counts.items() if n > 0})}
        for k in range(order - 1, 0, -1):
            out[k] = Counter(g[1:] for g in out[k + 1])
        return out

    every = sum(own, Counter())
    discounts = {}
    for k, counts in tables(every).items():
        n = [sum(c == i for c in counts.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        rates = [0.0]
        for i in (1, 2, 3):
            value = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0
            rates.append(value if 0 < value < i else 0.5 * i)
        discounts[k] = rates
    out = []
    for t, mine in zip(folded, own):
        left = tables(every - mine)
        sums = {}
        for k, counts in left.items():
            sums[k] = defaultdict(lambda: [0, 0.0])
            for g, n in counts.items():
                sums[k][g[:-1]][0] += n
                sums[k][g[:-1]][1] += discounts[k][min(n, 3)]

        def p(g):
            if not g:
                return 1 / 256
            total, discount = sums[len(g)][g[:-1]]
            if not total:
                return p(g[1:])
            n = left[len(g)][g]
            return (n - discounts[len(g)][min(n, 3)]) / total + discount / total * p(g[1:])

        grams = [t[i : i + order] for i in range(len(t) - order + 1)]
        out.append(-sum(np.log2(p(g)) for g in grams) / len(grams) if grams else None)
    return out


def test_bits_without_a_texts_own_counts(spark):
    random = np.random.default_rng(3)
    texts = [" ".join(random.choice(PROSE, random.integers(1, 25))) for _ in range(40)]
    texts += ["", "a", "a", "12 34\n56\t7", "só é\u00e3o", "#" * 30, texts[0], texts[0] + " more", "xyz xyz qq", "the"]
    rows = [(i, t, None if i % 5 == 0 else "en" if i % 5 < 4 else "") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for order in (2, 5):
        # Batches of a few texts, and one of all.
        for size in (200, 1 << 26):
            found = {r.doc_id: (r.lang, r.bits) for r in judge(docs, order=order, batch_bytes=size).collect()}
            for lang in (None, "", "en"):
                own = [(i, t.encode()) for i, t, x in rows if x == lang]
                for (i, _), wanted in zip(own, expected_bits([t for _, t in own], order)):
                    assert found[i][0] == lang
                    assert (found[i][1] is None) == (wanted is None)
                    assert wanted is None or abs(found[i][1] - wanted) < 1e-9


def archive(*payloads):
    made = [record(f"urn:page:{i}", "http://x", "response", p) for i, p in enumerate(payloads)]
    return made, [gzip.compress(x) for x in made]


def read(data):
    return list(salvage(pa.BufferReader(data), len(data)))


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(packed):
    plain, members = archive(*(bytes([65 + i]) * 5000 for i in range(6)))
    parts = members if packed else plain
    bad = bytearray(parts[2])
    bad[len(bad) // 2] ^= 0xFF
    data = parts[0] + b"noise" + parts[1] + bytes(bad) + parts[3] + parts[4] + parts[5][:-30]
    found = read(data)
    ids = [h["warc-record-id"] for _, _, h, _, _ in found if h]
    assert ids == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    gaps = [(a, b) for a, b, h, _, _ in found if h is None]
    one = len(parts[0])
    two = one + 5 + len(parts[1])
    assert gaps == [(one, one + 5), (two, two + len(bad)), (len(data) - len(parts[5]) + 30, len(data))]
    # Records and gaps cover the file without overlap.
    assert [a for a, *_ in found] == [0, *(b for _, b, *_ in found[:-1])]


def test_salvage_of_nothing():
    assert read(b"") == []
    assert [(a, b) for a, b, *_ in read(b"no archive at all")] == [(0, 17)]
    with pytest.raises(_Damaged):
        _parse(b"WARC/1.1\r\nContent-Length: x\r\n\r\n")


def test_archives(spark):
    rows = [(1, None, None), (2, "u\r\nv", ""), (3, "u", "é" * 600), (5, "w", "é" * 600), (4, "x", "é" * 600), (None, "y", "z" * 2000), (7, "y", "z" * 2000), (8, "s", "tiny"), (9, "s", "tiny")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id bigint, url string, html string, path int")
    files = write_archives(pages, "file://" + work_folder(spark, "archives"), file_bytes=1000)
    got = {(r.record_id, r.record_type): (r.payload_bytes, r.refers_to, r.problem) for r in read_archives(files).collect()}
    assert len(got) == len(rows)
    assert got["urn:page:3", "revisit"] == (1200, "urn:page:5", None)
    assert got["urn:page:5", "response"] == (1200, None, None)
    assert got["urn:page:7", "response"][0] == 2000 and got["urn:page:9", "response"][0] == 4
    assert read_archives(files.limit(0)).collect() == []
    assert read_archives(write_archives(pages.limit(0), "file://" + work_folder(spark, "none"))).collect() == []


def test_rules_reject_junk(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    random = np.random.default_rng(5)
    junk = [
        (-1 - i, "".join(" \n"[int(x > 40)] if x >= 38 else chr(33 + x) for x in random.integers(0, 42, 1500)), "en")
        for i in range(3)
    ]
    rows = judge(docs.unionAll(spark.createDataFrame(junk, docs.schema))).collect()
    planted = [r for r in rows if r.doc_id < 0]
    assert len(planted) == 3 and not any(r.base_failed or r.kept for r in planted)


def test_bits_leave_out_the_own_text(spark):
    from laborscope.llm.rules import ORDER

    prose = [(i, " ".join(PROSE[(i * j + j * j) % 20] for j in range(80)), "en") for i in range(30)]
    # The same junk often in one text: by its own counts it would be the easiest of all.
    rows = judge(spark.createDataFrame([*prose, (99, "#|@~ " * 2000, "en")], "doc_id bigint, text string, lang string")).collect()
    bits = {r.doc_id: r.bits for r in rows}
    assert ORDER == 5 and bits[99] > 2 * max(v for k, v in bits.items() if k != 99)


def test_bits_know_every_ngram(spark):
    # A language with a thousandth of the corpus is judged by all of its 5-grams.
    small = [(i, "qzxv wkjy " * 12, "xx") for i in range(3)]
    large = [(100 + i, " ".join(PROSE[(i * j + j * j) % 20] for j in range(1500)), "en") for i in range(60)]
    docs = spark.createDataFrame(small + large * 6, "doc_id bigint, text string, lang string")
    for batch in (1 << 24, 30_000):
        bits = [r.bits for r in judge(docs, batch_bytes=batch).collect() if r.lang == "xx"]
        assert len(bits) == 3 and max(bits) < 0.2


def test_layers_of_any_size():
    secret = b"password%3Dabcdefghijklmnop"
    long = b"lorem ipsum, dolor. " * 3_500_000
    assert [f.start for f in find_secrets(long + secret)] == [len(long)]
    # The last of 80 MB that are expanded, in two steps.
    inner = gzip.compress(gzip.compress(b"no secret, " * 7_300_000 + b"password=abcdefghijklmnop"))
    found = find_secrets(b"x " + base64.b64encode(inner))
    assert [(f.start, f.kind) for f in found] == [(2, 0)]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n  "])
def test_wrapped_base64(end):
    plain = b"some words before it, " * 6 + b"token=abcdefghijklmnopq" + b" and more words, " * 9
    noise = bytes(range(256)) * 3
    for inner in (plain, gzip.compress(noise + plain), zlib.compress(noise + plain), zstandard.compress(noise + plain)):
        block = base64.encodebytes(inner).decode().strip().replace("\n", end)
        data = f"see: {block} !".encode()
        assert (5, 0, 5 + len(block)) in [(f.start, f.kind, f.end) for f in find_secrets(data)]


@pytest.mark.parametrize("mark", ["\x00", "﻿", "​", "\x1b[0m"])
def test_layers_with_unprintable_characters(mark):
    data = base64.b64encode(f"{mark} password=abcdefghijklmnop {mark}".encode())
    assert [(f.start, f.end) for f in find_secrets(data)] == [(0, len(data))]


def test_compressed_bytes_in_escapes():
    packed = gzip.compress(b"password=abcdefghijklmnop, and so on")
    for form in ("%{:02X}", "\\x{:02x}"):
        data = b"a " + "".join(form.format(x) for x in packed).encode() + b" z"
        assert [(f.start, f.kind, f.end) for f in find_secrets(data)] == [(2, 0, len(data) - 2)]


def test_stems_read_every_character():
    def of(text):
        hashes, first = stems([b"before", text.encode(), b"after"])
        return hashes[first[1] : first[2]].tolist()

    chinese = "".join(chr(0x4E00 + 7 * i) for i in range(40))
    pieces = of(chinese)
    assert len(pieces) == 37
    for i in range(40):
        # Any one character changes the pieces that it is in, and no other.
        changed = of(chinese[:i] + "龍" + chinese[i + 1 :])
        assert [a != b for a, b in zip(pieces, changed)] == [i - 3 <= j <= i for j in range(37)]
    assert of(chinese[:4] + "，" + chinese[4:8]) == of(chinese[:4] + " " + chinese[4:8])
    assert of("pathetic") != of("path") and of("idiot") != of("idiom")
    assert of("Word, word") == of("word word") and len(of("one two")) == 2
    assert of("") == []


def test_stems_of_any_script():
    import time
    import unicodedata

    from laborscope.llm.toxicity import _separators

    separators = _separators()
    for c in range(0x80, 0x110000):
        assert (c in separators) == (unicodedata.category(chr(c))[0] in "ZPS")
    text = ("Über die größten Straßen fährt täglich ein grüner Zug nach Köln; „schön“ — sagt Jörg. " * 12_000).encode()
    stems([text[:1000]])
    began = time.perf_counter()
    hashes, first = stems([text])
    assert len(text) > 1_000_000 and time.perf_counter() - began < 1
    one, _ = stems([text[: len(text) // 12_000]])
    assert first.tolist() == [0, 12_000 * len(one)] and (hashes[: len(one)] == one).all()


def test_dictionaries_follow_one_rule():
    from laborscope.llm.toxicity import _dictionaries

    plain = [f"the quiet house on the hill {w}".encode() for w in ("calm", "garden") * 20]
    rude = [f"the quiet house on the hill {w}".encode() for w in ("awful", "nasty") * 20]
    toxic = np.array([False] * 40 + [True] * 40)
    a, b = _dictionaries(plain + rude, toxic)
    c, d = _dictionaries(rude + plain, toxic)
    assert len(a) == len(b) and (a, b) == (d, c) and a != b


@pytest.mark.parametrize("before", ["x", "x/", "ab+", "-", "x/y_z", "path/to/"])
def test_base64_after_characters_of_its_own(before):
    secret = b"AKIA" + b"ABCDEFGH12345678XYZ"
    inner = base64.b64encode(b"key " + secret + b" end").decode()
    packed = base64.b64encode(gzip.compress(b"key " + secret + b" end" * 9)).decode()
    for payload in (inner, packed):
        text = f"see {before}{payload}, and more".encode()
        found = [f for f in find_secrets(text) if f.kind == 1]
        assert found and all(text[f.start : f.end].decode() in before + payload for f in found)


def read_all(data):
    return list(salvage(pa.BufferReader(data), len(data)))


def pages_of(found):
    return [h["warc-record-id"] for _, _, h, _, _ in found if h]


def test_members_of_many_records():
    made = [record(f"urn:page:{i}", "http://x", "response", b"body %d " % i * 50) for i in range(6)]
    names = [f"<urn:page:{i}>" for i in range(6)]
    two = gzip.compress(made[0] + made[1])
    data = two + gzip.compress(made[2]) + made[3] + gzip.compress(b"".join(made[4:]))
    found = read_all(data)
    assert pages_of(found) == names and not any(p for *_, p in found)
    assert found[0][0] == found[1][0] == 0 and found[1][1] == len(two) == found[2][0]
    # A whole archive as one member, over many pieces.
    many = b"".join(record(f"urn:page:{i}", "http://x", "response", b"%d" % i * 9000) for i in range(400))
    assert len(pages_of(read_all(gzip.compress(many)))) == 400
    # Bytes between records of a member, and after them, are gaps.
    found = read_all(gzip.compress(made[0] + b"junk junk" + made[1] + b"more junk") + made[2])
    assert pages_of(found) == names[:3] and sum(h is None for _, _, h, _, _ in found) == 2
    # A member that breaks off keeps the records before; the next one is found.
    broken = gzip.compress(b"".join(made[:3]) + np.random.default_rng(1).bytes(90_000))
    for damaged in (broken[:-50_000], broken[:-50_000] + b"\x00" * 50_000):
        found = read_all(damaged + gzip.compress(made[3]))
        assert pages_of(found) == names[:4] and any(h is None for _, _, h, _, _ in found)
    # A member without any record is one gap.
    found = read_all(gzip.compress(b"nothing here") + made[0])
    assert [h is None for _, _, h, _, _ in found] == [True, False]


def test_digests_of_other_kinds(spark, tmp_path):
    import hashlib

    body = b"some body " * 30
    plain = record("urn:page:1", "http://x", "response", body)
    line = next(x for x in plain.split(b"\r\n") if x.startswith(b"WARC-Payload-Digest"))
    told = {
        "sha256:" + hashlib.sha256(body).hexdigest(): True,
        "sha-256:" + base64.b32encode(hashlib.sha256(body).digest()).decode(): True,
        "sha1:" + hashlib.sha1(body).hexdigest().upper(): True,
        "md5:" + hashlib.md5(body).hexdigest(): True,
        "blake3:abc": True,
        "sha1:not a digest": True,
        "sha256:" + hashlib.sha256(b"other").hexdigest(): False,
        "sha1:" + hashlib.sha1(b"other").hexdigest(): False,
    }
    for value, intact in told.items():
        data = plain.replace(line, b"WARC-Payload-Digest: " + value.encode())
        assert [h is not None for _, _, h, _, _ in read_all(data)] == [intact], value
    # Revisits with digests and lengths that can't be read have none.
    revisit = record("urn:page:2", "http://x", "revisit", body, "urn:page:1")
    files = []
    for i, (digest, length) in enumerate([(b"sha256:" + b"ab" * 32, b"300"), (b"sha1:???", b"many"), (b"none", b"1 2")]):
        data = revisit.replace(line, b"WARC-Payload-Digest: " + digest).replace(b"Content-Length: 300\r\n\r\n", b"Content-Length: " + length + b"\r\n\r\n")
        head, _, block = data.partition(b"\r\n\r\n")
        lengths = [x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")]
        data = data.replace(lengths[0], b"Content-Length: %d" % (len(block) - 4), 1)
        path = tmp_path / f"{i}.warc"
        path.write_bytes(data)
        files.append((f"file://{path}",))
    rows = read_archives(spark.createDataFrame(files, "path string")).orderBy("path").collect()
    assert [(r.record_type, r.payload_digest, r.payload_bytes) for r in rows] == [
        ("revisit", None, 300), ("revisit", None, None), ("revisit", None, None),
    ]
