"""Exact n-gram Jaccard join by PartEnum signatures, with connected components.

1. Every text becomes the set of its shingle hashes. Equal sets form a class,
   of which only the smallest key goes on.
2. Signatures (see :mod:`partenum`) are dealt to buckets by their hash, packed
   per slice of rows. In a bucket, sets that share a signature form a list. A
   list gives one pair of each member with its smallest one, not all pairs.
3. Similar pairs, estimated by a parity sketch of 1024 bits or more, join sets to families.
   Two members of one list in different families are a candidate pair only if
   their sketches leave it possible (parity bits never exceed the true
   difference), and then their families are merged. So every two sets that can
   be linked end up in one family, and each set belongs to one family only.
   Lists are compared in tasks, a long one in tasks per pair of blocks; families
   that the task has merged already are not compared again.
4. A family's texts meet in one task, or in tasks per pair of blocks if it is
   large. Members are compared by sketch, then exactly, unless a chain of links
   already connects them; at most one link per member is written.
5. The components of the links, with all members of each class, are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import annotate, query, table
from laborscope.llm.graph import components
from laborscope.llm.partenum import sets_of, signatures
from laborscope.llm.words import NOT_SPACE, mixed, shingles, slices, words

SHINGLE = 4
PERCENT = 85
#: A sketch has at most this many 64-bit words, halved for each halving below ``SKETCHED_FEW``
#: shingles, and doubled for each doubling beyond ``SKETCHED``.
SKETCH_WORDS = 16
SKETCHED_FEW = 512
SKETCHED = 2000
#: Shingles per bucket of signatures, and per block of a family.
PER_BUCKET = 1_000_000
PER_BLOCK = 4_000_000
#: Signatures of some slices of a task that are packed together.
PACKED = 1_000_000
#: Sketches at least this similar, in percent, join two sets of a list to a family.
FAMILY_PERCENT = 60
#: Members of a list in one task, or in each of two blocks of a larger list.
LIST_BLOCK = 4096
#: Pairs, and words of sketches, that are compared at once.
PAIRS = 1 << 16
WORDS = 1 << 18


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text one after another, and how many each has.

    A text of fewer words has its whole word sequence as its only shingle.
    """
    w = words(texts, NOT_SPACE, lower=True)
    row = w.rows()
    found, rows = [], []
    for n in range(1, size + 1):
        hashes, whole = shingles(w, n)
        if n < size:
            whole = whole & (w.counts[row] == n)
        found.append(hashes[whole])
        rows.append(row[whole])
    return sets_of(np.concatenate(found), np.concatenate(rows), len(texts))


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _digests(elements: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    seeds = (np.uint64(0xA076_1D64_78BD_642F), np.uint64(0xE703_7ED1_A0B4_28DB))
    return [mixed(_sums(mixed(elements ^ seed), bounds)) for seed in seeds]


def _parity(elements: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Per set, a bit per bucket of elements: whether their number is odd."""
    bits = width * 64
    at = np.repeat(np.arange(len(sizes)), sizes) * bits + (mixed(elements) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(sizes) * bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64).reshape(len(sizes), width)


def sketch_words(size: int) -> int:
    if size <= SKETCHED_FEW:
        return max(2, SKETCH_WORDS >> (SKETCHED_FEW // max(1, size)).bit_length() - 1)
    return SKETCH_WORDS << max(0, (size - 1) // SKETCHED).bit_length()


def describe_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, sketch`` per row."""

    def prepare():
        def compute(texts: list[bytes]) -> list:
            elements, sizes = shingle_sets(texts, size)
            bounds = _bounds(sizes)
            d1, d2 = _digests(elements, bounds)
            sketches = [
                _parity(elements[a:b], np.array([b - a]), sketch_words(int(b - a)))[0].view(np.int64)
                for a, b in zip(bounds, bounds[1:])
            ]
            return [
                pa.array(sizes, pa.int64()),
                pa.array(d1.view(np.int64)),
                pa.array(d2.view(np.int64)),
                pa.array(sketches, pa.list_(pa.int64())),
            ]

        return compute

    fields = "n_shingles bigint, d1 bigint, d2 bigint, sketch array<bigint>"
    chosen = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return annotate(chosen, "text", fields, prepare, ["doc_id"])


def signature_lists(docs: DataFrame, key: str, text: str, size: int, percent: int, buckets: int) -> DataFrame:
    """``list_id, a, b``: pairs of a set and the smallest of its list; for lists of
    three or more also every member ``a``, with ``list_id`` and no ``b``."""
    chosen = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    ).filter(F.col("doc_id").isNotNull())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, many = [], 0
        for part, texts in slices(batches):
            elements, sizes = shingle_sets(texts, size)
            ids = part.column("doc_id").to_numpy()
            # Equal sets of a slice: the smallest key stands for all.
            d1, d2 = _digests(elements, _bounds(sizes))
            order = np.lexsort((ids, d2, d1))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
            one = np.zeros(len(ids), dtype=bool)
            one[order[new]] = True
            kept = np.repeat(one, sizes)
            ids, elements, sizes = ids[one], elements[kept], sizes[one]
            found, at = signatures(elements, sizes, percent)
            gathered.append((found, at, ids))
            many += len(found)
            # Rows to shuffle are slices times buckets; some slices together make fewer.
            if many >= PACKED:
                yield packed_rows(gathered)
                gathered, many = [], 0
        if many:
            yield packed_rows(gathered)

    def packed_rows(gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        before = _bounds(np.array([len(keys) for _, _, keys in gathered]))
        found = np.concatenate([f for f, _, _ in gathered])
        at = np.concatenate([(at + n).astype(np.int32) for (_, at, _), n in zip(gathered, before)])
        ids = np.concatenate([keys for _, _, keys in gathered])
        bucket = ((found >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, found, at = bucket[order], found[order], at[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        numbers, hashes, owners = [], [], []
        for a, b in zip(cut, [*cut[1:], len(bucket)]):
            numbers.append(int(bucket[a]))
            hashes.append(found[a:b].tobytes())
            # Keys once, then two or four bytes per signature.
            own, place = np.unique(at[a:b], return_inverse=True)
            kind = np.uint16 if len(own) < 1 << 16 else np.uint32
            owners.append(np.int64(len(own)).tobytes() + ids[own].tobytes() + place.astype(kind).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(hashes, pa.binary()), pa.array(owners, pa.binary())],
            names=["bucket", "hashes", "owners"],
        )

    def lists(parts: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        found = np.concatenate([np.frombuffer(h, np.uint64) for h, _ in parts])
        owner = []
        for h, o in parts:
            n = int(np.frombuffer(o, np.int64, 1)[0])
            kind = np.uint16 if n < 1 << 16 else np.uint32
            keys = np.frombuffer(o, np.int64, n, 8)
            owner.append(keys[np.frombuffer(o, kind, len(h) // 8, 8 + 8 * n)])
        owner = np.concatenate(owner)
        order = np.lexsort((owner, found))
        found, owner = found[order], owner[order]
        begin = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        count = np.diff(np.append(begin, len(found)))
        first = np.repeat(owner[begin], count)
        member = first != owner
        pairs = np.unique(np.column_stack([first[member], owner[member]]), axis=0)
        # Lists with the same members count once.
        digest = _sums(mixed(owner.view(np.uint64)), np.append(begin, len(found)))
        long = np.flatnonzero(count >= 3)
        digest, once = np.unique(digest[long], return_index=True)
        long = long[once]
        step = np.arange(int(count[long].sum())) - np.repeat(np.cumsum(count[long]) - count[long], count[long])
        members = owner[np.repeat(begin[long], count[long]) + step]
        number = np.concatenate([np.zeros(len(pairs), np.int64), np.repeat(digest, count[long]).view(np.int64)])
        none = pa.nulls(len(members), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(number),
                pa.array(np.concatenate([pairs[:, 0], members])),
                pa.concat_arrays([pa.array(np.ascontiguousarray(pairs[:, 1])), none]),
            ],
            names=["list_id", "a", "b"],
        )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            for number, h, o in zip(*(c.to_pylist() for c in batch.columns)):
                if number != current and parts:
                    yield lists(parts)
                    parts = []
                current = number
                parts.append((h, o))
        if parts:
            yield lists(parts)

    packed = chosen.mapInArrow(pack, "bucket int, hashes binary, owners binary")
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(match, "list_id bigint, a bigint, b bigint")


def _bits(a: Column, b: Column) -> Column:
    words = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(words, F.lit(0), lambda t, x: t + x)


def _folded(a: Column) -> Column:
    """The sketch of half the width."""
    half = (F.size(a) / 2).cast("int")
    return F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _differing(a: str, b: str) -> Column:
    """Differing parity bits; sets whose sketches are two widths apart cannot be similar."""
    one, two = F.col(a), F.col(b)
    return (
        F.when(F.size(one) == F.size(two), _bits(one, two))
        .when(F.size(one) == 2 * F.size(two), _bits(_folded(one), two))
        .when(2 * F.size(one) == F.size(two), _bits(one, _folded(two)))
        .otherwise(F.lit(2**31 - 1))
    )


def _estimate(bits: Column, width: Column) -> Column:
    """Expected difference behind so many differing parity bits."""
    most = width * 64.0
    return -(most / 2) * F.log(1 - F.least(2 * bits / most, F.lit(0.999)))


class _Merged:
    """Families that a task has merged."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, family: int) -> int:
        parent = self.parent
        while (up := parent.get(family, family)) != family:
            parent[family] = family = parent.get(up, up)
        return family

    def merge(self, one: int, two: int) -> bool:
        """Whether they weren't merged before."""
        one, two = self.root(one), self.root(two)
        if one != two:
            self.parent[max(one, two)] = min(one, two)
        return one != two


def _sketch_bits(flat: np.ndarray, first: np.ndarray, width: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Differing parity bits of rows ``one`` and ``two``, as :func:`_differing` counts them."""
    swap = width[one] > width[two]
    one, two = np.where(swap, two, one), np.where(swap, one, two)
    out = np.full(len(one), 2**31 - 1, dtype=np.int64)
    for w in np.unique(width[one]):
        step = np.arange(w)
        for double in (False, True):
            chosen = np.flatnonzero((width[one] == w) & (width[two] == w * (1 + double)))
            most = max(1, WORDS // int(w))
            for at in (chosen[i : i + most] for i in range(0, len(chosen), most)):
                other = first[two[at], None] + step
                sketch = flat[other] ^ flat[other + w] if double else flat[other]
                sketch ^= flat[first[one[at], None] + step]
                out[at] = np.bitwise_count(sketch).sum(axis=1, dtype=np.int64)
    return out


def _possible_merges(part: pa.Table, percent: int, merged: _Merged) -> list[tuple[int, int]]:
    """Families to merge, for whole lists of rows; those that are merged already are left out."""
    names = ("list_id", "block_a", "block_b", "own", "family", "n")
    number, block_a, block_b, own, family, n = (part.column(c).to_numpy() for c in names)
    sketches = part.column("sketch").combine_chunks()
    new = np.ones(len(n), dtype=bool)
    new[1:] = (number[1:] != number[:-1]) | (block_a[1:] != block_a[:-1]) | (block_b[1:] != block_b[:-1])
    at = np.cumsum(new)
    order = np.lexsort((n, at))
    at, n, own, family, across = at[order], n[order], own[order], family[order], (block_a != block_b)[order]
    width = sketches.value_lengths().to_numpy()[order].astype(np.int64)
    flat = sketches.flatten().to_numpy().view(np.uint64)
    first = (np.cumsum(np.append(0, sketches.value_lengths().to_numpy()))[:-1])[order]
    # Rows of a list follow by size: a row's partners end where sets are too large for it.
    place = at << 32 | n
    end = np.searchsorted(place, at << 32 | np.minimum(100 * n // percent, (1 << 32) - 1), side="right")
    bounds = np.append(0, np.cumsum(end - np.arange(len(n)) - 1))
    names, family = np.unique(family, return_inverse=True)
    roots = np.array([merged.root(x) for x in names.tolist()])
    out, begin = [], 0
    while begin < len(n):
        stop = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + PAIRS, side="right")) - 1)
        many = np.diff(bounds[begin : stop + 1])
        one = np.repeat(np.arange(begin, stop), many)
        two = one + 1 + np.arange(len(one)) - np.repeat(bounds[begin:stop] - bounds[begin], many)
        begin = stop
        open_pairs = (roots[family[one]] != roots[family[two]]) & ~(across[one] & (own[one] == own[two]))
        one, two = one[open_pairs], two[open_pairs]
        bits = _sketch_bits(flat, first, width, one, two)
        possible = bits * (100 + percent) <= (n[one] + n[two]) * (100 - percent)
        pairs = np.column_stack([roots[family[one[possible]]], roots[family[two[possible]]]])
        found = [(a, b) for a, b in np.unique(pairs, axis=0).tolist() if merged.merge(a, b)]
        if found:
            out += found
            roots = np.array([merged.root(x) for x in names.tolist()])
    return out


def _crossing(members: DataFrame, percent: int, list_block: int) -> DataFrame:
    """``a, b``: families with members of one list whose sketches may be similar, or a chain of such pairs.

    ``members`` has ``list_id, size, member, family, n, sketch``. A list of more
    than ``list_block`` members is dealt to tasks by pairs of blocks.
    """
    keys = ["list_id", "block_a", "block_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, waiting = _Merged(), []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last list of a batch may go on in the next one.
            last = np.ones(batch.num_rows, dtype=bool)
            for c in keys:
                column = batch.column(c).to_numpy()
                last &= column == column[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if waiting:
                goes_on = all(waiting[-1].column(c)[-1] == batch.column(c)[0] for c in keys)
                if cut or not goes_on:
                    begun = [batch.slice(0, cut)] if cut else []
                    yield _pairs(_possible_merges(pa.Table.from_batches(waiting + begun), percent, merged))
                    waiting = []
            elif cut:
                yield _pairs(_possible_merges(pa.Table.from_batches([batch.slice(0, cut)]), percent, merged))
            waiting.append(batch.slice(cut))
        if waiting:
            yield _pairs(_possible_merges(pa.Table.from_batches(waiting), percent, merged))

    blocks = F.ceil(F.col("size") / list_block)
    dealt = (
        members.withColumn("own", F.pmod(F.xxhash64("member"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .select(
            "list_id",
            F.least("own", "other").alias("block_a"),
            F.greatest("own", "other").alias("block_b"),
            "own",
            "family",
            F.col("n").cast("bigint").alias("n"),
            "sketch",
        )
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _families(lists: DataFrame, sets: DataFrame, percent: int, list_block: int) -> DataFrame:
    """``node, component`` of sets that may be linked, directly or by a chain."""
    one, two = sets.alias("one"), sets.alias("two")
    known = (
        lists.filter(F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select("a", "b")
        .distinct()
        .join(one.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
        .join(two.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
        .withColumn("bits", _differing("sa", "sb"))
        .select("a", "b", "na", "nb", "bits", F.least(F.size("sa"), F.size("sb")).alias("width"))
        .checkpoint()
    )
    total = F.col("na") + F.col("nb")
    near = (2 * F.least("na", "nb") >= F.greatest("na", "nb")) & (
        _estimate(F.col("bits"), F.col("width")) * (100 + FAMILY_PERCENT) <= total * (100 - FAMILY_PERCENT)
    )
    possible = (F.col("bits") * (100 + percent) <= total * (100 - percent)) & (
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    )
    first = components(known.filter(near | possible).select("a", "b")).checkpoint()
    family = F.coalesce("component", "member")
    members = (
        lists.filter(F.col("b").isNull())
        .select("list_id", F.col("a").alias("member"))
        .distinct()
        .join(first.withColumnRenamed("node", "member"), "member", "left")
        .select("list_id", "member", family.alias("family"))
        .checkpoint()
    )
    mixed_lists = members.groupBy("list_id").agg(
        F.min("family").alias("l"), F.max("family").alias("h"), F.count("*").alias("size")
    )
    mixed_lists = mixed_lists.filter("l <> h").select("list_id", "size")
    open_members = members.join(mixed_lists, "list_id").join(
        sets.select(F.col("rep").alias("member"), "n", "sketch"), "member"
    )
    crossing = _crossing(open_members, percent, list_block)
    # The rest of the graph has families as nodes: a set that is in none is one by itself.
    merged = components(crossing).checkpoint()
    if merged.isEmpty():
        return first
    every = first.select("node", F.col("component").alias("family")).unionByName(
        merged.select("node", F.col("node").alias("family")).join(first.select("node"), "node", "left_anti")
    )
    joined = every.join(merged.withColumnRenamed("node", "family"), "family", "left")
    return joined.select("node", F.coalesce("component", "family").alias("component"))


class _Family:
    """The members of one family, or of two blocks of one."""

    def __init__(self, percent: int, size: int):
        self.percent, self.size = percent, size
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []

    def add(self, ids: list[int], texts: list[bytes]) -> None:
        elements, sizes = shingle_sets(texts, self.size)
        bounds = _bounds(sizes)
        self.ids += ids
        self.sets += [elements[a:b].copy() for a, b in zip(bounds, bounds[1:])]

    def links(self) -> list[tuple[int, int]]:
        """Links that connect what is connected; fewer than there are members."""
        order = np.argsort(self.ids, kind="stable")
        ids = np.array(self.ids, dtype=np.int64)[order]
        sets = [self.sets[i] for i in order]
        sizes = np.array([len(s) for s in sets])
        width = max(1, min(1024, int(sizes.max()) // 12))
        sketch = np.empty((len(sets), width), dtype=np.uint64)
        for i, s in enumerate(sets):
            sketch[i] = _parity(s, np.array([len(s)]), width)[0]
        part = np.arange(len(sets))
        out = []
        for i in range(len(sets) - 1):
            bits = np.bitwise_count(sketch[i] ^ sketch[i + 1 :]).sum(axis=1, dtype=np.int64)
            small = np.minimum(sizes[i], sizes[i + 1 :])
            large = np.maximum(sizes[i], sizes[i + 1 :])
            possible = (100 * small >= self.percent * large) & (
                bits * (100 + self.percent) <= (small + large) * (100 - self.percent)
            )
            near = np.flatnonzero(possible)
            for j in near[np.argsort(bits[near], kind="stable")] + i + 1:
                if part[i] == part[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= self.percent * (sizes[i] + sizes[j] - both):
                    part[part == part[j]] = part[i]
                    out.append((int(ids[i]), int(ids[j])))
        return out


def _links(placed: DataFrame, percent: int, size: int) -> DataFrame:
    """Links among rows ``family, block_a, block_b, rep, text`` of the same first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, family = None, None
        for part, texts in slices(batches):
            names = list(zip(*(part.column(c).to_pylist() for c in ("family", "block_a", "block_b"))))
            ids, begin = part.column("rep").to_pylist(), 0
            while begin < len(names):
                end = begin
                while end < len(names) and names[end] == names[begin]:
                    end += 1
                if names[begin] != current:
                    if family:
                        yield _pairs(family.links())
                    current, family = names[begin], _Family(percent, size)
                family.add(ids[begin:end], texts[begin:end])
                begin = end
        if family:
            yield _pairs(family.links())

    keys = ["family", "block_a", "block_b"]
    dealt = placed.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def similar_components(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    per_bucket: int = PER_BUCKET,
    per_block: int = PER_BLOCK,
    list_block: int = LIST_BLOCK,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` per row of ``docs``.

    Two rows are linked if their shingle sets have a Jaccard similarity of at
    least ``percent`` / 100; the component is the smallest key reachable. A row
    without words, or a null text, has no shingles, is linked with nothing and
    is its own component. A row without key has no component. Rows that repeat
    a key are all returned, with the component of any of them. ``class_id`` is
    the smallest key with an equal set.
    """
    known = describe_sets(docs, key, text, shingle).checkpoint()
    usable = known.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = usable.groupBy("n_shingles", "d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.min_by("sketch", "doc_id").alias("sketch")
    )
    classes = classes.checkpoint()
    sets = classes.select("rep", F.col("n_shingles").alias("n"), "sketch")
    rep_of = usable.join(classes.drop("sketch"), ["n_shingles", "d1", "d2"]).select("doc_id", "rep").distinct()
    rep_of = rep_of.checkpoint()
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(64, total // per_bucket)
    lists = signature_lists(docs, key, text, shingle, percent, buckets).checkpoint()
    a = rep_of.select(F.col("doc_id").alias("a"), F.col("rep").alias("rep_a"))
    b = rep_of.select(F.col("doc_id").alias("b"), F.col("rep").alias("rep_b"))
    lists = lists.join(a, "a").join(b, "b", "left").select(
        "list_id", F.col("rep_a").alias("a"), F.col("rep_b").alias("b")
    )
    families = _families(lists, sets, percent, list_block).checkpoint()
    sized = families.join(sets.select(F.col("rep").alias("node"), "n"), "node")
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("n") / per_block).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks")
    placed = (
        families.join(blocks, "component")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            F.col("node").alias("rep"),
            F.col("component").alias("family"),
            F.least("own", "other").alias("block_a"),
            F.greatest("own", "other").alias("block_b"),
        )
    )
    texts = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("rep"), F.col(f"`{text}`").cast("string").alias("text")
    )
    links = _links(placed.join(texts, "rep"), percent, shingle).checkpoint()
    # A key that repeats with other texts links its classes too.
    repeated = rep_of.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    repeats = usable.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("a"))
    found = components(links.unionByName(repeated.join(repeats, "a", "left_semi")))
    keyed = rep_of.groupBy("doc_id").agg(F.min("rep").alias("class_id"))
    result = known.select("doc_id", "n_shingles").join(keyed, "doc_id", "left")
    result = result.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    return result.select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id", "doc_id").alias("component_id"), "class_id"
    )


@query()
def op1_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = similar_components(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
