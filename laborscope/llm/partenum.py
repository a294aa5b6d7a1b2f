"""PartEnum signatures of sets: equal-size bands, partitions of the domain, subsets of them.

Sets of sizes a and b with similarity of at least ``t`` percent differ in at most
``(a + b) * (100 - t) // (100 + t)`` elements. Sizes are cut into bands; a band up
to size ``r`` allows ``k = 2 r (100 - t) // (100 + t)`` differences. Its elements
are hashed to more than ``k / 2`` groups of ``PARTS`` parts. Two sets that differ
in at most ``k`` elements have a group with at most one difference, so one of its
subsets of ``PARTS - 1`` parts is equal in both: each subset is one signature.
A set whose partners may reach the next band has signatures for that one too.

A subset with few elements or none is equal in many sets that have nothing else in
common; their number grows with the corpus. So a set leaves out its subsets of fewer
than ``least`` elements, where ``least`` is as high, up to ``STRONG``, as leaves
enough groups without any such subset: more than half as many as the differences
that this set and any similar one can have. One of those groups then has at most one
difference. Of two similar sets take the one with the higher ``least``: the subset
that is equal in that group has as many elements, so both sets have its signature.
"""

from __future__ import annotations

import functools

import numpy as np

from laborscope.llm.words import mixed, randoms

PARTS = 3
#: Elements of a subset beyond which it isn't told from larger ones.
STRONG = 2
#: Groups beyond those needed, in percent of them and by number, so that most sets can leave out weak ones.
SPARE_PERCENT = 10
SPARE = 2


@functools.lru_cache(maxsize=4)
def band_ends(percent: int, largest: int) -> np.ndarray:
    """Largest size of each band; a band spans about two steps of the similarity."""
    ends, low = [], 1
    while not ends or ends[-1] < largest:
        high = max(low, low * 10_000 // (percent * percent))
        ends.append(high)
        low = high + 1
    return np.array(ends, dtype=np.int64)


def instances(sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set, band, number of groups and most differences for every band that a set has signatures in."""
    largest = int(sizes.max(initial=1))
    ends = band_ends(percent, 1 << (2 * largest).bit_length())
    own = np.searchsorted(ends, sizes)
    upper = 100 * sizes >= percent * (ends[own] + 1)
    at = np.concatenate([np.arange(len(sizes)), np.flatnonzero(upper)])
    band = np.concatenate([own, own[upper] + 1])
    k = 2 * ends[band] * (100 - percent) // (100 + percent)
    groups = (k + 2) // 2
    groups += np.where(k > 0, groups * SPARE_PERCENT // 100 + SPARE, 0)
    # The largest partner that shares the band bounds the differences of a set.
    partner = np.minimum(100 * sizes[at] // percent, ends[band])
    return at, band, groups, (sizes[at] + partner) * (100 - percent) // (100 + percent)


def least_elements(counts: np.ndarray, groups: np.ndarray, differences: np.ndarray) -> np.ndarray:
    """Elements that a subset needs to count, per instance; ``counts`` are those of each group's smallest subset."""
    first = np.cumsum(groups) - groups
    least = np.zeros(len(groups), dtype=np.int64)
    for some in range(1, STRONG + 1):
        least += 2 * np.add.reduceat((counts >= some).astype(np.int64), first) > differences
    # Only equal sets go with a set that allows no difference, and they have the same subsets.
    return np.where(differences > 0, least, 1)


def signatures(
    elements: np.ndarray, sizes: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and their sets, of sets given as element hashes one after another."""
    first = np.cumsum(sizes) - sizes
    full = np.flatnonzero(sizes)
    if not len(full):
        return np.empty(0, np.uint64), full
    at, band, groups, differences = instances(sizes[full], percent)
    at = full[at]
    many = sizes[at]
    # All elements once per instance of their set.
    step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    own = elements[np.repeat(first[at], many) + step]
    width = groups * PARTS
    base = np.cumsum(width) - width
    scale = np.repeat(width, many).astype(np.uint64)
    # The high half of a hash, scaled to the number of parts, gives the part.
    part = ((own >> np.uint64(32)) * scale) >> np.uint64(32)
    place = np.repeat(base, many) + part.astype(np.int64)
    total = np.zeros(int(width.sum()), dtype=np.uint64)
    np.add.at(total, place, mixed(own + np.uint64(1)))
    count = np.bincount(place, minlength=len(total)).reshape(-1, PARTS)
    count = count.sum(axis=1, keepdims=True) - count
    least = least_elements(count.min(axis=1), groups, differences)
    strong = (count >= np.repeat(least, groups)[:, None]).ravel()
    total = mixed(total).reshape(-1, PARTS)
    group = np.arange(len(total)) - np.repeat(np.cumsum(groups) - groups, groups)
    label = mixed(np.repeat(band, groups).astype(np.uint64) << np.uint64(32) | group.astype(np.uint64))
    out = []
    for left_out, seed in enumerate(randoms(PARTS, 11)):
        # The sum of all parts but one, each with its own factor.
        kept = [i for i in range(PARTS) if i != left_out]
        subset = sum(total[:, i] * (randoms(PARTS, 12)[i] | np.uint64(1)) for i in kept)
        out.append(mixed(subset + label + seed))
    return np.column_stack(out).ravel()[strong], np.repeat(np.repeat(at, groups), PARTS)[strong]


def sets_of(hashes: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements of each row one after another, and how many each has."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], np.bincount(r[new], minlength=count)
