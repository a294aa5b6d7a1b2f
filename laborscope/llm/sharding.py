"""Sharding into parts of equal size, by sampled splitters.

Every record has a place: the hash of its text, of its key, and its row. Records
are drawn with a chance in proportion to their size; quantiles of the drawn places
split all places into ranges, and a range with too many records is sampled and
split again. Equal texts have neighbouring places, so a text that a third of all
records share fills many ranges. The ranges are measured, and their running sums
give every record its exact rank and its exact number of bytes before it: shards
are cut by bytes, and slots are ranks.

Records of at least 1 / ``LARGE`` of a shard are at most ``shards * LARGE``. They
are dealt first, each to the emptiest shard; the others fill all shards to one level.

Only DataFrame functions are used. What comes to the driver are splitters and
sums, one row per ``range_rows`` records, and the large records.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborscope.llm.base import query, table

SHARDS = 24
#: Records that a range should have, and drawn records per range.
RANGE_ROWS = 1 << 22
DRAWN = 32
#: Ranges per shard, at least.
LEAST_RANGES = 4
LARGE = 64
#: Bytes that a record takes besides its text.
OVERHEAD = 8

_PLACE = "struct<a: bigint, b: bigint, c: bigint>"


def _places(docs: DataFrame, key: str, text: str, overhead: int) -> DataFrame:
    """``doc_id, size, text_crc32, place`` of every row."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    row = F.monotonically_increasing_id()
    place = F.struct(
        F.xxhash64(content).alias("a"), F.xxhash64(F.col(f"`{key}`")).alias("b"), row.alias("c")
    )
    return docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(content).cast("bigint") + overhead).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        place.alias("place"),
    )


def _literal(values: list, kind: str) -> Column:
    """A list as one constant."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _at_most(values: list, kind: str, wanted: Column) -> Column:
    """How many of the sorted ``values`` are at most ``wanted``, by binary search."""
    known, n = _literal(values, kind), len(values)
    steps = F.array(*(F.lit(1 << i) for i in range(max(1, n.bit_length()) - 1, -1, -1)))

    def step(found: Column, width: Column) -> Column:
        # Beyond the end there is no value, and the step isn't taken.
        return F.when(F.get(known, found + width - 1) <= wanted, found + width).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def _range(bounds: list[dict]) -> Column:
    return _at_most(bounds, _PLACE, F.col("place"))


def _splitters(rows: DataFrame, chance: Column, every: int) -> list[dict]:
    """Every ``every``-th place, in order, of records drawn by ``chance``."""
    # The draw is a hash of the place, so a task that runs again draws the same.
    bits = F.xxhash64(F.lit("draw"), "place").bitwiseAND(F.lit((1 << 53) - 1))
    drawn = rows.filter(bits / F.lit(float(1 << 53)) < chance).agg(
        F.sort_array(F.collect_list("place")).alias("places")
    )
    cut = F.filter("places", lambda x, i: (i % every) == every - 1)
    return [r.asDict() for r in drawn.select(cut.alias("places")).first()["places"]]


def _ordered(bounds: list[dict]) -> list[dict]:
    return [dict(zip("abc", x)) for x in sorted({tuple(b[c] for c in "abc") for b in bounds})]


def split_ranges(
    rows: DataFrame, total: int, count: int, least: int, range_rows: int
) -> tuple[list[dict], list[tuple[int, int]]]:
    """Bounds of the ranges, and the records and bytes of each.

    Bounds are quantiles of a draw by size. A range of more than twice
    ``range_rows`` records is drawn from again, by rows, and subdivided.
    """
    ranges = max(least, -(-count // range_rows))
    chance = F.col("size") * F.lit(float(ranges * DRAWN) / max(1, total))
    bounds = _ordered(_splitters(rows, chance, DRAWN))
    while True:
        measured = rows.groupBy(_range(bounds).alias("range")).agg(
            F.count("*").alias("rows"), F.sum("size").alias("bytes")
        )
        found = {r["range"]: (r["rows"], r["bytes"]) for r in measured.collect()}
        full = [i for i, (n, _) in found.items() if n > 2 * range_rows]
        more = bounds
        if full:
            inside = rows.filter(_range(bounds).isin(full))
            more = _ordered(bounds + _splitters(inside, F.lit(DRAWN / range_rows), DRAWN))
        if len(more) == len(bounds):
            return bounds, [found.get(i, (0, 0)) for i in range(len(bounds) + 1)]
        bounds = more


def levelled(loads: list[int], amount: int) -> list[int]:
    """What each shard takes of ``amount`` so that the emptiest come up to one level."""
    order = sorted(range(len(loads)), key=lambda s: (loads[s], s))
    below = list(accumulate(loads[s] for s in order))
    # The most shards that a common level reaches.
    k = max(k for k in range(1, len(order) + 1) if loads[order[k - 1]] * k <= amount + below[k - 1])
    level, rest = divmod(amount + below[k - 1], k)
    taken = [0] * len(loads)
    for i, s in enumerate(order[:k]):
        taken[s] = level + (i < rest) - loads[s]
    return taken


def assign_shards(
    docs: DataFrame,
    *,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    overhead: int = OVERHEAD,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, row`` per row of ``docs``.

    ``size`` is the text's bytes in UTF-8 plus ``overhead``; a null text is empty.
    Sizes of shards differ by at most a 1 / ``LARGE`` of a shard, unless one
    record alone is larger than its share. ``slot`` counts a shard's rows from 0.
    ``row`` is the row's ``monotonically_increasing_id`` in ``docs``. Repeated rows and
    null keys are rows like others; an empty table gives no rows; other columns don't matter.
    """
    rows = _places(docs, key, text, overhead).checkpoint()
    sums = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    count, total = sums["n"], sums["bytes"] or 0
    large = F.col("size") * F.lit(shards * LARGE) >= F.lit(total)
    small = rows.filter(~large)

    # The large records, each to the emptiest shard, in order of size.
    loads, slots, dealt = [0] * shards, [0] * shards, []
    found = rows.filter(large).select("size", F.col("place.c").alias("row")).collect()
    for r in sorted(found, key=lambda r: (-r["size"], r["row"])):
        s = min(range(shards), key=lambda s: (loads[s], s))
        dealt.append((r["row"], s, slots[s]))
        loads[s] += r["size"]
        slots[s] += 1

    bounds, measured = split_ranges(small, total, count, LEAST_RANGES * shards, range_rows)
    before = [(0, 0), *accumulate(measured, lambda x, y: (x[0] + y[0], x[1] + y[1]))]
    # Twice the bytes up to the end of each shard but the last: records go by their middle.
    ends = [2 * x for x in accumulate(levelled(loads, before[-1][1]))][:-1]

    in_range = Window.partitionBy("range").orderBy("place")
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def ranked(part: DataFrame) -> DataFrame:
        """``rank`` of each record among all small ones, and its shard."""
        rows_before, bytes_before = (_literal([x[i] for x in before], "bigint") for i in (0, 1))
        placed = part.withColumns(
            {"rank": F.row_number().over(in_range) - 1, "upto": F.sum("size").over(so_far)}
        )
        middle = 2 * (F.get(bytes_before, F.col("range")) + F.col("upto")) - F.col("size")
        return placed.withColumns(
            {
                "rank": F.get(rows_before, F.col("range")) + F.col("rank"),
                "shard": _at_most(ends, "bigint", middle),
            }
        )

    ranges = small.withColumn("range", _range(bounds))
    # A shard begins in the range its first byte is in or, if no middle follows there, in a later one.
    at = sorted({i for e in [0, *ends] for i in _beginning(before, e)})
    begins = ranked(ranges.filter(F.col("range").isin(at))).groupBy("shard").agg(F.min("rank").alias("rank"))
    first = [0] * shards
    for r in begins.collect():
        first[r["shard"]] = r["rank"]

    slot = F.col("rank") - F.get(_literal(first, "bigint"), F.col("shard"))
    slot = slot + F.get(_literal(slots, "bigint"), F.col("shard"))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", F.col("place.c").alias("row")]
    others = rows.filter(large).join(
        # At most ``shards * LARGE`` rows.
        F.broadcast(_table(docs.sparkSession, dealt)), F.col("place.c") == F.col("_row")
    )
    return ranked(ranges).withColumn("slot", slot).select(*columns).unionByName(others.select(*columns))


def _table(spark: SparkSession, dealt: list[tuple[int, int, int]]) -> DataFrame:
    one = spark.range(1).select(
        F.explode(_literal([list(x) for x in dealt], "array<bigint>")).alias("x")
    )
    return one.select(
        F.col("x")[0].alias("_row"), F.col("x")[1].cast("int").alias("shard"), F.col("x")[2].alias("slot")
    )


def _beginning(before: list[tuple[int, int]], end: int) -> list[int]:
    """Ranges with the first record whose middle is at ``end`` (in half bytes) or later."""
    found = []
    for i in range(len(before) - 1):
        if before[i + 1][0] > before[i][0] and 2 * before[i + 1][1] > end:
            found.append(i)
            # The middle of the first record here may lie before the end, that of the next range's can't.
            if 2 * before[i][1] >= end or len(found) == 2:
                break
    return found


def write_shards(docs: DataFrame, folder: str, rows_per_file: int = 1 << 20, **options) -> None:
    """Write all columns of ``docs`` to a folder per shard, ordered by ``slot``.

    ``docs`` must give its rows in the same partitions each time, as a scan or a
    checkpoint does; columns named ``shard`` and ``slot`` are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    numbered = docs.select(*(F.col(f"`{c}`") for c in kept), F.monotonically_increasing_id().alias("_row"))
    places = assign_shards(docs, **options).select("shard", "slot", F.col("row").alias("_row"))
    file = F.floor(F.col("slot") / rows_per_file)
    (
        numbered.join(places, "_row")
        .drop("_row")
        .repartition(F.col("shard"), file)
        .sortWithinPartitions("shard", "slot")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(folder)
    )


@query()
def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = assign_shards(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
