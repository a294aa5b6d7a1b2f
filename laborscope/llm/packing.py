"""Harmonic packing of tokenized texts into sequences of fixed capacity.

Lengths fall into reciprocal-capacity classes: class ``j`` holds lengths above
``capacity / (j + 1)`` up to ``capacity / j``, and each of its sequences takes
exactly ``j`` pieces. As texts may be cut, a text gives off whole sequences
first, then pieces that fill the slots ``capacity // j`` of large classes
exactly; only a rest of at most ``capacity / WHOLE_BELOW`` keeps its own length,
where a class wastes little.

Every task fills its sequences alone. What it leaves, less than one sequence per
class, is the only part that is shuffled: the rests of ``GROUP`` tasks meet and
are filled by the same rule, and the last incomplete sequences of a group are
merged by best fit.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.llm.tokens import piece_tokenizer
from laborscope.llm.words import slices

CAPACITY = 4096
WHOLE_BELOW = 16
GROUP = 1024
#: Sequences of the second round are numbered from here.
_SECOND = 1 << 62


def cuts(total: int, capacity: int = CAPACITY, whole_below: int = WHOLE_BELOW) -> list[int]:
    """Lengths of the pieces of a text with ``total`` tokens."""
    out = [capacity] * (total // capacity)
    rest = total % capacity
    while rest * whole_below > capacity:
        slot = capacity // -(-capacity // rest)
        out.append(slot)
        rest -= slot
    return [*out, rest] if rest else out


class _Filler:
    """Open sequences by class; a full one gets the next number."""

    def __init__(self, capacity: int, number: int):
        self.capacity, self.number = capacity, number
        self.open: dict[int, list] = {}

    def add(self, length: int, piece) -> list[tuple]:
        """The pieces with sequence and offset, once their sequence is full."""
        count = self.capacity // length
        own = self.open.setdefault(count, [])
        own.append((length, piece))
        if len(own) < count:
            return []
        del self.open[count]
        return self.placed(own)

    def placed(self, own: list) -> list[tuple]:
        out, offset = [], 0
        for length, piece in own:
            out.append((*piece, self.number, offset))
            offset += length
        self.number += 1
        return out

    def rest(self) -> list:
        out = [x for count in sorted(self.open) for x in self.open[count]]
        self.open = {}
        return out


def _best_fit(pieces: list, capacity: int) -> list[list]:
    """Sequences of at most ``capacity``, longest pieces first, each where least room is left."""
    bins, room = [], np.empty(0, dtype=np.int64)
    for x in sorted(pieces, key=lambda x: -x[0]):
        left = room - x[0]
        if len(left) and left.max() >= 0:
            at = int(np.where(left >= 0, left, capacity + 1).argmin())
            bins[at].append(x)
            room[at] = left[at]
        else:
            bins.append([x])
            room = np.append(room, capacity - x[0])
    return bins


def cut_and_fill(
    docs: DataFrame,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 2,
) -> DataFrame:
    """First round: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, worker``.

    One row per piece; ``ids`` are little-endian unsigned 32-bit numbers.
    Pieces left over have no sequence yet. A null or empty text is its end
    token alone, repeated rows are packed each, a null key stays null.
    """
    chosen = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    fields = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "worker"]
    types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        filler = _Filler(capacity, worker << 32)

        def rows(found: list) -> pa.RecordBatch:
            columns = list(zip(*(x + (worker,) for x in found))) or [[]] * len(fields)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=fields
            )

        for part, texts in slices(batches):
            found = []
            encoded = piece_tokenizer(tokenizer).ids(texts, end)
            for doc, ids in zip(part.column("doc_id").to_pylist(), encoded):
                start, total = 0, len(ids) // 4
                for n in cuts(total, capacity):
                    piece = (doc, start, n, ids[4 * start : 4 * (start + n)], total)
                    found += filler.add(n, piece)
                    start += n
            yield rows(found)
        yield rows([(*piece, None, None) for _, piece in filler.rest()])

    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'bigint'}" for c in fields)
    return chosen.mapInArrow(run, schema)


def place_rest(pieces: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Second round over written first-round rows, with whatever columns they carry."""
    rest = pieces.filter(F.col("sequence_id").isNull())
    gathered = rest.withColumn("_group", F.floor(F.col("worker") / group))
    gathered = gathered.repartition("_group").sortWithinPartitions("_group")
    names = pieces.columns
    schema = pieces.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler, current = None, None

        def rows(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(found, schema=shape)

        def placed(own: list) -> list[dict]:
            return [x | {"sequence_id": s, "offset": o} for x, s, o in own]

        def finish() -> list[dict]:
            bins = _best_fit(filler.rest(), capacity)
            return [x for own in bins for x in placed(filler.placed(own))]

        for batch in batches:
            shape = batch.schema.remove(batch.schema.get_field_index("_group"))
            found = []
            for row in batch.to_pylist():
                if row.pop("_group") != current or filler is None:
                    found += finish() if filler else []
                    current = row["worker"] // group
                    filler = _Filler(capacity, _SECOND + (current << 32))
                found += placed(filler.add(row["length"], (row,)))
            yield rows(found)
        if filler:
            yield rows(finish())

    done = gathered.mapInArrow(run, schema)
    return pieces.filter(F.col("sequence_id").isNotNull()).unionByName(done).select(*names)


def pack(docs: DataFrame, tokenizer: str, work_folder: str, **options) -> DataFrame:
    """All pieces with their token ids, ``sequence_id`` and ``offset`` (gapless from 0)."""
    cut_and_fill(docs, tokenizer, **options).write.parquet(work_folder)
    pieces = docs.sparkSession.read.parquet(work_folder)
    return place_rest(pieces, capacity=options.get("capacity", CAPACITY)).drop("worker")


def packed_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a checksum in place of their ids, which thus are never written."""
    pieces = cut_and_fill(docs, tokenizer)
    light = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids").checkpoint()
    return place_rest(light).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_digests(table(spark, folder, "documents"), tokenizer_path())
