"""Multi-line CSV, with big files read by many tasks.

Spark's ``multiLine`` option gives each file to one task, because a block alone
cannot tell whether a line break is quoted. Here every block is first reduced to
an automaton: in which state it ends, outside or inside of quotes, for each state
it may begin in. Running the automata of a file one after another, which takes one
row per block, gives the true state at every border. Each block then makes whole
records of its own lines, where they are; only lines of records that cross a
border are shuffled, and joined to records. The lines are read three times.

A quote opens a field only at the field's beginning, inner quotes are doubled, and
a line may end in LF or CR LF, each record by itself. A record with more or fewer
fields than the header is an error, if ``strict``.

The order of the lines within a block is needed for this, which no built-in
expression has without a shuffle, so the lines go through Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.sources.files import (
    _FILE,
    _NUMBER,
    _NO_NULL_TEXT,
    SOURCE_ORDER,
    csv_reader,
    file_ordinals,
    input_files,
    text_schema,
)

Batches = Iterator[pa.RecordBatch]


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return text.select(
        F.xxhash64("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


# The functions for tasks are made inside of functions, so that they are sent to
# workers as they are: the package need not be installed there.


def _quoting() -> tuple[Callable, Callable]:
    """Is the end of a line inside of quotes, if it begins outside, or inside?"""
    field = rb'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+'
    whole_fields = re.compile(rb"(?:" + field + rb",)*+")
    closed = re.compile(rb'"(?:[^"]++|"")*+"')
    rest = re.compile(rb'(?:[^"]++|"")*+"[^,]*+')

    def from_outside(line: bytes, at: int = 0) -> bool:
        at = whole_fields.match(line, at).end()
        return line[at : at + 1] == b'"' and not closed.match(line, at)

    def from_inside(line: bytes) -> bool:
        found = rest.match(line)
        if not found:
            return True
        return found.end() < len(line) and from_outside(line, found.end() + 1)

    return from_outside, from_inside


def _segments() -> Callable:
    def segments(batches: Batches) -> Iterator[tuple[tuple[int, int], pa.Array, np.ndarray]]:
        """Runs of lines of one block: the block, the lines, and which of them have quotes."""
        for batch in batches:
            path, block = batch.column("path").to_numpy(), batch.column("block").to_numpy()
            cuts = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(path)]):
                if a < b:
                    lines = batch.column("value").slice(a, b - a)
                    quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
                    yield (int(path[a]), int(block[a])), lines, np.flatnonzero(quoted)

    return segments


def _automata() -> Callable[[Batches], Batches]:
    """Per block: its end state from outside, from inside, and whether inside ever ends."""
    segments, (from_outside, from_inside) = _segments(), _quoting()

    def run(batches: Batches) -> Batches:
        current, rows = None, []
        for block, lines, quoted in segments(batches):
            if block != current:
                current = block
                rows.append([*block, False, True, False])
            row = rows[-1]
            for i in quoted:
                line = lines[i].as_py()
                outside, inside = from_outside(line), from_inside(line)
                row[2], row[3] = (inside if x else outside for x in row[2:4])
                row[4] |= not row[3]
        names = ["path", "block", "outside", "inside", "ends"]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _owners(blocks: list) -> dict[tuple[int, int], int]:
    """For blocks that begin inside of quotes: the block in which that record begins."""
    found, path, inside, owner = {}, None, False, 0
    for b in sorted(blocks, key=lambda b: (b["path"], b["block"])):
        if b["path"] != path:
            path, inside = b["path"], False
        if inside:
            found[path, b["block"]] = owner
        begins = not inside or b["ends"]
        inside = b["inside"] if inside else b["outside"]
        if inside and begins:
            owner = b["block"]
    return found


def _records(shared, fragments: bool) -> Callable[[Batches], Batches]:
    """Whole records of the blocks, or else the lines of records that cross a border.

    A record is told by the block and line it begins in; ``part`` is the block of its
    lines. Lines that end a record of an earlier block have line -1.
    """
    segments, (from_outside, from_inside) = _segments(), _quoting()
    names = ["file", "block", "line", "part", "text"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names
        )

    def run(batches: Batches) -> Batches:
        files, owners = shared.value
        # Lines of a record that isn't complete yet, and where it begins.
        current, inside, count, kept, begin = None, False, 0, [], 0

        def left() -> list[tuple]:
            """What of a block belongs to a record that goes on in the next one."""
            if not kept:
                return []
            owner = current[1] if begin >= 0 else owners[current]
            return [(files[current[0]], owner, begin, current[1], b"\n".join(kept))]

        for block, lines, quoted in segments(batches):
            if block != current:
                if fragments and kept:
                    yield batch(left())
                current, inside, count, kept = block, block in owners, 0, []
                begin = -1 if inside else 0
            n, before, at, state = len(lines), np.empty(len(lines), dtype=bool), 0, inside
            for i in quoted:
                before[at : i + 1] = state
                line = lines[i].as_py()
                state = from_inside(line) if state else from_outside(line)
                at = i + 1
            before[at:] = state
            inside = state
            starts = np.flatnonzero(~before)
            first = int(starts[0]) if len(starts) else n
            kept += lines.slice(0, first).to_pylist()
            if not len(starts):
                count += n
                continue
            if kept and begin >= 0 and not fragments:
                yield batch([(files[block[0]], block[1], begin, block[1], b"\n".join(kept))])
            elif kept and begin < 0 and fragments:
                yield batch(left())
            kept, begin = [], 0
            last = int(starts[-1])
            if inside:
                kept, begin = lines.slice(last).to_pylist(), count + last
                starts, n_done = starts[:-1], last
            else:
                n_done = n
            if not fragments and len(starts):
                text = lines.slice(first, n_done - first)
                if len(starts) < n_done - first:
                    offsets = pa.array(np.append(starts, n_done) - first, pa.int32())
                    text = pc.binary_join(pa.ListArray.from_arrays(offsets, text), b"\n")
                where = [np.full(len(starts), x) for x in (files[block[0]], block[1])]
                where += [starts + count, np.full(len(starts), block[1])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, where), text], names=names)
            count += n
        if fragments and kept:
            yield batch(left())

    return run


_FIELDS = "file bigint, block bigint, line bigint, part bigint, text binary"


def _joined(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, line, text``: one row per record, told by where it begins."""
    lines = _lines(spark, path)
    numbers = file_ordinals(spark, input_files(lines)).select(F.xxhash64(_FILE).alias("path"), _NUMBER)
    files = {r["path"]: r[_NUMBER] for r in numbers.collect()}
    kinds = "path bigint, block bigint, outside boolean, inside boolean, ends boolean"
    # One row per block of 128 MB or so.
    owners = _owners(lines.mapInArrow(_automata(), kinds).collect())
    shared = spark.sparkContext.broadcast((files, owners))
    whole = lines.mapInArrow(_records(shared, False), _FIELDS).select("file", "block", "line", "text")
    pieces = F.sort_array(F.collect_list(F.struct("part", "text")))
    crossing = (
        lines.mapInArrow(_records(shared, True), _FIELDS)
        .groupBy("file", "block")
        .agg(F.max("line").alias("line"), pieces.alias("pieces"))
    )
    text = F.concat_ws("\n", F.transform("pieces", lambda p: p["text"].cast("string")))
    return whole.withColumn("text", F.col("text").cast("string")).unionByName(
        crossing.select("file", "block", "line", text.alias("text"))
    )


def read_large_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    missing: str = "distinct",
    strict: bool = True,
    source_order: bool = False,
) -> DataFrame:
    """Like ``read_csv_text(multiline=True)``, with each file split over many tasks.

    The lines are read once when this is called, to find the state at each border.
    """
    header = csv_reader(spark, missing, multiline=True).csv(path if isinstance(path, str) else list(path))
    names = [c.removesuffix("\r") for c in header.columns]
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if missing != "null":
        options["nullValue"] = _NO_NULL_TEXT
    # What ends a record lies outside of quotes, and so does a CR before it.
    ended = F.col("text").endswith("\r")
    text = F.when(ended, F.substring("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    data = _joined(spark, path).filter("NOT (block = 0 AND line = 0)").withColumn("text", text)
    data = data.filter(F.col("text") != "")
    parsed = data.withColumn("row", F.from_csv("text", F.lit(text_schema(names).toDDL()), options))
    wanted = list(columns or names)
    selected = [F.col(f"row.`{c}`").alias(c) for c in wanted]
    if missing == "blank":
        selected = [F.coalesce(c, F.lit("")).alias(n) for c, n in zip(selected, wanted)]
    if source_order:
        selected.append(F.struct("file", "block", "line").alias(SOURCE_ORDER))
    return parsed.select(*selected)
