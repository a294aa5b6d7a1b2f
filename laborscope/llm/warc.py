"""WARC archives: a writer with revisit records, and a salvage reader.

The writer makes one gzip member per record and one file per task, with equal
payloads of some size written once. The reader goes through a file member by
member (or, uncompressed, record by record) and checks each: the member's
checksum, the version line, the headers, the length and the payload digest.
After a failed check it searches for the next place where a valid record begins,
goes on there, and reports the bytes in between as a gap.

Files are read in pieces of ``CHUNK`` bytes; memory holds the record at hand.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import query, table
from laborscope.sources.storage import work_folder

#: Smaller payloads are always written in full.
MIN_REVISIT = 1000
FILE_BYTES = 1 << 26
CHUNK = 1 << 20
LEVEL = 6

# Fixed values of the format.
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    record_id: str, uri: str, kind: str, payload: bytes, refers_to: str | None = None, date: str = "1970-01-01T00:00:00Z"
) -> bytes:
    """One record; a revisit has the HTTP headers of the full response, but not its body."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {digest_of(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def _clean(uri: str | None) -> str:
    return "".join(c for c in uri or "" if c.isprintable())


def plan_revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``key, refers_to``: rows whose payload another row with a larger key also has."""
    known = pages.filter(F.col("key").isNotNull()).select(
        "key", F.octet_length("payload").alias("size"), F.sha1("payload").alias("sha1")
    )
    known = known.filter(F.col("size") >= min_revisit)
    last = known.groupBy("sha1", "size").agg(F.max("key").alias("refers_to"), F.count("*").alias("n"))
    return (
        known.join(last.filter("n > 1"), ["sha1", "size"])
        .filter(F.col("key") < F.col("refers_to"))
        .groupBy("key")
        .agg(F.max("refers_to").alias("refers_to"))
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    min_revisit: int = MIN_REVISIT,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per row below ``folder``; returns ``path, bytes, records`` of the files.

    A null payload is empty and a null address is empty. Of rows with equal
    payloads of at least ``min_revisit`` bytes that with the largest key is a
    response and the others revisit it; rows that repeat that key are responses
    too. A row without key is a response without a number. Only files in the
    returned table count: a task that is run again writes new ones.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{key}`").cast("bigint").alias("key"),
        F.col(f"`{uri}`").cast("string").alias("uri"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    planned = rows.join(plan_revisits(rows, min_revisit), "key", "left")
    filesystem_root = folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pa.fs.FileSystem.from_uri(filesystem_root)
        filesystem.create_dir(root, recursive=True)
        task, stream, done, size, count = TaskContext.get().partitionId(), None, [], 0, 0
        for batch in batches:
            for number, address, body, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    name = f"{task:06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.gz"
                    stream, size, count = filesystem.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                own = f"urn:page:{number}" if number is not None else f"urn:uuid:{uuid.uuid4()}"
                kind = "response" if refers is None else "revisit"
                made = record(own, _clean(address), kind, body, None if refers is None else f"urn:page:{refers}")
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(made) + packer.flush()
                stream.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    stream.close()
                    done.append((f"{filesystem_root}/{name}", size, count))
                    stream = None
        if stream:
            stream.close()
            done.append((f"{filesystem_root}/{name}", size, count))
        columns = list(zip(*done)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
            names=["path", "bytes", "records"],
        )

    written = planned.select("key", "uri", "payload", "refers_to").mapInArrow(
        run, "path string, bytes bigint, records bigint"
    )
    # Written once, under Spark's commit: this is what says which files are complete.
    written.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class _Damaged(Exception):
    pass


#: Digest algorithms that can be checked, and the bytes of their digests.
_DIGESTS = {"sha1": 20, "sha256": 32, "md5": 16}


def told_digest(value: str) -> tuple[str, bytes] | None:
    """Algorithm and bytes of a digest header in hex or base32; None if it is of another kind."""
    name, _, text = value.partition(":")
    size = _DIGESTS.get(name.strip().lower().replace("-", ""))
    text = text.strip()
    if size is None:
        return None
    try:
        if len(text) == 2 * size:
            return name.strip().lower().replace("-", ""), bytes.fromhex(text)
        found = base64.b32decode(text.upper() + "=" * (-len(text) % 8))
    except ValueError:
        return None
    return (name.strip().lower().replace("-", ""), found) if len(found) == size else None


def _parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one complete record, or _Damaged.

    A response's payload digest is checked if its algorithm and encoding are known.
    """
    head, found, rest = raw.partition(_END)
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(_VERSION):
        raise _Damaged("version line")
    try:
        pairs = [x.decode().split(":", 1) for x in lines[1:]]
        headers = {k.strip().lower(): v.strip() for k, v in pairs}
        length = int(headers["content-length"])
    except (ValueError, KeyError, UnicodeDecodeError) as error:
        raise _Damaged("headers") from error
    if length < 0 or len(rest) < length or rest[length : length + 4] != _END:
        raise _Damaged("length")
    block = rest[:length]
    if headers.get("warc-type") == "response":
        told = told_digest(headers.get("warc-payload-digest", ""))
        if told and hashlib.new(told[0], block.partition(_END)[2]).digest() != told[1]:
            raise _Damaged("digest")
    return headers, block


class _Window:
    """A window over data that grows as needed; ``more`` gives what follows, nothing at the end."""

    def __init__(self):
        self.base, self.data = 0, b""

    def more(self, wanted: int) -> bytes:
        raise NotImplementedError

    def seek(self, place: int) -> None:
        """Go on reading at ``place``."""
        raise NotImplementedError

    def at(self, place: int, count: int) -> bytes:
        """Up to ``count`` bytes from ``place``, fewer only at the end; the window may be moved on."""
        begin = place - self.base
        if begin < 0 or begin > len(self.data):
            self.seek(place)
            self.base, self.data, begin = place, b"", 0
        if len(self.data) - begin < count:
            parts = [self.data[begin:]]
            held = len(parts[0])
            while held < count and (piece := self.more(count - held)):
                parts.append(piece)
                held += len(piece)
            self.base, self.data, begin = place, b"".join(parts), 0
        return self.data[begin : begin + count]


class _File(_Window):
    """A file, opened at its beginning."""

    def __init__(self, source):
        super().__init__()
        self.source = source

    def seek(self, place: int) -> None:
        self.source.seek(place)

    def more(self, wanted: int) -> bytes:
        return self.source.read(max(CHUNK, wanted))


def _intact(unpacker, given: bytes, step: int = 256) -> Iterator[bytes]:
    """What can be unpacked of damaged data, in small steps up to the damage."""
    for i in range(0, len(given), step):
        try:
            yield unpacker.decompress(given[i : i + step])
        except zlib.error:
            return


class _Member(_Window):
    """The content of the gzip member at a place of a file, unpacked as it is read."""

    def __init__(self, file: _File, place: int):
        super().__init__()
        self.file, self.start, self.read = file, place, place
        self.unpacker = zlib.decompressobj(31)
        self.rest = b""
        #: Why the content ends before the member does.
        self.problem: str | None = None

    def seek(self, place: int) -> None:
        raise ValueError("a member is read on only")

    def more(self, wanted: int) -> bytes:
        while not self.unpacker.eof and not self.problem:
            given = self.rest or self.file.at(self.read, CHUNK)
            if not given:
                self.problem = "cut off"
                break
            if not self.rest:
                self.read += len(given)
            before = self.unpacker.copy()
            try:
                found = self.unpacker.decompress(given, max(CHUNK, wanted))
            except zlib.error:
                self.problem = "member"
                return b"".join(_intact(before, given))
            self.rest = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.read -= len(self.unpacker.unused_data)
            if found:
                return found
        return b""


def _plain(window: _Window, place: int) -> tuple[bytes, int]:
    """The record at ``place`` and where it ends, or _Damaged; headers above 1 MB count as damaged."""
    head, size = b"", 1 << 12
    while _END not in head:
        if head and len(head) < size // 2 or size > 1 << 21:
            raise _Damaged("headers")
        head = window.at(place, size)
        if not head:
            raise _Damaged("headers")
        size *= 2
    headers = head[: head.index(_END) + 4]
    if not headers.startswith(_VERSION):
        raise _Damaged("version line")
    length = [x for x in headers.lower().split(b"\r\n") if x.startswith(b"content-length:")]
    try:
        total = len(headers) + int(length[0].split(b":")[1]) + 4
    except (IndexError, ValueError) as error:
        raise _Damaged("headers") from error
    if total < len(headers):
        raise _Damaged("length")
    raw = window.at(place, total)
    if len(raw) < total:
        raise _Damaged("length")
    return raw, place + total


def _next(window: _Window, place: int, marks: tuple[bytes, ...]) -> int | None:
    """Where the next of ``marks`` begins, from ``place`` on; None if nowhere."""
    overlap = max(map(len, marks)) - 1
    while True:
        piece = window.at(place, CHUNK)
        found = [i for i in map(piece.find, marks) if i >= 0]
        if found:
            return place + min(found)
        if len(piece) < CHUNK:
            return None
        place += len(piece) - overlap


# What is found at a place: records, gaps between them, and the end with what is wrong there.
_Found = Iterator[tuple[str, int, dict | None, bytes | None, str | None]]


def _of_member(file: _File, start: int) -> _Found:
    """What a gzip member holds, each with how far the file was read for it, at the end that of the member."""
    member, place = _Member(file, start), 0
    while member.at(place, 1):
        try:
            raw, end = _plain(member, place)
            headers, block = _parse(raw)
        except _Damaged as error:
            yield "gap", member.read, None, None, str(error)
            following = _next(member, place + 1, (_VERSION,))
            if following is None:
                break
            place = following
        else:
            yield "record", member.read, headers, block, None
            place = end
    # The rest, so that the member's end and checksum are known.
    while member.more(CHUNK):
        pass
    yield "end", member.read, None, None, member.problem


def _of_plain(file: _File, start: int) -> _Found:
    """The uncompressed record at a place."""
    try:
        raw, end = _plain(file, start)
        headers, block = _parse(raw)
    except _Damaged as error:
        yield "end", start, None, None, str(error)
    else:
        yield "record", end, headers, block, None
        yield "end", end, None, None, None


def salvage(source, size: int) -> Iterator[tuple]:
    """``start, end, headers, block, problem`` of every record and, with no headers, every gap.

    Records and gaps of one gzip member have its start, and end where the file was read
    to for them, the last one at the member's end.
    """
    file, start, gap, problem = _File(source), 0, None, None
    while start < size:
        held = inner = wrong = None
        stop, seen = start, False
        for kind, stop, headers, block, wrong in (
            _of_member if file.at(start, 3) == _MAGIC else _of_plain
        )(file, start):
            if kind == "gap":
                # Until the next record it is one gap.
                inner = inner or wrong
            elif kind == "record":
                if gap is not None:
                    yield gap, start, None, None, problem
                    gap = None
                if held:
                    yield held
                if inner:
                    yield start, stop, None, None, inner
                held, inner, seen = (start, stop, headers, block, None), None, True
        if held:
            yield held if wrong else (start, stop, *held[2:])
        if wrong or not seen:
            if gap is None:
                gap, problem = start, wrong or inner or "no record"
        elif inner:
            yield start, stop, None, None, inner
        if wrong or stop <= start:
            following = _next(file, start + 1, (_MAGIC, _VERSION))
            start = size if following is None else following
        else:
            start = stop
    if gap is not None:
        yield gap, size, None, None, problem


def read_archives(files: DataFrame) -> DataFrame:
    """All records of the files in the column ``path``, and the gaps between them.

    ``path, start, stop, record_type, record_id, uri, refers_to, payload_bytes,
    payload_digest, payload, problem``: a gap has a problem and no type. The
    size and digest are those of the full payload, for a revisit as its headers
    tell, or null if they don't, or tell a digest other than SHA-1. Records of other types have their block as payload. An empty file has
    no rows, and a null path none.
    """
    fields = {
        "path": "string",
        "start": "bigint",
        "stop": "bigint",
        "record_type": "string",
        "record_id": "string",
        "uri": "string",
        "refers_to": "string",
        "payload_bytes": "bigint",
        "payload_digest": "string",
        "payload": "binary",
        "problem": "string",
    }
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

    def row(path: str, start: int, end: int, headers, block, problem) -> dict:
        out = {"path": path, "start": start, "stop": end, "problem": problem}
        if headers is None:
            return out
        kind = headers.get("warc-type", "")
        head, _, body = block.partition(_END)
        size, payload = len(body), body
        digest = hashlib.sha1(body).hexdigest()
        if kind == "revisit":
            # Their size and digest are those of the record that they refer to.
            lengths = re.findall(rb"(?mi)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", head)
            size, payload = int(lengths[0]) if lengths else None, None
            told = told_digest(headers.get("warc-payload-digest", ""))
            digest = told[1].hex() if told and told[0] == "sha1" else None
        elif kind != "response":
            size, payload, digest = len(block), block, hashlib.sha1(block).hexdigest()
        return out | {
            "record_type": kind,
            "record_id": headers.get("warc-record-id", "").strip("<>"),
            "uri": headers.get("warc-target-uri"),
            "refers_to": headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
            "payload_bytes": size,
            "payload_digest": digest,
            "payload": payload,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([(n, types[t]) for n, t in fields.items()])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                if path is None:
                    continue
                filesystem, place = pa.fs.FileSystem.from_uri(path)
                size = filesystem.get_file_info(place).size
                with filesystem.open_input_file(place) as source:
                    rows, held = [], 0
                    for found in salvage(source, size):
                        rows.append(row(path, *found))
                        held += found[1] - found[0]
                        if held > CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=shape)

    schema = ", ".join(f"{n} {t}" for n, t in fields.items())
    # One task per file, whatever partitions the list came in.
    spread = files.select("path").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(run, schema)


# Pages by the rule itself; the digest of a payload is that of its UTF-8 bytes.
_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
             max(page_id) OVER (PARTITION BY html) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM q"""


@query(_SQL)
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    files = write_archives(pages, _uri(work_folder(spark, "warc")))
    found = read_archives(files).filter(F.col("problem").isNull())
    number = F.regexp_extract("record_id", r"^urn:page:(-?\d+)$", 1)
    refers = F.regexp_extract("refers_to", r"^urn:page:(-?\d+)$", 1)
    return found.select(
        F.when(number != "", number).cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(refers != "", refers).cast("bigint").alias("refers_to"),
    )


def _uri(path: str) -> str:
    """A path without scheme is a local one, as in a session on one machine."""
    return path if ":" in path.split("/")[0] else f"file://{path}"
