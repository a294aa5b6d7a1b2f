"""Secret scan with a recursive decoding worklist.

Each text is scanned by three patterns. Then its layers are unwrapped: URL
escapes, Unicode escapes, base64 runs, and compressed data in them. Every layer
is scanned like the text itself and unwrapped in turn, until no layer is new;
a layer already seen is not followed again, so cycles end. A finding in a layer
is mapped to the piece of the text that it was decoded from.

Texts are unwrapped in windows that end at bytes which no pattern contains, nor any
escape or base64 run, so that nothing lies over their edges and a layer is a copy of
its window only. Decompressed data is read as a stream of such windows, to its end.

All patterns are ASCII, so the scan works on UTF-8 bytes; places are turned into
code points at the end.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import io
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborscope.llm.base import annotate, query, table

# Kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE,
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_LEAST = {"assign": 12, "access": 18, "hex": 16}
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

_URL = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(rb"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
_BYTES = re.compile(rb"(?:\\x[0-9A-Fa-f]{2})+")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
_BASE64_LINE = re.compile(rb"[A-Za-z0-9+/_-]+={0,2}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
_LINE_END = re.compile(rb"\r?\n[ \t]*")

#: Windows have at least so many bytes, and end after a byte that can't be in any match.
WINDOW = 1 << 14
_EDGE = re.compile(rb"[^A-Za-z0-9+/_.=:\"'%\\\s-]")


def _marks(kept: bytes) -> bytes:
    return bytes(0x78 if c in kept else 0x20 for c in range(256))


_HEX_MARKS = _marks(b"0123456789abcdef")
_BASE64_MARKS = _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


_BROKEN = (OSError, EOFError, zlib.error, zstandard.ZstdError)


class Finding(NamedTuple):
    start: int
    kind: int
    end: int
    base: bool


def _base(text: bytes) -> list[tuple[int, int, int]]:
    """Kind, start and end of the leftmost matches that don't overlap, per kind."""
    out = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        out += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST["assign"]]
    if b"AKIA" in text:
        out += [(1, *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= _LEAST["access"]]
    if b"x" * _LEAST["hex"] in text.translate(_HEX_MARKS):
        out += [(2, *m.span()) for m in _HEX.finditer(text) if len(m[0]) >= _LEAST["hex"]]
    return out


def _unescape_url(run: bytes) -> bytes:
    return bytes.fromhex(run.replace(b"%", b"").decode())


def _unescape_unicode(run: bytes) -> bytes:
    units = b"".join(
        int(x[2:], 16).to_bytes(2, "big") for x in re.findall(rb"\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}", run)
    )
    return units.decode("utf-16-be").encode()


class _Layer:
    """A decoded text; ``spans`` maps its places to spans of the root text."""

    def __init__(self, text: bytes, begins: list[int], spans: list[tuple[int, int]], exact: list[bool]):
        # Piece i begins at begins[i]; if exact it was copied from spans[i], else decoded from it.
        self.text, self.begins, self.spans, self.exact = text, begins, spans, exact

    def root(self, start: int, end: int) -> tuple[int, int]:
        a = bisect_right(self.begins, start) - 1
        b = bisect_right(self.begins, end - 1) - 1
        first, last = self.spans[a], self.spans[b]
        begin = first[0] + (start - self.begins[a] if self.exact[a] else 0)
        return begin, last[0] + end - self.begins[b] if self.exact[b] else last[1]


def _replaced(layer: _Layer, pattern: re.Pattern, decode: Callable[[bytes], bytes]) -> _Layer | None:
    """The layer with all escapes of one kind decoded, or None if there are none."""
    out, begins, spans, exact, size, at = [], [], [], [], 0, 0

    def put(piece: bytes, start: int, end: int, copied: bool) -> None:
        nonlocal size
        if not piece:
            return
        if copied:
            # A copied piece may lie over several pieces of the layer below.
            a = bisect_right(layer.begins, start) - 1
            while a < len(layer.begins) and layer.begins[a] < end:
                stop = layer.begins[a + 1] if a + 1 < len(layer.begins) else len(layer.text)
                low, high = max(start, layer.begins[a]), min(end, stop)
                begins.append(size + low - start)
                spans.append(layer.root(low, high))
                exact.append(layer.exact[a])
                a += 1
        else:
            begins.append(size)
            spans.append(layer.root(start, end))
            exact.append(False)
        out.append(piece)
        size += len(piece)

    changed = False
    for m in pattern.finditer(layer.text):
        try:
            piece = decode(m[0])
        except ValueError:
            continue
        changed = True
        put(layer.text[at : m.start()], at, m.start(), True)
        put(piece, *m.span(), False)
        at = m.end()
    if not changed:
        return None
    put(layer.text[at:], at, len(layer.text), True)
    return _Layer(b"".join(out), begins, spans, exact) if size else None


class _Inflated(io.RawIOBase):
    """Decompressed gzip or zlib data, as far as it is intact."""

    def __init__(self, source: io.BufferedIOBase):
        self.source, self.rest, self.state = source, b"", zlib.decompressobj(47)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if self.state.eof:
                # A further member of the same file may follow.
                self.rest = self.state.unused_data or self.source.read(1 << 16)
                if self.rest[:2] != b"\x1f\x8b":
                    return 0
                self.state = zlib.decompressobj(47)
            given = self.rest or self.source.read(1 << 16)
            data = self.state.decompress(given, len(into))
            self.rest = self.state.unconsumed_tail
            if data or not (given or self.state.eof):
                into[: len(data)] = data
                return len(data)


def _decompressed(source: io.BufferedReader) -> io.BufferedReader | None:
    """A reader of gzip, zlib or zstandard data, None if it is none."""
    try:
        head = source.peek(4)[:4]
        if head[:2] == b"\x1f\x8b" or (
            head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0
        ):
            inner = io.BufferedReader(_Inflated(source))
        elif head == b"\x28\xb5\x2f\xfd":
            inner = io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True))
        else:
            return None
        return inner if inner.peek(1) else None
    except _BROKEN:
        return None


def _windows(source: io.BufferedReader) -> Iterator[bytes]:
    """The data in windows that no match reaches over, up to where it is damaged."""
    kept, fresh = [], True
    while fresh:
        try:
            fresh = source.read1(1 << 16)
        except _BROKEN:
            fresh = b""
        last = max((m.end() for m in _EDGE.finditer(fresh)), default=0)
        kept.append(fresh[:last] if fresh else b"")
        if last or not fresh:
            whole = b"".join(kept)
            if whole:
                yield whole
            kept = [fresh[last:]]
        else:
            kept[-1] = fresh


def _innermost(data: bytes) -> io.BufferedReader:
    """A reader of the data, decompressed as often as needed."""

    def opened(depth: int) -> io.BufferedReader | None:
        reader = io.BufferedReader(io.BytesIO(data))
        for _ in range(depth):
            reader = reader and _decompressed(reader)
        return reader

    depth, seen = 0, set()
    while opened(depth + 1):
        # Data that decompresses to itself ends here.
        digest, reader = hashlib.sha1(), opened(depth)
        for x in _windows(reader):
            digest.update(x)
        if digest.digest() in seen:
            break
        seen.add(digest.digest())
        depth += 1
    return opened(depth)


def _decoded(run: bytes) -> bytes | None:
    """The bytes in a base64 run, or None."""
    body = run.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    try:
        return base64.b64decode(body + b"=" * (-len(body) % 4))
    except binascii.Error:
        return None


def _base64_runs(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and characters of base64 runs, alone and as blocks of lines.

    A block has lines of one length, the last of which may be shorter.
    """
    at = 0
    for m in _BASE64.finditer(text):
        yield (*m.span(), m[0])
        if m.start() < at:
            continue
        lines, end = [m[0]], m.end()
        while not lines[-1].endswith(b"=") and (gap := _LINE_END.match(text, end)):
            line = _BASE64_LINE.match(text, gap.end())
            if not line or len(line[0]) > len(lines[0]):
                break
            lines.append(line[0])
            end = line.end()
            if len(line[0]) < len(lines[0]):
                break
        if len(lines) > 1:
            yield m.start(), end, b"".join(lines)
            # The short last line may itself begin another block.
            at = end - len(lines[-1]) if len(lines[-1]) < len(lines[0]) else end


def _escaped_bytes(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and bytes of escape runs that stand for compressed data."""
    for pattern, mark in ((_URL, b"%"), (_BYTES, b"\\x")):
        if mark in text:
            for m in pattern.finditer(text):
                data = bytes.fromhex(m[0].replace(mark, b"").decode())
                if _decompressed(io.BufferedReader(io.BytesIO(data))):
                    yield (*m.span(), data)


def _compressed_tails(data: bytes) -> Iterator[bytes]:
    """Compressed data that begins within the data and not at its beginning."""
    for m in _MAGIC.finditer(data, 1):
        tail = data[m.start() :]
        if _decompressed(io.BufferedReader(io.BytesIO(tail))):
            yield tail


def _kinds(data: bytes, seen: set[bytes]) -> set[int]:
    """Kinds found in decoded bytes and all their layers; ``seen`` has the windows that are done."""
    found = set()
    for window in _windows(_innermost(data)):
        digest = hashlib.sha1(window).digest()
        if digest not in seen:
            seen.add(digest)
            found |= {f.kind for f in find_secrets(window, seen)}
    return found


def find_secrets(text: bytes, seen: set[bytes] | None = None) -> list[Finding]:
    """Findings in the text and its layers, by start, kind and end; places are bytes."""
    found = {(s, k, e): True for k, s, e in _base(text)}
    start = 0
    while start < len(text):
        edge = _EDGE.search(text, start + WINDOW)
        end = edge.end() if edge else len(text)
        for begin, kind, stop in _layers(text[start:end], seen):
            found.setdefault((start + begin, kind, start + stop), False)
        start = end
    return [Finding(*x, found[x]) for x in sorted(found)]


def _layers(text: bytes, windows: set[bytes] | None) -> set[tuple[int, int, int]]:
    """Start, kind and end of the findings in all layers of a text, not in itself."""
    found = set()
    escaped = b"%" in text or b"\\" in text
    if not escaped and b"x" * 16 not in text.translate(_BASE64_MARKS):
        return found
    root = _Layer(text, [0], [(0, len(text))], [True])
    seen = {hashlib.sha1(text).digest() + repr(root.spans).encode()}
    work = [root]
    while work:
        layer = work.pop()
        new = []
        if b"%" in layer.text:
            new.append(_replaced(layer, _URL, _unescape_url))
        if b"\\" in layer.text:
            new.append(_replaced(layer, _UNICODE, _unescape_unicode))
        runs = list(_escaped_bytes(layer.text))
        if b"x" * 16 in layer.text.translate(_BASE64_MARKS):
            # What precedes a payload may be of its characters too, so it may begin at each of four places.
            runs += [
                (a + i, b, inner)
                for a, b, run in _base64_runs(layer.text)
                for i in range(4)
                if (inner := _decoded(run[i:]))
            ]
            # Compressed data may follow bytes that those characters stand for.
            runs += [(a, b, tail) for a, b, inner in runs for tail in _compressed_tails(inner)]
        for a, b, inner in runs:
            begin, stop = layer.root(a, b)
            if (key := hashlib.sha1(inner).digest() + repr((begin, stop)).encode()) not in seen:
                seen.add(key)
                # All that a run shows is mapped to the run.
                done = set() if windows is None else windows
                found |= {(begin, kind, stop) for kind in _kinds(inner, done)}
        for x in new:
            if x is None or (digest := hashlib.sha1(x.text).digest() + repr(x.spans[:1]).encode()) in seen:
                continue
            seen.add(digest)
            for kind, start, end in _base(x.text):
                begin, stop = x.root(start, end)
                found.add((begin, kind, stop))
            work.append(x)
    return found


def _in_characters(text: bytes, found: list[Finding]) -> list[Finding]:
    if not found or text.isascii():
        return found
    out, at, count = {}, 0, 0
    for place in sorted({x for f in found for x in (f.start, f.end)}):
        count += sum((b & 0xC0) != 0x80 for b in text[at:place])
        out[place], at = count, place
    return [Finding(out[f.start], f.kind, out[f.end], f.base) for f in found]


def scan_secrets(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``secrets``: an array of ``kind, start, end, base`` per row.

    Places are code points, the end is exclusive; ``base`` is false for what only
    a decoded layer shows. Sorted by start, kind (as in ``KINDS``) and end. A
    null or empty text has none; a column named ``secrets`` is replaced.
    """
    shape = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    )

    def prepare() -> Callable[[list[bytes]], list]:
        def compute(texts: list[bytes]) -> list:
            out = [
                [(KINDS[f.kind], f.start, f.end, f.base) for f in _in_characters(x, find_secrets(x))]
                for x in texts
            ]
            names = ("kind", "start", "end", "base")
            return [pa.array([[dict(zip(names, f)) for f in x] for x in out], shape)]

        return compute

    fields = "secrets array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    return annotate(docs, text, fields, prepare, keep)


def redact(text: bytes) -> bytes:
    """The text with every finding, overlapping ones together, replaced by the name of its kind."""
    out, at, last = [], 0, -1
    for f in find_secrets(text):
        if f.start >= last:
            out += [text[at : f.start], f"[{KINDS[f.kind]}]".encode()]
        last = at = max(last, f.end)
    return b"".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Every row with the secrets in its text replaced; a null text stays null."""
    before = docs.columns
    has = "_has_text"

    def prepare() -> Callable[[list[bytes]], list]:
        return lambda texts: [pa.array([redact(x).decode() for x in texts])]

    known = docs.withColumn(has, F.col(f"`{text}`").isNotNull())
    out = annotate(known, text, "_redacted string", prepare)
    new = F.when(F.col(has), F.col("_redacted"))
    return out.select(*(new.alias(c) if c == text else F.col(f"`{c}`") for c in before))


def _joined(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@query()
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    base = F.filter("secrets", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return scan_secrets(docs, keep=["doc_id"]).select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans")
    )
