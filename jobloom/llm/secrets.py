"""Secret scan with a recursive decoding worklist.

The text is the first layer.  Each layer is scanned; then whatever is encoded in it gives further layers: percent escapes and
``\\u`` / ``\\x`` escapes decode the whole layer, every base64 run decodes to a layer of its own, unpacked first if it is
compressed, and so does every base64 text wrapped over lines.  A decoded layer is read as UTF-8, or byte by byte if it is none, and
also as UTF-16 if it holds zero bytes; nothing is left out for its characters.  The worklist ends when no new layer appears; a layer seen before at the same place is not taken up again, so
cycles end.  Every character of a layer knows which characters of the text it came from, and findings are reported there: a
finding inside a base64 run spans the whole run.

Spans are half-open and count code points.  Kinds are ``assign``, ``access`` and ``hex``.  The findings of the first layer are
marked ``base``.

Null text: as the empty text, no spans.  Repeated rows give repeated results, an empty table an empty one.  A layer that unpacks to
more than LAYER_BYTES is read in blocks, cut where no finding or encoded run can be.  If a block has no such place, the next one
overlaps it by OVERLAP_BYTES, and the layer is counted in ``oversize``: longer runs in it were read in parts.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import gzip
import hashlib
import io
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes up to which a compressed layer is read in one piece; also the size of blocks.
LAYER_BYTES = 64 * 1024 * 1024
OVERLAP_BYTES = 1024 * 1024
PIECE_BYTES = 1024 * 1024
#: Levels of compression opened within a layer of many blocks.
LEVELS = 100
#: Order in which spans that start together are listed.
KINDS = ("assign", "access", "hex")

# fixed values: the patterns of the three kinds
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Runs that may be base64; a hexadecimal finding always lies inside one.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Such runs over several lines; the last may be short, and stands at the end of its line or before a sign that ends a value.
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})*+(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+={0,2}(?![ \t]*[^\s\"'`<,;)}\]]))?")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: Bytes of findings and encoded runs; blocks are not cut between them.
_BOUND = bytes(set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=.:\"'%\\{} \t\r\n\0"))
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})+")
_ESCAPE_UNIT = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})")

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])
FOUND = T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("layers", T.LongType()), T.StructField("oversize", T.LongType())])

Layer = tuple[str, "np.ndarray | None", "np.ndarray | None"]


def scan(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Findings in one layer: (start, end, kind)."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    for start, end in runs:
        if end - start >= HEX_LENGTH:
            found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text, start, end) if m.end() - m.start() >= HEX_LENGTH]
    return found


def _unescape(run: str) -> str:
    units = [int(a or b or c, 16) for a, b, c in _ESCAPE_UNIT.findall(run)]
    if any(u > 0x10FFFF for u in units):
        return run
    # joins surrogate pairs; half a pair becomes the replacement character
    return "".join(map(chr, units)).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


#: What bytes that are no UTF-8 decode to, and the Latin-1 characters they are read as.
_LATIN = {0xDC00 + b: b for b in range(0x80, 0x100)}


def _unpercent(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape").translate(_LATIN)


def replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match decoded, or None if nothing changes."""
    text, first, last = layer
    parts, spans, at = [], [], 0
    for m in pattern.finditer(text):
        plain = decode(m[0])
        if plain != m[0]:
            parts += [text[at : m.start()], plain]
            spans.append((at, m.start(), m.end(), len(plain), len(m[0]) // max(1, len(plain)) if len(m[0]) % max(1, len(plain)) == 0 else 0))
            at = m.end()
    if not spans:
        return None
    parts.append(text[at:])
    first = np.arange(len(text)) if first is None else first
    last = np.arange(1, len(text) + 1) if last is None else last
    starts, ends = [], []
    for copied, begin, end, size, width in spans:
        starts.append(first[copied:begin])
        ends.append(last[copied:begin])
        if width:  # every character took the same number of escape characters
            starts.append(first[begin:end:width])
            ends.append(last[begin + width - 1 : end : width])
        else:
            starts.append(np.full(size, first[begin]))
            ends.append(np.full(size, last[end - 1]))
    starts.append(first[at:])
    ends.append(last[at:])
    return "".join(parts), np.concatenate(starts), np.concatenate(ends)


class _Zlib:
    """Reader of one zlib stream after the other."""

    def __init__(self, source: io.BufferedReader):
        self.source, self.tool = source, zlib.decompressobj()

    def read1(self, size: int) -> bytes:
        while True:
            data = self.tool.unconsumed_tail or self.tool.unused_data or self.source.read1(size)
            if self.tool.eof:
                self.tool = zlib.decompressobj()
            plain = self.tool.decompress(data, size)
            if plain or not data:
                return plain


class _Pieces(io.RawIOBase):
    """What a reader gives until it ends or breaks."""

    def __init__(self, reader):
        self.reader, self.rest, self.broken = reader, b"", False

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        if not self.rest and not self.broken:
            try:
                self.rest = self.reader.read1(PIECE_BYTES)
            except Exception:  # each library has its own errors for data that is broken or none of its own
                self.broken = True
        n = min(len(out), len(self.rest))
        out[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def _opened(source: io.BufferedReader) -> io.BufferedReader | None:
    """The stream unpacked, all members of it, or None if it is not compressed."""
    head = source.peek(6)[:6]
    if head[:2] == b"\x1f\x8b":
        reader = gzip.GzipFile(fileobj=source)
    elif len(head) > 2 and head[0] == 0x78 and int.from_bytes(head[:2]) % 31 == 0:
        reader = _Zlib(source)
    elif head[:3] == b"BZh":
        reader = bz2.BZ2File(source)
    elif head == b"\xfd7zXZ\x00":
        reader = lzma.LZMAFile(source)
    elif head[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        reader = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
    else:
        return None
    plain = io.BufferedReader(_Pieces(reader), PIECE_BYTES)
    return plain if plain.peek(1) else None


def layer_bytes(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """``data``, then what it unpacks to, level by level; a large level in blocks.  The flag marks a block cut inside a run."""
    seen = set()
    while data not in seen:
        seen.add(data)
        yield data, False
        source = _opened(io.BufferedReader(io.BytesIO(data)))
        if source is None:
            return
        plain = source.read(LAYER_BYTES + 1)
        if len(plain) > LAYER_BYTES:
            break
        data = plain
    else:
        return
    # read again as a stream; a level that begins like a compressed one but does not open is read as it is
    depth = 0
    while depth < LEVELS and _levels(data, depth + 1) is not None:
        depth += 1
    source, cut = _levels(data, depth), depth == LEVELS
    held = b""
    while more := source.read(LAYER_BYTES):
        held += more
        end = len(held.rstrip(_BOUND))
        if end:
            yield held[:end], cut
            held, cut = held[end:], False
        elif len(held) >= 2 * LAYER_BYTES:
            yield held, True
            held = held[-OVERLAP_BYTES:]
    yield held, cut


def _levels(data: bytes, depth: int) -> io.BufferedReader | None:
    """``data`` unpacked so many times, or None if it cannot be."""
    source = io.BufferedReader(io.BytesIO(data))
    for _ in range(depth):
        source = _opened(source)
        if source is None:
            return None
    return source


def texts(data: bytes) -> Iterator[str]:
    """``data`` as UTF-8, or else byte by byte; also as UTF-16 from both byte orders and places if it holds zero bytes."""
    try:
        yield data.decode()
    except UnicodeDecodeError:
        yield data.decode("latin-1")
    if b"\0" in data:
        for kind in ("utf-16-le", "utf-16-be"):
            for at in (0, 1):
                yield data[at:].decode(kind, "replace")


def from_base64(run: str, joined: bool = False) -> bytes | None:
    """Bytes that a run stands for, or None if it stands for none.  Of joined lines the last character may be none of it."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        if not joined:
            return None
        body = body[:-1]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def wrapped_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of base64 over several lines: lines of one width with the shorter line after them, the same with the line
    before them, and all lines together."""
    if "\n" not in text:
        return
    for found in _WRAPPED.finditer(text):
        lines = [m.span() for m in _LINE.finditer(text, *found.span())]
        if len(lines) < 2:
            continue
        parts, at = {(0, len(lines))}, 0
        while at < len(lines):
            width, end = lines[at][1] - lines[at][0], at + 1
            while end < len(lines) and lines[end][1] - lines[end][0] == width:
                end += 1
            stop = end + (end < len(lines) and lines[end][1] - lines[end][0] < width)
            parts |= {(at, end), (at, stop), (max(0, at - 1), stop)}
            at = end
        for a, b in sorted(parts):
            if b - a > 1:
                yield lines[a][0], lines[b - 1][1], "".join(text[x:y] for x, y in lines[a:b])


def find_secrets(text: str) -> tuple[list[tuple[str, int, int, bool]], int, int]:
    """All spans by start, then kind; how many layers were read; how many were cut inside a run, as they were too large."""
    base: set[tuple[int, int, str]] = set()
    more: set[tuple[int, int, str]] = set()
    seen: set[tuple[str | bytes, int, int]] = set()
    layers = oversize = 0

    def inner(layer: Layer, runs: list[tuple[int, int]]) -> Iterator[Layer]:
        nonlocal oversize
        body, first, last = layer
        if "%" in body and (plain := replaced(layer, _PERCENT, _unpercent)):
            yield plain
        if "\\" in body and (plain := replaced(layer, _ESCAPE, _unescape)):
            yield plain
        joined = ((a, b, from_base64(run, True)) for a, b, run in wrapped_runs(body))
        # a path or a word may stand before the first encoded character, so groups of four are tried from all four places
        placed = ((a + k, b, from_base64(body[a + k : b])) for a, b in runs for k in range(4))
        for part in (placed, joined):
            for a, b, data in part:
                if not data:
                    continue
                start, end = (a, b) if first is None else (int(first[a]), int(last[b - 1]))
                large = False
                for block, is_cut in layer_bytes(data):
                    large = large or is_cut
                    for plain in texts(block):
                        yield plain, np.broadcast_to(start, len(plain)), np.broadcast_to(end, len(plain))
                oversize += large

    work: list[Iterator[Layer]] = [iter([(text, None, None)])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        body, first, last = layer
        mark = body if len(body) < 1000 else hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=32).digest()
        key = (mark, -1, -1) if first is None or not len(first) else (mark, int(first[0]), int(last[-1]))
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        runs = [m.span() for m in _RUN.finditer(body)]
        found = scan(body, runs)
        if first is None:
            base.update(found)
        else:
            more.update((int(first[a]), int(last[b - 1]), kind) for a, b, kind in found)
        work.append(inner(layer, runs))
    spans = [(a, KINDS.index(k), b, True) for a, b, k in base] + [(a, KINDS.index(k), b, False) for a, b, k in more - base]
    return [(KINDS[k], a, b, is_base) for a, k, b, is_base in sorted(spans)], layers, oversize


@F.arrow_udf(FOUND)
def _secrets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))), ("layers", pa.int64()), ("oversize", pa.int64())])
    for batch in batches:
        rows = []
        for value in batch:
            spans, layers, oversize = find_secrets(value.as_py() or "")
            rows.append({"spans": [{"kind": k, "start": a, "end": b, "base": s} for k, a, b, s in spans], "layers": layers, "oversize": oversize})
        yield pa.array(rows, kind)


def secrets_column(text: Column) -> Column:
    """Struct of spans (kind, start, end, base), layers, oversize."""
    return _secrets.asNondeterministic()(text)


def redact(text: str) -> str:
    """Every span replaced by its kind in brackets; spans that overlap are one."""
    parts, at, open_until, kind = [], 0, 0, None
    for k, start, end, _ in find_secrets(text)[0]:
        if kind is not None and start < open_until:
            open_until = max(open_until, end)
            continue
        if kind is not None:
            parts.append(f"[{kind}]")
            at = open_until
        parts.append(text[at:start])
        kind, open_until = k, end
    if kind is None:
        return text
    parts += [f"[{kind}]", text[open_until:]]
    return "".join(parts)


@F.arrow_udf(T.StringType())
def _redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array((None if (x := v.as_py()) is None else redact(x) for v in batch), pa.string(), size=len(batch))


def redacted_column(text: Column) -> Column:
    """The text without its secrets; null stays null."""
    return _redacted.asNondeterministic()(text)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
