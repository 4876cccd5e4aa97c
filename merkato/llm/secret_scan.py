"""Secret scans through encoded layers.

A text is scanned for the base kinds; then a worklist unwraps what the text holds: percent escapes, Unicode and
HTML escapes, base64 tokens (wrapped ones too), and compressed bytes inside those. Every layer that comes out is scanned as well and put
on the list in its turn, until nothing new comes out. A layer that was seen before at the same place is not taken
again, so encodings that lead back to themselves end. Each character of a layer knows the span of the original
text it comes from, and a finding in a layer is given as that span, in code points.

Texts are scanned where they are read, one at a time; nothing is exchanged. Compressed bytes are unpacked as a stream,
all members of it, and compressed bytes inside them likewise; what comes out is scanned in pieces of ``PIECE`` bytes that
overlap by ``OVERLAP``, and every finding in it has the span of the whole token. So however much a token unpacks to, a
few pieces are held at a time. A stream that unpacks to what was unpacked before ends there; of a stream that breaks off,
what came before is scanned.

Defined cases: a null or empty text has no findings; repeated rows are scanned one by one; an empty table gives no
rows; a null id is kept; other columns are not read; text that only looks encoded stays what it is; a very long text needs
some 40 bytes for each character of a layer that was not compressed; a token inside compressed bytes that is longer than
``OVERLAP`` may be read in two parts. A token is also read from behind each slash, hyphen and underscore in it. Decoded bytes that are no text are scanned as Latin-1, from each of the four
places where a token can begin, and not unwrapped further; they are no layer.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import gzip
import hashlib
import io
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.llm.common import ship

#: Fixed values of the contract: the kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}"
    r"|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[xX][0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
#: A token and what stands below it; the breaks between lines may be written as escapes.
BREAK = r"(?:\r?\n|\\r\\n|\\n)[ \t]*"
TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}(?:{BREAK}[A-Za-z0-9+/_-]+)*={{0,2}}")
BREAKS = re.compile(BREAK)
SEPARATOR = re.compile("[/_-]")
LEAST_TOKEN = 16
#: Share of printable characters from which decoded bytes count as text.
PRINTABLE = 0.9
#: Unpacked bytes that are scanned in one go, by how much such pieces overlap, and bytes that tell streams apart.
PIECE, OVERLAP, HEAD = 4 << 20, 64 << 10, 64 << 10


def findings(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """Decoded text; ``low[i]`` and ``high[i]`` bound what character ``i`` comes from.

    None stands for the original itself, a number for all characters alike.
    """

    __slots__ = ("text", "low", "high")

    def __init__(self, text: str, low=None, high=None):
        self.text, self.low, self.high = text, low, high

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.low is None:
            return start, end
        return (self.low, self.high) if isinstance(self.low, int) else (int(self.low[start]), int(self.high[end - 1]))

    def key(self) -> bytes:
        if self.low is None or isinstance(self.low, int):
            place = f"{self.low} {self.high}".encode()
        else:
            place = self.low.tobytes() + self.high.tobytes()
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass") + b"\0" + place, digest_size=16).digest()


def _text_with_bytes(raw: bytes) -> tuple[str, np.ndarray]:
    """Bytes as text, and for each character how many bytes it had; Latin-1 where they are no UTF-8."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1"), np.ones(len(raw), np.int64)
    codes = np.array([ord(c) for c in text], np.int64)
    return text, 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match decoded; ``decode`` gives the text and the source length of each character."""
    parts, low, high, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        made = decode(m[0])
        if made is None:
            continue
        text, widths = made
        parts += [layer.text[at:m.start()], text]
        if not isinstance(layer.low, int):
            ends = m.start() + np.cumsum(widths)
            low += [np.arange(at, m.start()), ends - widths]
            high += [np.arange(at, m.start()) + 1, ends]
        at = m.end()
    if not parts:
        return None
    parts.append(layer.text[at:])
    if isinstance(layer.low, int):
        return Layer("".join(parts), layer.low, layer.high)
    low.append(np.arange(at, len(layer.text)))
    high.append(low[-1] + 1)
    low, high = np.concatenate(low).astype(np.int64), np.concatenate(high).astype(np.int64)
    if layer.low is not None:
        low, high = layer.low[low], layer.high[high - 1]
    return Layer("".join(parts), low, high)


def _percent(run: str):
    raw = bytes.fromhex(run.replace("%", ""))
    text, widths = _text_with_bytes(raw)
    return text, widths * 3


def _escape(run: str):
    if len(run) == 12 and run.startswith("\\u"):
        code = 0x10000 + ((int(run[2:6], 16) - 0xD800) << 10) + int(run[8:], 16) - 0xDC00
    elif run.startswith("&#"):
        code = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
    else:
        code = int(run[2:].strip("{}"), 16)
    if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
        return None
    return chr(code), np.array([len(run)])


class _Steps(io.RawIOBase):
    """Reads another reader one step at a time, so that what comes before an error is not lost with it."""

    def __init__(self, step):
        self.step = step

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        made = self.step(len(buffer))
        buffer[:len(made)] = made
        return len(made)


class _Zlib(io.RawIOBase):
    """Reads what a zlib stream holds."""

    def __init__(self, source: io.BufferedReader):
        self.source, self.stream, self.left = source, zlib.decompressobj(), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.stream.eof:
            self.left = self.left or self.source.read1(HEAD)
            if not self.left:
                return 0
            made = self.stream.decompress(self.left, len(buffer))
            self.left = self.stream.unconsumed_tail
            if made:
                buffer[:len(made)] = made
                return len(made)
        return 0


def _opened(source: io.BufferedReader) -> io.BufferedReader | None:
    """A reader of what a gzip, zlib, bzip2 or zstandard stream holds, None for other bytes.

    Text can begin like a stream, so the first bytes are tried apart.
    """
    head = source.peek(HEAD)
    reader = _by_head(io.BufferedReader(io.BytesIO(head)), head)
    if reader is None:
        return None
    try:
        reader.read(1)
    except EOFError:
        pass  # there is more of it than the head
    return _by_head(source, head)


def _by_head(source: io.BufferedReader, head: bytes) -> io.BufferedReader | None:
    if head[:2] == b"\x1f\x8b":
        inner = _Steps(gzip.GzipFile(fileobj=source).read1)
    elif head[:1] == b"\x78" and len(head) > 1 and int.from_bytes(head[:2]) % 31 == 0:
        inner = _Zlib(source)
    elif head[:3] == b"BZh":
        inner = _Steps(bz2.BZ2File(source).read1)
    elif head[:4] == b"\x28\xb5\x2f\xfd":
        inner = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
    else:
        return None
    return io.BufferedReader(inner, HEAD)


#: What the readers raise for bytes that are no stream of their kind, or end too soon.
_NO_STREAM = (zlib.error, OSError, ValueError, EOFError, zstandard.ZstdError)


def _content(raw: bytes):
    """What compressed bytes hold, in overlapping pieces; nothing for other bytes."""
    reader, seen = io.BufferedReader(io.BytesIO(raw), HEAD), set()
    try:
        while True:
            head = hashlib.blake2b(reader.peek(HEAD), digest_size=16).digest()
            if head in seen:  # the stream leads back to itself
                return
            seen.add(head)
            try:
                inner = _opened(reader)
            except _NO_STREAM:
                inner = None
            if inner is None:
                break
            reader = inner
    except _NO_STREAM:
        return
    if len(seen) == 1:
        return
    held, ended = b"", False
    while not ended:
        parts = [held]
        size = len(held)
        while size < PIECE:
            try:
                part = reader.read1(HEAD)
            except _NO_STREAM:
                part = b""
            if not part:
                ended = True
                break
            parts.append(part)
            size += len(part)
        piece = b"".join(parts)
        if len(piece) > len(held):
            yield piece
        held = piece[-OVERLAP:]


def _piece_text(piece: bytes) -> tuple[str, bool]:
    """A piece as text, and whether it is any; a character cut off at either end is left out."""
    start = next((k for k in range(min(4, len(piece))) if piece[k] & 0xC0 != 0x80), 0)
    for end in range(len(piece), max(len(piece) - 4, start), -1):
        if (text := _readable(memoryview(piece)[start:end])) is not None:
            return text, True
    return piece.decode("latin-1"), False


def _readable(raw: bytes | memoryview) -> str | None:
    try:
        text = str(raw, "utf-8")
    except UnicodeDecodeError:
        return None
    good = sum(map(str.isprintable, text)) + text.count("\t") + text.count("\r") + text.count("\n")
    return text if text and good >= PRINTABLE * len(text) else None


def _lines(start: int, run: str) -> list[tuple[int, int]]:
    """The spans of the lines of a run of base64 lines."""
    edges = [start, *[start + x for m in BREAKS.finditer(run) for x in m.span()], start + len(run)]
    return list(zip(edges[::2], edges[1::2], strict=True))


def _groups(lines: list[tuple[int, int]]):
    """Lines that may be one token: each alone, and a first one with lines of one width and a shorter last one.

    What follows a token can look like its last lines, so groups without these are given too.
    """
    for line in lines:
        if line[1] - line[0] >= LEAST_TOKEN:
            yield [line]
    at = 0
    while at + 1 < len(lines):
        width, end = lines[at + 1][1] - lines[at + 1][0], at + 2
        while end < len(lines) and lines[end][1] - lines[end][0] == width:
            end += 1
        full = end
        if end < len(lines) and lines[end][1] - lines[end][0] < width:
            end += 1
        if lines[at][1] - lines[at][0] >= LEAST_TOKEN:
            for last in range(end, max(end - 3, at + 1), -1):
                yield lines[at:last]
        at = max(full - 1, at + 1)


def _tokens(layer: Layer):
    """``(layer, is text)`` inside base64 tokens: their content, or that of what they hold compressed."""
    for m in TOKEN.finditer(layer.text):
        for lines in _groups(_lines(m.start(), m[0])):
            yield from _decoded(layer, lines)


def _decoded(layer: Layer, lines: list[tuple[int, int]]):
    body = "".join(layer.text[a:b] for a, b in lines).rstrip("=").replace("-", "+").replace("_", "/")
    place = np.concatenate([np.arange(a, b) for a, b in lines])[:len(body)]
    end = lines[-1][1]
    raws = []
    for first in range(4):
        part = body[first:]
        part = part[:-1] if len(part) % 4 == 1 else part
        try:
            raws.append(base64.b64decode(part + "=" * (-len(part) % 4), validate=True))
        except binascii.Error:
            raws.append(b"")

    def whole(text: str, start: int) -> Layer:
        """A layer of which every character comes from the whole token."""
        return Layer(text, *layer.span(int(place[start]), end))

    def made(text: str, raw: bytes, start: int) -> Layer:
        if isinstance(layer.low, int):
            return Layer(text, layer.low, layer.high)
        ends = np.cumsum(_text_with_bytes(raw)[1])
        starts = np.concatenate(([0], ends[:-1]))
        low = place[start + starts * 8 // 6]
        high = place[np.minimum(start - (-ends * 8 // 6), len(body)) - 1] + 1
        if layer.low is not None:
            low, high = layer.low[low], layer.high[high - 1]
        return Layer(text, low.astype(np.int64), high.astype(np.int64))

    source = "".join(layer.text[a:b] for a, b in lines)
    starts = [0, *[x.end() for x in SEPARATOR.finditer(source) if x.end() <= len(body) - 4]]
    read: set[int] = set()  # a later start in step with a readable one gives a part of its text
    for start in starts:
        if start % 4 in read:
            continue
        raw = memoryview(raws[start % 4])[start // 4 * 3:]
        if bytes(raw[:2]) in (b"\x1f\x8b", b"BZ", b"\x28\xb5") or bytes(raw[:1]) == b"\x78":
            packed = False
            for piece in _content(bytes(raw)):
                packed = True
                text, is_text = _piece_text(piece)
                yield whole(text, start), is_text
            if packed:
                continue
        if (text := _readable(raw)) is not None:
            read.add(start % 4)
            yield made(text, bytes(raw), start), True
    for first in set(range(4)) - read:
        text = raws[first].decode("latin-1")
        if findings(text):
            # One character a byte, whatever the bytes are.
            yield made(text, bytes(len(text)), first), False


def unwrapped(layer: Layer):
    """What one step of decoding makes of a layer, one after the other, and whether that is text to go on with."""
    if "%" in layer.text and (made := _replaced(layer, PERCENT, _percent)) is not None:
        yield made, True
    if ("\\" in layer.text or "&#" in layer.text) and (made := _replaced(layer, ESCAPE, _escape)) is not None:
        yield made, True
    yield from _tokens(layer)


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base findings, all findings, and the number of layers unwrapped."""
    first = Layer(text or "")
    base = findings(first.text)
    every, todo, seen = set(base), [first], {first.key()} if first.text else set()
    while todo:
        for layer, is_text in unwrapped(todo.pop()):
            if is_text:
                if (key := layer.key()) in seen:
                    continue
                seen.add(key)
                todo.append(layer)
            for start, kind, end in findings(layer.text):
                low, high = layer.span(start, end)
                every.add((low, kind, high))
    return base, sorted(every), max(len(seen) - 1, 0)


def _joined(found) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per document: ``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_layers)``.

    The counts are those of the base findings.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]

    def run(batches):
        for batch in batches:
            columns = [[] for _ in names[1:]]
            for text in batch.column("text"):
                base, every, layers = scan(text.as_py())
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                for column, value in zip(columns, [*counts, digest, _joined(every), layers], strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types[1:], strict=True)]], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long")


ship(__name__)
