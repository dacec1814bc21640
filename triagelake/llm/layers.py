"""Secrets in texts and in what is encoded inside them.

Three kinds are looked for in every layer: ``assign`` (a password, token or key with a
value), ``access`` (access key ids) and ``hex`` (long hexadecimal strings). Layer 0 is
the text. From a layer others are made by a worklist: one with all URL escapes decoded,
one with all backslash escapes (``\\uXXXX``, ``\\u{X}``, ``\\UXXXXXXXX``, ``\\xXX``) and one with all
base64 runs (either alphabet, wrapped lines too); decoded bytes that are gzip, zlib,
bzip2, xz or zstd are unpacked, again and again. New layers go on the worklist until
nothing can be decoded any more. A layer equal to one met before, in content and in
places, ends there, so orders of decoding do not multiply work, and a compressed run
that comes out of itself is opened once.

Every character of a layer knows the code points of the text it comes from: an escape
its own, a base64 character those that hold its bits, one out of compressed bytes the
whole run. A find of any layer is reported as the span of the text that it comes from;
equal spans of one kind are one. What cannot be decoded stays as it stands: invalid
UTF-8, lone surrogates, base64 that is no text.

Null and empty texts have no spans. Repeated rows are scanned one by one; ids play no
part and may be null. An empty table gives no rows. Only doc_id and text are read. Texts
are scanned whole; layers are bounded only by ``DECODED_BYTES`` a text, against archives
that unpack without end: a run beyond it is not decoded, and counted in n_unopened.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm import spread
from triagelake.session import ship_package

#: Bytes that the layers of one text may hold together.
DECODED_BYTES = 256 << 20
#: Base64 runs are looked at from this many characters on.
LEAST_BASE64 = 16
KINDS = ("assign", "access", "hex")
_KEYWORD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
_ASSIGN = re.compile(_KEYWORD + r"""\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: True of every text that has a find or can be decoded, in the syntax of RE2.
_SUSPECT = f"(?i:{_KEYWORD})|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}|%[0-9A-Fa-f]{{2}}|\\\\[uUx]|[A-Za-z0-9+/_-]{{{LEAST_BASE64}}}"
SPANS = "doc_id long, spans array<struct<kind: string, start: int, end: int, depth: int>>, n_layers int, n_unopened int"


def finds(text: str) -> list[tuple[int, int, int]]:
    """Kind (its number), start and end of all finds in one layer."""
    out = [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    out += [(1, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(2, *m.span()) for m in _HEX.finditer(text)]
    return out


@dataclass
class Layer:
    text: str
    low: np.ndarray  #: where in the text each character comes from
    high: np.ndarray
    depth: int
    opened: frozenset = frozenset()  #: compressed runs, with their places, that this layer comes out of

    def digest(self) -> bytes:
        h = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"))
        h.update(self.low.tobytes())
        h.update(self.high.tobytes())
        return h.digest()


#: A run of a layer and what it stands for: start, end, text, for each of its characters
#: the places in the run that it comes from, and whether the run was compressed.
Piece = tuple[int, int, str, np.ndarray, np.ndarray, bool]


def _child(layer: Layer, pieces: list[Piece]) -> Layer | None:
    """The layer with its pieces decoded. A compressed run that the layer itself came
    out of, at the same place, is not opened again: only such runs can go on for ever,
    all other decoding makes a layer shorter."""
    texts, lows, highs, at, opened = [], [], [], 0, set()
    for start, end, text, low, high, packed in pieces:
        if packed:
            run = hashlib.blake2b(layer.text[start:end].encode("utf-8", "surrogatepass")).digest(), int(layer.low[start:end].min()), int(layer.high[start:end].max())
            if run in layer.opened:
                continue
            opened.add(run)
        texts += [layer.text[at:start], text]
        lows += [layer.low[at:start], layer.low[start + low]]
        highs += [layer.high[at:start], layer.high[start + high - 1]]
        at = end
    if not at:
        return None
    texts.append(layer.text[at:])
    lows.append(layer.low[at:])
    highs.append(layer.high[at:])
    return Layer("".join(texts), np.concatenate(lows), np.concatenate(highs), layer.depth + 1, layer.opened | opened)


class Budget:
    """Bytes that may still be decoded for a text, and runs it was too small for."""

    def __init__(self, left: int | None = None):
        self.left, self.unopened = DECODED_BYTES if left is None else left, 0

    def take(self, n: int) -> bool:
        if n > self.left:
            self.unopened += 1
            return False
        self.left -= n
        return True


def _inflate(raw: bytes, limit: int) -> bytes:
    parts, size = [], 0
    while raw and size <= limit:
        unpack = zlib.decompressobj(47)  # gzip or zlib
        parts.append(unpack.decompress(raw, limit + 1 - size))
        size += len(parts[-1])
        if not unpack.eof and size <= limit:
            raise zlib.error("cut off")
        raw = unpack.unused_data if unpack.unused_data[:2] == b"\x1f\x8b" else b""
    return b"".join(parts)


def _zstd(raw: bytes, limit: int) -> bytes:
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as reader:
        return reader.read(limit + 1)


_PACKED = (
    (re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]"), _inflate),
    (re.compile(rb"BZh[1-9]1AY&SY"), lambda raw, limit: bz2.BZ2Decompressor().decompress(raw, limit + 1)),
    (re.compile(rb"\xfd7zXZ\x00"), lambda raw, limit: lzma.LZMADecompressor().decompress(raw, limit + 1)),
    (re.compile(rb"\x28\xb5\x2f\xfd"), _zstd),
)


def unpacked(raw: bytes, budget: Budget) -> bytes | None:
    """What compressed bytes hold, through all their layers; None where they hold
    nothing that can be read, unpack to themselves, or don't fit in the budget."""
    met, opened = set(), False
    while True:
        unpack = next((f for magic, f in _PACKED if magic.match(raw)), None)
        if unpack is None:
            return raw if opened else None
        digest = hashlib.blake2b(raw).digest()
        if digest in met:
            return None
        met.add(digest)
        try:
            inner = unpack(raw, budget.left)
        except Exception as error:  # the readers raise errors of their own classes on broken data
            if isinstance(error, MemoryError):
                raise
            return raw if opened else None
        if not budget.take(len(inner)):
            return None
        raw, opened = inner, True


def _as_text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _whole(start: int, end: int, text: str, packed: bool) -> Piece:
    return start, end, text, np.zeros(len(text), np.int64), np.full(len(text), end - start), packed


def _byte_run(start: int, raw: bytes, width: int, budget: Budget) -> Iterator[Piece]:
    """The pieces of a run in which each byte is written with ``width`` characters;
    bytes that are no UTF-8 stay as they are written."""
    inner = unpacked(raw, budget)
    if inner is not None:
        yield _whole(start, start + width * len(raw), _as_text(inner), True)
        return
    at = 0
    while at < len(raw):
        try:
            text, bad, next_ = raw[at:].decode(), len(raw), len(raw)
        except UnicodeDecodeError as error:
            bad, next_ = at + error.start, at + error.end
            text = raw[at:bad].decode()
        if text:
            ends = np.cumsum([len(c.encode()) for c in text]) * width
            yield start + width * at, start + width * bad, text, np.concatenate([[0], ends[:-1]]), ends, False
        at = next_


_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")


def url_pieces(text: str, budget: Budget) -> list[Piece]:
    return [p for m in _URL.finditer(text) for p in _byte_run(m.start(), bytes.fromhex(m.group().replace("%", "")), 3, budget)]


_ESCAPE = re.compile(
    r"(?P<bytes>(?:\\x[0-9A-Fa-f]{2})+)|\\u(?P<high>[Dd][89ABab][0-9A-Fa-f]{2})\\u(?P<low>[Dd][C-Fc-f][0-9A-Fa-f]{2})"
    r"|\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|\\u(?P<four>[0-9A-Fa-f]{4})|\\U(?P<eight>[0-9A-Fa-f]{8})")


def escape_pieces(text: str, budget: Budget) -> list[Piece]:
    out = []
    for m in _ESCAPE.finditer(text):
        if m["bytes"]:
            out += _byte_run(m.start(), bytes.fromhex(m["bytes"].replace("\\x", "")), 4, budget)
            continue
        if m["high"]:
            code = 0x10000 + ((int(m["high"], 16) & 0x3FF) << 10) + (int(m["low"], 16) & 0x3FF)
        else:
            code = int(m["braced"] or m["four"] or m["eight"], 16)
        if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
            out.append(_whole(*m.span(), chr(code), False))
    return out


_BASE64 = re.compile(rf"(?:(?:[A-Za-z0-9+/_-]{{4}}){{15,19}}\r?\n)+[A-Za-z0-9+/_-]+={{0,2}}|[A-Za-z0-9+/_-]{{{LEAST_BASE64},}}={{0,2}}")
_BASE64_LINE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_BASE64},}}={{0,2}}")
_NO_TEXT = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f]")
_STANDARD = str.maketrans("-_", "+/", "\r\n=")


def _decoded(run: str, start: int, budget: Budget) -> Piece | None:
    letters = run.translate(_STANDARD)
    if len(letters) % 4 == 1 or len(letters) < LEAST_BASE64:
        return None
    try:
        raw = base64.b64decode(letters + "=" * (-len(letters) % 4), validate=True)
    except binascii.Error:
        return None
    inner = unpacked(raw, budget)
    if inner is not None:
        return _whole(start, start + len(run), _as_text(inner), True)
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    if _NO_TEXT.search(text):
        return None
    ends = np.cumsum([len(c.encode()) for c in text])
    places = np.array([i for i, c in enumerate(run) if c not in "\r\n="])
    return start, start + len(run), text, places[(ends - np.diff(ends, prepend=0)) * 8 // 6], places[-(-ends * 8 // 6) - 1] + 1, False


def base64_pieces(text: str, budget: Budget) -> list[Piece]:
    out = []
    for m in _BASE64.finditer(text):
        piece = _decoded(m.group(), m.start(), budget)
        if piece:
            out.append(piece)
        elif "\n" in m.group():  # lines that only look like one block
            out += [p for line in _BASE64_LINE.finditer(m.group()) if (p := _decoded(line.group(), m.start() + line.start(), budget))]
    return out


def scan_text(text: str) -> tuple[list[tuple[int, int, int, int]], int, int]:
    """Kind, start, end and depth of all spans in their order, layers met, runs not opened."""
    depth = dict.fromkeys(finds(text), 0)
    places = np.arange(len(text), dtype=np.int64)
    work, budget = [Layer(text, places, places + 1, 0)], Budget()
    met = {work[0].digest()}
    while work:
        layer = work.pop(0)
        for decode in (url_pieces, escape_pieces, base64_pieces):
            child = _child(layer, decode(layer.text, budget))
            if child is None:
                continue
            digest = child.digest()
            if digest in met or not budget.take(len(child.text)):
                continue
            met.add(digest)
            work.append(child)
            for kind, start, end in finds(child.text):
                depth.setdefault((kind, int(child.low[start:end].min()), int(child.high[start:end].max())), child.depth)
    return sorted(((kind, start, end, d) for (kind, start, end), d in depth.items()), key=lambda s: (s[1], s[0], s[2])), len(met), budget.unopened


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans (kind, start, end, depth of the layer; depth 0 is the text itself)
    ordered by start, kind and end, layers and runs left closed."""
    ship_package(docs.sparkSession)
    target = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spread.slices(batches, "text"):
            texts, n = batch.column("text"), batch.num_rows
            spans, layers, unopened = [[] for _ in range(n)], np.ones(n, np.int32), np.zeros(n, np.int32)
            suspect = np.asarray(pc.fill_null(pc.match_substring_regex(texts, _SUSPECT), False))
            for i in np.flatnonzero(suspect).tolist():
                found, layers[i], unopened[i] = scan_text(texts[i].as_py())
                spans[i] = [{"kind": KINDS[k], "start": a, "end": b, "depth": d} for k, a, b, d in found]
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, target), pa.array(layers), pa.array(unopened)],
                                  ["doc_id", "spans", "n_layers", "n_unopened"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, SPANS)


def listed(spans):
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_of(spans):
    return F.filter(spans, lambda s: s["depth"] == 0)


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
