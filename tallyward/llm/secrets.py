"""Secret scans through nested encodings."""

from __future__ import annotations

import base64
import binascii
import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyward.llm.common import pick, slices

# The three kinds of secrets, in the order of their names in results.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};)+")
ONE_UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]+\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&\#[^;]+;")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# What the first bytes of every gzip stream are in base64.
GZIP = re.compile(r"H4sI")
# Base64 over several lines: a run up to the end of its line, and lines of such characters alone up to the last.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# Bytes that no secret and no encoded run holds: a long stream is cut at one.
SAFE = re.compile(rb"""[^A-Za-z0-9+/_.=\-"'\s:\\%&#;{}\x80-\xff]""")

Span = tuple[int, int, int]  # start, place in KINDS, end


def scan(text: str) -> list[Span]:
    """Spans of one layer: per kind leftmost and non-overlapping; a match that is too short is dropped, not retried."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A decoded text and, for each of its characters, the range of original characters it came from."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _plain(data: bytes) -> tuple[str, bool]:
    """Decoded bytes as text, and whether they are UTF-8; other bytes are one character each, so that none hides a secret."""
    try:
        return data.decode(), True
    except UnicodeDecodeError:
        return data.decode("latin-1"), False


def _char_bytes(text: str) -> np.ndarray:
    """Place of each character's first byte in UTF-8, and the end."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.r_[0, np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))]


def _unescape(run: str) -> str:
    out = []
    for one in ONE_UNICODE.findall(run):
        if one[0] == "&":
            out.append(html.unescape(one))
            continue
        number = int(one[2:].strip("{}"), 16)
        out.append(chr(number) if number < 0x110000 else "\ufffd")
    # Two surrogates written one after the other are one character.
    return "".join(out).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with every run of escapes decoded; a run's characters map to the whole run."""
    pieces: list[str] = []
    sizes: list[tuple[int, int, int]] = []  # source start, source end, decoded length (0: copied)
    at = 0
    for m in pattern.finditer(layer.text):
        decoded = decode(m[0])
        if decoded is None:
            continue
        pieces += [layer.text[at:m.start()], decoded]
        sizes += [(at, m.start(), -1), (m.start(), m.end(), len(decoded))]
        at = m.end()
    if not sizes:
        return None
    pieces.append(layer.text[at:])
    sizes.append((at, len(layer.text), -1))
    starts = np.concatenate([np.arange(a, b) if n < 0 else np.full(n, a) for a, b, n in sizes])
    ends = np.concatenate([np.arange(a + 1, b + 1) if n < 0 else np.full(n, b) for a, b, n in sizes])
    if layer.starts is not None:
        # A run may come from anything inside it, so its range is from its first to its last character's origin.
        starts, ends = layer.starts[starts], layer.ends[ends - 1]
    return Layer("".join(pieces), starts, ends)


def _percent(run: str) -> str:
    return _plain(unquote_to_bytes(run))[0]


def _opens(data: bytes) -> bool:
    """Whether data begin with a gzip or zlib stream."""
    if data[:2] != b"\x1f\x8b" and not (data[:1] == b"x" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0):
        return False
    try:
        return bool(zlib.decompressobj(47).decompress(data, 64))
    except zlib.error:
        return False


def _inflate(data: bytes, most: int) -> Iterator[str]:
    """What gzip or zlib streams, one after the other, hold, in pieces of about ``most`` bytes.

    A broken or cut stream gives what came before the break. A piece ends before a byte that no match spans; if there is
    none near its end, the next one begins with the last thousand bytes again.
    """
    while _opens(data):
        stream, held, rest = zlib.decompressobj(47), b"", data
        while not stream.eof:
            try:
                out = stream.decompress(rest, most)
            except zlib.error:
                break
            if not out:
                break
            held, rest = held + out, stream.unconsumed_tail
            if len(held) >= most and not stream.eof:
                cuts = [m.start() for m in SAFE.finditer(held, max(0, len(held) - 100_000))]
                yield _plain(held[:cuts[-1]] if cuts else held)[0]
                held = held[cuts[-1] if cuts else max(1, len(held) - 1000):]
        if held:
            yield _plain(held)[0]
        if not stream.eof:
            return
        data = stream.unused_data


def _base64(body: str) -> bytes | None:
    body = body.rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:  # one character too many is not of the encoded text
        body = body[:-1]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _starts(run: re.Match) -> Iterator[re.Match]:
    """The run and the parts of it that may be the encoded text, where other characters of the alphabet stand before it.

    From each of four places in a row the rest is read: one of them is in step with encoded text that begins anywhere, and
    what stands before it becomes a few odd bytes. A compressed stream has to begin where reading does, so the parts
    between slashes, dashes and the like are read as well, and what follows the letters that every gzip stream has first.
    """
    yield run
    text, start, end = run.string, run.start(), run.end()
    places = {start + k for k in (1, 2, 3)} | {m.start() for m in GZIP.finditer(text, start + 1, end)}
    for place in sorted(places):
        part = BASE64.match(text, place, end)
        if part:
            yield part
    for separators in (r"[/]", r"[-_]", r"[/_+-]"):
        if re.search(separators, run[0]):
            for part in re.compile(rf"[A-Za-z0-9+/_=-]+?(?={separators}|\Z)").finditer(text, start, end):
                body = part.start() + len(part[0]) - len(part[0].lstrip("/_+-="))
                piece = BASE64.match(text, body, part.end())
                if piece and (piece.start(), piece.end()) != (start, end):
                    yield piece


def _worth(text: str) -> bool:
    return bool(PERCENT.search(text) or UNICODE.search(text) or BASE64.search(text) or scan(text))


def _joined(text: str) -> Iterator[tuple[list[re.Match], bytes, bool]]:
    """Lines that may be one base64 run, what they encode, and whether that is text or a compressed stream.

    All lines of a run but the first (which may follow other text) and the last (shorter) have one width. The lines before
    and after may be words that only look like base64, so runs without them are tried as well.
    """
    for m in WRAPPED.finditer(text):
        lines = list(LINE.finditer(text, m.start(), m.end()))
        i = 0
        while i + 1 < len(lines):
            width, j = len(lines[i + 1][0]), i + 1
            while j + 1 < len(lines) and len(lines[j][0]) == width >= len(lines[j + 1][0].rstrip("=")):
                j += 1
            tried = []
            for a, b in [(i, j), (i + 1, j), (i, j - 1), (i + 1, j - 1)]:
                data = _base64("".join([x[0] for x in lines[a:b + 1]])) if a < b else None
                if data is not None:
                    good = _opens(data) or _plain(data)[1]
                    tried.append((lines[a:b + 1], data, good))
                    if good:
                        break
            yield from tried[-1:] if tried and tried[-1][2] else tried
            i = j


def _encoded(layer: Layer, most: int) -> Iterator[Layer]:
    """Layers inside base64 runs, on one line or wrapped: text, or the text of a compressed stream."""
    runs = list(_joined(layer.text))
    whole = {x.start() for lines, _, good in runs if good for x in lines}
    single = ([part] for m in BASE64.finditer(layer.text) if m.start() not in whole for part in _starts(m))
    for lines, data in [*((x, y) for x, y, _ in runs), *((x, _base64(x[0][0])) for x in single)]:
        if data is None:
            continue
        if _opens(data):
            for text in _inflate(data, most):
                yield _mapped(layer, text, np.full(len(text), lines[0].start()), np.full(len(text), lines[-1].end()))
            continue
        text, utf8 = _plain(data)
        if _worth(text):
            place = _char_bytes(text) if utf8 else np.arange(len(data) + 1)
            first, last = place[:-1], place[1:] - 1
            where = np.concatenate([np.arange(x.start(), x.end()) for x in lines])
            yield _mapped(layer, text, where[first // 3 * 4 + first % 3],
                          where[np.minimum(last // 3 * 4 + last % 3 + 1, len(where) - 1)] + 1)


def _mapped(layer: Layer, text: str, starts: np.ndarray, ends: np.ndarray) -> Layer:
    return Layer(text, starts, ends) if layer.starts is None else Layer(text, layer.starts[starts], layer.ends[ends - 1])


def _children(layer: Layer, most: int) -> Iterator[Layer]:
    found = [_replaced(layer, PERCENT, _percent)] if "%" in layer.text else []
    if "\\" in layer.text or "&#" in layer.text:
        found.append(_replaced(layer, UNICODE, _unescape))
    yield from filter(None, found)
    yield from _encoded(layer, most)


def _mark(layer: Layer) -> tuple[bytes, int, int]:
    """A layer's text and the range of the original text it came from."""
    place = layer.origin(0, len(layer.text)) if layer.text else (0, 0)
    return hashlib.sha1(layer.text.encode("utf-8", "surrogatepass")).digest(), *place


def find(text: str, most: int = 64 << 20) -> tuple[list[Span], list[Span]]:
    """Spans of the text itself, and all spans: with those of nested layers, in characters of the original text.

    Worklist until fixpoint: each layer is scanned, then unwrapped in every way that applies (percent escapes, Unicode
    escapes, base64, compressed base64); a layer whose text was seen before at the same place is not opened again, so
    cycles end and every copy of a repeated blob is opened.
    Bytes that are not text do not keep a layer closed. A compressed stream is read in pieces of about ``most`` bytes, one
    at a time, against decompression bombs.
    """
    base = scan(text)
    spans = set(base)
    seen = {_mark(Layer(text))}
    work = [_children(Layer(text), most)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
            continue
        mark = _mark(child)
        if mark in seen:
            continue
        seen.add(mark)
        for start, kind, end in scan(child.text):
            first, last = child.origin(start, end)
            spans.add((first, kind, last))
        work.append(_children(child, most))
    return base, sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones joined) replaced by the mark."""
    out, at = [], 0
    merged: list[list[int]] = []
    for start, _, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scan_documents(documents: DataFrame, keep: tuple[str, ...] = (), redacted: bool = False) -> DataFrame:
    """``(doc_id, *keep, n_assign, n_access, n_hex, base_sha256, spans)``, one row per row; with ``text`` if redacted.

    The counts and the digest are those of the text itself; ``spans`` has those of nested layers too, as
    ``kind:start:end`` in code points of the original text. A null or empty text has none (the digest of an empty
    string); with ``redacted`` a null text stays null. Repeated rows, null ids and the columns in ``keep`` pass
    through; an empty table has no result. Texts are scanned whole, one at a time.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, texts = [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                base, spans = find(text or "")
                counts = np.bincount([kind for _, kind, _ in base], minlength=3).tolist()
                rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
                texts.append(redact(text, spans) if redacted and spans else text)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            out = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            out += [pa.array(x, t) for x, t in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2, strict=True)]
            names = [n for n in batch.schema.names if n != "text"] + ["n_assign", "n_access", "n_hex", "base_sha256",
                                                                      "spans"]
            if redacted:
                out, names = [*out, pa.array(texts, pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    rows = pick(documents, "doc_id", *keep, "text")
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep))
    schema += ", n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(work, schema + (", text string" if redacted else ""))
