"""Secrets in texts and in what is encoded inside them, at any depth.

A worklist holds layers. A layer is a text whose every character knows the range
of the document's code points that it was decoded from. Layer 0 is the document.
Each layer is scanned for secrets and searched for encoded regions: percent
escapes, Unicode escapes (``\\uXXXX``, ``\\u{X}``, ``\\xXX``, ``%uXXXX``, numeric
character references), base64 with either alphabet, and gzip, zlib, bzip2 or xz
data inside base64. What a region decodes to is a new layer, whatever bytes it
has: those that are no UTF-8 become U+FFFD, and where there are NULs it is read as
UTF-16 too. Base64 that line ends wrap is joined. Escapes are decoded a
line at a time, all of a kind at once, as a secret may have spaces in it.
The work ends when no layer yields a new one. A layer (its text and its place) that
was met before isn't taken again, so cycles end too, such as data that
decompress to themselves.

A secret found in a decoded layer is reported with the span of the document that
its characters come from; of decompressed data that is the whole encoded region.
Decompression is stopped at ``MAX_LAYER_BYTES`` a region as a guard against bombs;
regions concerned, and those whose compressed data end early, are counted in
``stopped``, not passed over in silence.

An escape nested in itself (``%252525...``) is unwound at once, so depth costs nothing; the spans of a layer are two arrays of
numbers, so very long lines are scanned whole within some 60 bytes a character.

Defined results: a null or empty text has no spans; equal spans of one kind
are reported once, the outermost layer's; overlapping finds of different kinds
are all reported; repeated rows are scanned each; an empty table gives an empty
table; other columns pass through, those named like an output are replaced.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import itertools
import lzma
import re
import struct
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lumenflow.llm.textops import add_columns

KINDS = ("assign", "access", "hex")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
MIN_BASE64 = 16
MAX_LAYER_BYTES = 64 << 20


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + f"|{_either_case('api')}_?{_either_case('key')}"
_ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # runs are maximal, so shorter ones can be left out at once

#: What is decoded together: a line (no secret has other white space than a space), and lines that wrapped base64 may join.
_STRETCH = re.compile(r"[\S\x20]+(?:(?<=[A-Za-z0-9+/_;}-])\r?\n(?=[A-Za-z0-9+/_%&\\-])[\S\x20]+)*")
#: Escapes of an escape's own first character, so many deep that they are unwound at once: %252525... is a percent sign,
#: whatever the depth, as is every layer in between.
_DEEP_PERCENT = r"%(?:25){3,}"
_DEEP_ESCAPE = r"\\(?:u005[cC]){3,}|\\(?:x5[cC]){3,}|%(?:u0025){3,}|&(?:#38;){3,}|&(?:#[xX]26;){3,}"
_PERCENT = re.compile(rf"{_DEEP_PERCENT}|(?:%[0-9A-Fa-f]{{2}})+")
_ESCAPE = re.compile(
    rf"{_DEEP_ESCAPE}|" r"(?:\\u[0-9A-Fa-f]{4}|%u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[xX][0-9A-Fa-f]{1,6};|&#[0-9]{1,7};"
)
_DEEP = re.compile(_DEEP_ESCAPE)
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+(?:\r?\n[A-Za-z0-9+/_-]+)+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_URL_SAFE = str.maketrans("-_", "+/")

Span = tuple[int, int]
#: Where each character of a decoded text starts and ends in the layer around it (or in the document): two arrays, 16 bytes a character.
Spans = tuple[np.ndarray, np.ndarray]
#: A layer: its text and its characters' spans in the document (None: the document itself).
Layer = tuple[str, Spans | None, str]


def find(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the secrets in one layer."""
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_VALUE:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= MIN_ACCESS:
                yield 1, m.start(), m.end()
    for m in _HEX.finditer(text):
        yield 2, m.start(), m.end()


def _cuts(raw: bytes) -> tuple[str, list[int], list[int]]:
    """Decoded text (a byte that fits nothing is U+FFFD), and per character its first and last byte."""
    text, first, last, at = [], [], [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                text.append(raw[at : at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            text.append("\ufffd")
            n = 1
        n = min(n, len(raw) - at)
        first.append(at)
        last.append(at + n - 1)
        at += n
    return "".join(text), first, last


def _utf8(raw: bytes, spans: Spans) -> tuple[str, Spans]:
    """Decoded text, and per character its bytes' span."""
    if raw.isascii():
        return raw.decode(), spans
    text, first, last = _cuts(raw)
    return text, (spans[0][np.array(first, np.int64)], spans[1][np.array(last, np.int64)])


def _unescaped(stretch: str, at: int, pattern: re.Pattern, decode) -> tuple[str, Spans]:
    """A stretch with the matches of ``pattern`` decoded, and the spans of its characters in the layer."""
    text, begin, end, made, starts, ends = [], array("q"), array("q"), array("q"), array("q"), array("q")
    last = 0
    for m in pattern.finditer(stretch):
        a, b = m.span()
        new, x, y = decode(m.group())
        text += (stretch[last:a], new)
        begin.append(a)
        end.append(b)
        made.append(len(new))
        starts.extend([a + v for v in x])
        ends.extend([a + v for v in y])
        last = b
    text.append(stretch[last:])
    begin, end, made, starts, ends = (np.frombuffer(v, np.int64) if len(v) else np.zeros(0, np.int64) for v in (begin, end, made, starts, ends))
    # where the decoded characters stand in the new text; all others keep their place in the stretch
    before = np.cumsum(made) - made
    place = np.repeat(begin - (np.cumsum(end - begin) - (end - begin)) + before, made) + np.arange(len(starts)) - np.repeat(before, made)
    edges = np.zeros(len(stretch) + 1, np.int8)
    edges[begin] += 1
    edges[end] -= 1
    plain = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int8) == 0)
    first, after = np.empty(len(plain) + len(starts), np.int64), np.empty(len(plain) + len(starts), np.int64)
    rest = np.ones(len(first), bool)
    rest[place] = False
    first[place], after[place], first[rest], after[rest] = starts, ends, plain, plain + 1
    return "".join(text), (first + at, after + at)


def _percent(run: str) -> tuple[str, list[int], list[int]]:
    """Decoded text of a run, and where in the run its characters start and end."""
    if run[1:7] == "252525" and "%" not in run[1:]:
        return "%", [0], [len(run)]
    text, first, last = _cuts(bytes.fromhex(run.replace("%", "")))
    return text, [3 * v for v in first], [3 * v + 3 for v in last]


def _escape(run: str) -> tuple[str, list[int], list[int]]:
    if _DEEP.fullmatch(run):
        return run[0], [0], [len(run)]
    if run[1] in "u" and run[2] != "{":  # a run of UTF-16 units
        units = [int(run[i + 2 : i + 6], 16) for i in range(0, len(run), 6)]
        text, starts, ends, i = [], [], [], 0
        while i < len(units):
            n = 2 if 0xD800 <= units[i] < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000 else 1
            code = 0x10000 + (units[i] - 0xD800) * 0x400 + units[i + 1] - 0xDC00 if n == 2 else units[i]
            text.append(_character(code))
            starts.append(6 * i)
            ends.append(6 * (i + n))
            i += n
        return "".join(text), starts, ends
    digits = run[3:-1] if run[:3] in ("&#x", "&#X", "\\u{") else run[2:-1] if run[0] == "&" else run[2:]
    return _character(int(digits, 10 if run[0] == "&" and run[2] not in "xX" else 16)), [0], [len(run)]


def _character(code: int) -> str:
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _unpacker(raw: bytes):
    """A decompressor for what ``raw`` begins with, or None."""
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return zlib.decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _unpack(raw: bytes) -> tuple[bytes | None, bool]:
    """(the data inside compressed ``raw``, all streams of it, or None; whether they were stopped or end early)."""
    out = b""
    some = False
    while (unpacker := _unpacker(raw)) is not None:
        if len(out) >= MAX_LAYER_BYTES:
            return out, True
        try:
            made = unpacker.decompress(raw, MAX_LAYER_BYTES - len(out))
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            break
        if not unpacker.eof and not made and raw[0] & 15 == 8:  # two bytes only speak for zlib data
            break
        some, out = True, out + made
        if not unpacker.eof:
            return out, True
        raw = unpacker.unused_data
    return (out if some else None), False


def _worth(text: str) -> bool:
    """Whether a layer can have secrets or encoded regions."""
    searches = (_PERCENT, _ESCAPE, _BASE64, _WRAPPED)
    return next(find(text), None) is not None or any(p.search(text) for p in searches)


def _texts(raw: bytes, spans: Spans | None) -> Iterator[tuple[str, Spans | None]]:
    """``raw`` as UTF-8 and, if it has NULs, as UTF-16 of either order from either byte on: (text, spans)."""
    if _worth(raw.decode("latin-1")):  # all that is searched for is ASCII
        yield _utf8(raw, spans) if spans is not None else (raw.decode(errors="replace"), None)
    if b"\0" in raw:
        for first in (0, 1):
            for order in "<>":
                n = (len(raw) - first) // 2
                text = "".join(map(_character, struct.unpack_from(f"{order}{n}H", raw, first)))
                if _worth(text):
                    yield text, spans and (spans[0][first : first + 2 * n : 2], spans[1][first + 1 : first + 2 * n : 2])


def _wraps(sizes: list[int]) -> list[tuple[int, int]]:
    """Ranges of lines that may be one wrapped run: all, and lines of one width with a line of another before or after."""
    out = {(0, len(sizes))}
    begin = 0
    for width, same in itertools.groupby(sizes):
        end = begin + len(list(same))
        out |= {(x, y) for x in (max(0, begin - 1), begin) for y in (end, min(len(sizes), end + 1)) if y - x > 1}
        begin = end
    return sorted(out)


def _runs(text: str) -> Iterator[tuple[str, np.ndarray, Span]]:
    """(characters, their places, the region) of base64 runs in a line or over several."""
    for m in _BASE64.finditer(text):
        body = m.group().rstrip("=")
        yield body, np.arange(m.start(), m.start() + len(body)), m.span()
    for m in _WRAPPED.finditer(text) if "\n" in text else ():
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in _LINE.finditer(m.group())]
        for i, j in _wraps([b - a for a, b in lines]):
            part = lines[i:j]
            if sum(b - a for a, b in part) >= MIN_BASE64:
                at = np.concatenate([np.arange(*p) for p in part])
                yield "".join(text[a:b] for a, b in part), at, (part[0][0], m.end() if j == len(lines) else part[-1][1])


def _from_base64(body: str, at: np.ndarray) -> Iterator[tuple[str, str | None, Spans | None]]:
    """(how, text, spans or None for the whole run) of what a base64 run holds; without text: whether its data end, "" if not."""
    if len(body) % 4 == 1:
        return
    try:
        raw = base64.b64decode(body.translate(_URL_SAFE) + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return
    byte = np.arange(len(raw)) * 8
    spans = at[byte // 6], at[(byte + 7) // 6] + 1
    for text, where in _texts(raw, spans):
        yield "base64", text, where
    how, met = "base64", {raw}
    while True:
        raw, stopped = _unpack(raw)
        if raw is None:
            return
        yield ("" if stopped else "whole"), None, None
        if raw in met:
            return
        met.add(raw)
        how += "+unpacked"
        for text, _ in _texts(raw, None):
            yield how, text, None


def _layers(text: str) -> Iterator[tuple[str, str | None, Spans | None, Span]]:
    """What a layer's encoded regions hold: (how, text, spans or None, the region); without text: regions not read to their end."""
    percent = "%" in text and _PERCENT.search(text)
    escape = ("\\" in text or "&#" in text or "%u" in text) and _ESCAPE.search(text)
    if percent or escape:
        for stretch in _STRETCH.finditer(text):
            for how, pattern, decode in (("url", _PERCENT, _percent), ("unicode", _ESCAPE, _escape)):
                if pattern.search(stretch.group()):
                    yield (how, *_unescaped(stretch.group(), stretch.start(), pattern, decode), stretch.span())
    short: dict[int, Span] = {}
    whole: set[int] = set()  # a wrapped run's first line alone ends early, the run doesn't
    for body, at, region in _runs(text):
        parts = list(_from_base64(body, at))
        ends = [how for how, made, _ in parts if made is None]
        if "" in ends:
            short[region[0]] = max(region, short.get(region[0], region))
        elif ends:
            whole.add(region[0])
        yield from ((how, made, spans, region) for how, made, spans in parts if made is not None)
    yield from (("", None, None, region) for start, region in short.items() if start not in whole)


def scan(text: str) -> tuple[list[tuple[str, int, int, str]], int]:
    """((kind, start, end, layer) by start, then kind; regions not read to their end)."""
    found: dict[tuple[int, int, int], str] = {}
    work: deque[Layer] = deque([(text, None, "")])
    met: set[tuple[str, int, int]] = {(text, 0, len(text))}
    stopped: set[Span] = set()

    def place(spans: Spans | None, a: int, b: int) -> Span:
        return (a, b) if spans is None else (int(spans[0][a]), int(spans[1][b - 1]))

    while work:
        layer, own, path = work.popleft()
        for kind, a, b in find(layer):
            span = place(own, a, b)
            found.setdefault((span[0], kind, span[1]), path)
        for how, made, spans, (a, b) in _layers(layer):
            if made is None:
                stopped.add(place(own, a, b))
            if not made:
                continue
            if spans is None:  # all of it comes from the whole region
                x, y = place(own, a, b)
                spans = np.broadcast_to(np.int64(x), len(made)), np.broadcast_to(np.int64(y), len(made))
            elif own is not None:
                spans = own[0][spans[0]], own[1][spans[1] - 1]
            key = (made, int(spans[0][0]), int(spans[1][-1]))
            if key not in met:
                met.add(key)
                work.append((made, spans, f"{path}/{how}"))
    return [(KINDS[k], a, b, path) for (a, k, b), path in sorted(found.items())], len(stopped)


SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
            StructField("layer", StringType()),
        ]
    )
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("layer", pa.string())]))


def scan_texts(df: DataFrame, text: str = "text", spans: str = "spans", stopped: str = "stopped") -> DataFrame:
    """``df`` with ``spans`` (kind, start, end, layer; layer '' is the text itself) and ``stopped``."""

    def compute(column: pa.Array) -> list[pa.Array]:
        rows = [scan(t) if t else ([], 0) for t in column.to_pylist()]
        named = [[dict(zip(("kind", "start", "end", "layer"), s)) for s in r] for r, _ in rows]
        return [pa.array(named, _ARROW_SPANS), pa.array([n for _, n in rows], pa.int64())]

    return add_columns(df, [text], [(spans, SPANS), (stopped, LongType())], compute)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
