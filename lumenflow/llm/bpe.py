"""Byte-level BPE encoding by longest matches and backtracking, and decoding.

The merges of a rank file decide for any two adjacent tokens whether plain BPE
would leave them side by side: undo the merges of both, latest first, and see
whether an earlier merge would have joined bytes across the border. A sequence
of tokens of which all neighbours are compatible is the sequence that BPE makes,
and there is one such sequence for a text. So a piece is encoded by taking the
longest token at each place, falling back to the next shorter one, or to the
token before, when the pair isn't compatible. Places found impossible are
marked and never tried again, which keeps the work linear in the piece.

Longest tokens come from an Aho-Corasick automaton (pyahocorasick) that reads the
bytes written as Latin-1. Compatibility is memoised per token pair, and whole
pieces are memoised too; both memos have a fixed number of entries, so a task's
memory is bounded and no text is left out.

The pattern's classes are those of the Unicode version that the ``tiktoken``
library has. Characters that the ``regex`` module's later version calls letters or
numbers are written as a private-use character before the text is split; the
pieces are then cut from the text itself. Texts within Latin-1 are split by the
same pattern with the classes written out, for the standard library's faster
``re``.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded each; an empty table gives an empty table; other
columns pass through, those named like an output are replaced.
"""

from __future__ import annotations

import base64
import re
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType

from lumenflow.llm.textops import add_columns, slices

MEMO_PIECES = 120_000
MEMO_PAIRS = 250_000
#: Longer pieces are encoded without the memo.
MEMO_BYTES = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def derive_splits(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """For each token the two tokens that the merges join last to make it.

    A token of one byte is its own pair. The merges below the token's rank are
    applied to its bytes; they must leave two parts.
    """
    splits: dict[int, tuple[int, int]] = {}
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, where = rank, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, where = r, i
            if where < 0:
                raise ValueError(f"token {rank} can't be made by merges of lower rank")
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        splits[rank] = (rank, rank) if len(parts) == 1 else (ranks[parts[0]], ranks[parts[1]])
    return splits


def later_letters() -> str:
    """The characters that ``regex`` calls letters or numbers and tiktoken doesn't."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    bytes_only = {bytes([b]): b for b in range(256)}
    out = []
    for name in ("L", "N"):
        one = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}", mergeable_ranks=bytes_only, special_tokens={})
        known = one.decode(one.encode_ordinary(every))
        out += sorted(set(regex.findall(rf"\p{{{name}}}", every)) - set(known))
    return "".join(out)


def latin_pattern(pattern: str) -> str:
    """``pattern`` for texts within Latin-1, with its classes written out for ``re``."""
    latin = [chr(c) for c in range(256)]
    classes = {
        r"\p{L}": [c for c in latin if unicodedata.category(c)[0] == "L"],
        r"\p{N}": [c for c in latin if unicodedata.category(c)[0] == "N"],
        r"\s": [c for c in latin if c in "\t\n\v\f\r \x85\xa0"],
    }
    out, inside, at = [], False, 0
    while at < len(pattern):
        step = next((k for k in (*classes, r"\S") if pattern.startswith(k, at)), pattern[at : at + (2 if pattern[at] == "\\" else 1)])
        if step == r"\S" and not inside:
            out.append("[^" + "".join(map(re.escape, classes[r"\s"])) + "]")
        elif step in classes:
            body = "".join(map(re.escape, classes[step]))
            out.append(body if inside else f"[{body}]")
        else:
            inside = step == "[" or inside and step != "]"
            out.append(step)
        at += len(step)
    return "".join(out)


class Encoder:
    """One vocabulary: encodes texts to ids and ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], splits: dict[int, tuple[int, int]], pattern: str, later: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"{len(missing)} single bytes aren't in the vocabulary")
        self.ranks, self.splits = ranks, splits
        self.token = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        self.joined = {pair: r for r, pair in splits.items() if pair[0] != r}
        self.find = regex.compile(pattern).findall
        self.find_latin = re.compile(latin_pattern(pattern)).findall
        self.later = dict.fromkeys(map(ord, later), "\ue000")
        self.shorter: dict[int, int] = {}  # the longest token that a token begins with
        for token, rank in ranks.items():
            for n in range(len(token) - 1, 0, -1):
                if (r := ranks.get(token[:n])) is not None:
                    self.shorter[rank] = r
                    break
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        try:
            if text.isascii() or text.encode("latin-1"):
                return self.find_latin(text)
        except UnicodeEncodeError:
            pass
        shadow = text.translate(self.later)
        found = self.find(shadow)
        if shadow != text:
            at = 0
            for i, piece in enumerate(found):
                found[i] = text[at : at + len(piece)]
                at += len(piece)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether merges leave ``left`` and ``right`` as neighbours."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._undo(left, right)
        return known

    def _undo(self, a: int, b: int) -> bool:
        # ``allowed``: merges from this rank on happen after those already undone.
        # At equal ranks the left place is merged first.
        allowed = 1 << 62
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < allowed:
                return False
            inner_a, inner_b = self.splits[a][1], self.splits[b][0]
            can_a, can_b = inner_a != a, inner_b != b
            if not can_a and not can_b:
                return True
            if can_a and (not can_b or a > b):
                allowed, a = a, inner_a
            else:
                allowed, b = b + 1, inner_b

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n, length, text, longest = len(piece), self.length, piece.decode("latin-1"), self.automaton.iter_long
        out: list[int] = []
        open_at = bytearray(b"\x01") * (n + 1)
        at, rank = 0, next(longest(text))[1]
        while at < n:
            while True:
                end = at + length[rank]
                if open_at[end] and (not out or self.compatible(out[-1], rank)):
                    out.append(rank)
                    at = end
                    if at < n:
                        rank = next(longest(text, at))[1]
                    break
                if (next_one := self.shorter.get(rank)) is not None:
                    rank = next_one
                    continue
                open_at[at] = 0
                rank = out.pop()
                at -= length[rank]
                break
        return out

    def forget(self) -> None:
        """Empty the memos."""
        self.pieces, self.older, self.pairs = {}, {}, {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = self.split(text)
        try:
            return b"".join(map(self.pieces.__getitem__, found))
        except KeyError:
            return b"".join(map(self._ids, found))

    def _ids(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                made = self.encode_piece(piece.encode())
                ids = struct.pack(f"<{len(made)}I", *made)
                if len(piece) > MEMO_BYTES:
                    return ids
            if len(self.pieces) >= MEMO_PIECES:  # what isn't met again falls out with the older half
                self.older, self.pieces = self.pieces, {}
            self.pieces[piece] = ids
        return ids


def decode_ids(token: dict[int, bytes], ids: bytes) -> bytes:
    """The bytes of packed ``ids``, by the table of each id's bytes."""
    return b"".join(map(token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Vocabulary:
    """A vocabulary on its way to the tasks; each worker builds its encoder once.

    The broadcast holds the rank file and its merges, whose size the vocabulary
    bounds and the data don't.
    """

    _built: dict[tuple[int, str], Encoder | dict[int, bytes]] = {}

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self.sent = spark.sparkContext.broadcast((ranks, derive_splits(ranks), pattern, later_letters()))

    def _once(self, what: str, build):
        key = (id(self.sent.value), what)
        if key not in self._built:
            self._built.clear()
            self._built[key] = build(*self.sent.value)
        return self._built[key]

    def encoder(self) -> Encoder:
        return self._once("encoder", Encoder)

    def tokens(self) -> dict[int, bytes]:
        return self._once("tokens", lambda ranks, *_: {r: t for t, r in ranks.items()})


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids``: binary, the token ids as little-endian uint32.

    ``decoded`` names a column for the bytes that these ids decode to, made in the same task.
    """

    def compute(column: pa.Array) -> list[pa.Array]:
        encoder = vocabulary.encoder()
        made = [encoder.encode(t) if t else b"" for a, b in slices(column) for t in column.slice(a, b - a).to_pylist()]
        out = [pa.array(made, pa.binary())]
        if decoded:
            token = encoder.token
            out.append(pa.array([decode_ids(token, i) for i in made], pa.binary()))
        return out

    return add_columns(df, [text], [(name, BinaryType()) for name in (ids, decoded) if name], compute, finish=lambda: vocabulary.encoder().forget())


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded``: the bytes of the tokens in ``ids`` (null: none)."""

    def compute(column: pa.Array) -> list[pa.Array]:
        token = vocabulary.tokens()
        return [pa.array([decode_ids(token, i) if i else b"" for i in column.to_pylist()], pa.binary())]

    return add_columns(df, [ids], [(decoded, BinaryType())], compute)
