"""Benchmark passages in texts, by the q-gram lemma and banded alignment.

Texts and benchmark items are normalised: lower-cased, ASCII punctuation
dropped, white space runs as one space. An item longer than ``SEGMENT`` bytes counts
as found when one of its stretches of that length is, beginning at any multiple of ``STRIDE``; so a
part of ``SEGMENT + STRIDE - 1`` bytes (79, about 13 words) is enough wherever it lies in the item. A stretch of m bytes is found in a text where
some part of the text is within k = ``EDITS`` * m edits of it.

By the q-gram lemma at least m + 1 - q - k * q of a stretch's q-grams occur there, and
their diagonals (place in the text less place in the item) lie within
k of each other. So per text, item and diagonal band the places of the item whose q-gram occurs in the band are
gathered; bands are twice as wide as their distance, which puts any k + 1 neighbouring diagonals
into one. The stretches of a band that have enough such places are the regions that are retained, and they are verified by
an alignment confined to the band, row by row for all candidates at once: first the stretch with most places, the others only if that fails.

The q-grams of the benchmark are looked up in the tasks: a table of a block of items,
``BLOCK_BYTES`` at most, is broadcast, built once per worker, and a larger benchmark is searched block
after block over the same rows, one block's table in memory at a time. The texts aren't shuffled.

Defined results: a null or empty text holds nothing; an item that is null or, once
normalised, shorter than a q-gram is never found; of very short items fewer edits
are allowed, so that the bound stays at one q-gram or more; equal items are each
reported; the match given of an item is one within the budget, not always the one with fewest edits; very long texts are read whole, in
parts of their q-grams, so that equal q-grams without end (a text and an item of one repeated word) stay within memory; repeated rows are searched each; an empty benchmark finds nothing and an
empty table gives an empty table; other columns pass through, those named like the
output are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lumenflow.llm import textops as t

Q = 8
SEGMENT, STRIDE = 72, 8
EDITS = 0.1
BAND = 16
#: Equal q-grams that are looked at in one go.
HITS = 1 << 20
BLOCK_BYTES = 4 << 20
#: Candidate bands that are aligned at once.
ALIGN = 2_000

_KEEP = np.zeros(256, bool)
_KEEP[128:] = True
for _from, _to in ((48, 58), (65, 91), (97, 123), (9, 14), (32, 33)):
    _KEEP[_from:_to] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[9:14] = 32


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(normalised bytes, offsets, place of each byte in ``data``)."""
    at = np.flatnonzero(_KEEP[data])
    folded = _FOLD[data[at]]
    first = np.searchsorted(at, offsets)
    space = folded == 32
    double = np.zeros(len(at), bool)
    double[1:] = space[1:] & space[:-1]
    starts = first[:-1][first[:-1] < len(at)]
    double[starts] = space[starts]
    keep = ~double
    return folded[keep], np.concatenate([[0], np.cumsum(keep)])[first], at[keep]


def grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    h = data.astype(np.uint64)
    for step in (1, 2, 4):
        if len(h) <= step:
            return np.zeros(0, np.uint64)
        h = (h[:-step] << np.uint64(8 * step)) | h[step:]
    return h


def edit_budget(m: int) -> int:
    return max(0, min(int(EDITS * m), (m - Q) // Q))


class Items:
    """A block of benchmark items, and where each of its q-grams occurs."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, offsets = t.buffer(pc.utf8_lower(pa.array(texts, pa.string())))
        data, offsets, _ = normalise(data, offsets)
        self.ids = np.array(ids, np.int64)
        self.texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        every = [grams(x) for x in self.texts]
        item = np.repeat(np.arange(len(every)), [len(g) for g in every])
        place = np.concatenate([np.arange(len(g)) for g in every]) if every else np.zeros(0, np.int64)
        gram = np.concatenate(every) if every else np.zeros(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order], place[order]
        self.known, begin = np.unique(gram[order], return_index=True)
        self.begin = np.append(begin, len(gram))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.known)] = True
        self.segments: list[list[tuple[int, int]]] = []
        self.least = np.zeros(len(self.texts), np.int64)  # shared q-grams that any segment needs
        for i, text in enumerate(self.texts):
            m = len(text)
            starts = [0] if m <= SEGMENT else [*range(0, m - SEGMENT + 1, STRIDE)]
            if m > SEGMENT and starts[-1] != m - SEGMENT:
                starts.append(m - SEGMENT)
            size = min(m, SEGMENT)
            self.segments.append([(s, size) for s in starts] if m >= Q else [])
            self.least[i] = max(1, size + 1 - Q - edit_budget(size) * Q)

    @staticmethod
    def _slot(gram: np.ndarray) -> np.ndarray:
        return ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def hits(self, gram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Parts of (place in the grams, item, place in the item) of all equal q-grams."""
        at = np.flatnonzero(self.maybe[self._slot(gram)])
        i = np.searchsorted(self.known, gram[at])
        i[i == len(self.known)] = 0
        equal = self.known[i] == gram[at] if len(self.known) else np.zeros(len(at), bool)
        at, i = at[equal], i[equal]
        count = self.begin[i + 1] - self.begin[i]
        part = np.cumsum(count) // HITS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(at)]
        for a, b in zip(cuts, cuts[1:]):
            n = count[a:b]
            which = np.repeat(self.begin[i[a:b]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            yield np.repeat(at[a:b], n), self.item[which], self.place[which]


def candidate_bands(items: Items, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, band) of the bands in which enough places of the item occur, and those places: (band's number, place), sorted."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    wide = int(items.place.max(initial=0)) + 1
    found, held = [], 0
    for at, item, place in items.hits(grams(data)):
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + Q <= offsets[row + 1]
        at, item, place, row = at[inside], item[inside], place[inside], row[inside]
        part = np.stack([row * len(items.ids) + item, (at - offsets[row] - place) // BAND, place])
        if held + len(at) > HITS:  # so many equal q-grams that a band has most places many times
            order = np.lexsort(part)
            part = part[:, order]
            part = part[:, np.append(True, np.any(np.diff(part, axis=1) != 0, axis=0))]
        held += part.shape[1]
        found.append(part)
    if not held:
        return none
    pair, band, place = np.concatenate(found, axis=1)
    pairs, which, count = np.unique(pair, return_inverse=True, return_counts=True)
    enough = (count >= items.least[pairs % len(items.ids)])[which]
    which, band, place = which[enough], band[enough], place[enough]
    if not len(which):
        return none
    shift = int(-band.min()) + 1
    width = int(band.max()) + shift + 2
    own = which * width + band + shift  # a hit counts in its band and in the one that overlaps it
    keys, count = np.unique(np.concatenate([own, own - 1]), return_counts=True)
    keys = keys[count >= items.least[pairs[keys // width] % len(items.ids)]]
    if not len(keys):
        return none
    places = []
    for key in (own, own - 1):
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        met = keys[at] == key
        places.append(at[met] * wide + place[met])
    places = np.unique(np.concatenate(places))  # a place counts once per band
    number, place = places // wide, places % wide
    pair = pairs[keys // width]
    return pair // len(items.ids), pair % len(items.ids), keys % width - shift, number, place


def align(patterns: list[np.ndarray], regions: list[np.ndarray]) -> np.ndarray:
    """Least edits between each pattern and a stretch of its region, within the band.

    ``regions[c][i + j]`` meets ``patterns[c][i]`` on diagonal j; 0 pads both ends.
    """
    size = max(map(len, patterns))
    lengths = np.array([len(p) for p in patterns])
    width = len(regions[0]) - size
    pattern = np.zeros((len(patterns), size), np.uint8)
    for c, p in enumerate(patterns):
        pattern[c, : len(p)] = p
    region = np.stack(regions)
    slope = np.arange(width, dtype=np.int16)
    cost = np.zeros((len(patterns), width), np.int16)
    best = np.zeros(len(patterns), np.int64)
    for i in range(size):
        step = cost + (region[:, i : i + width] != pattern[:, i : i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = (np.minimum.accumulate(step - slope, axis=1) + slope).astype(np.int16)
        done = lengths == i + 1
        if done.any():
            best[done] = cost[done].min(axis=1)
    return best


def regions(items: Items, bands: tuple[np.ndarray, ...]) -> list[tuple[int, int, int, int, int, int]]:
    """(row, item, band, begin, size, places) of the stretches that have enough places in a band."""
    row, item, band, number, place = bands
    out: list[tuple[int, int, int, int, int, int]] = []
    if not len(row):
        return out
    wide = int(place.max()) + SEGMENT + 2
    sorted_places = number * wide + place
    sizes = [items.segments[i] for i in item.tolist()]
    which = np.repeat(np.arange(len(row)), [len(x) for x in sizes])
    begin, size = (np.array([x[k] for group in sizes for x in group], np.int64) for k in (0, 1))
    last = np.minimum(begin + size - Q, wide - 1)
    inside = np.searchsorted(sorted_places, which * wide + last, side="right") - np.searchsorted(sorted_places, which * wide + begin)
    need = np.maximum(1, size + 1 - Q - (np.array([edit_budget(m) for m in size.tolist()], np.int64) * Q))
    good = np.flatnonzero((inside >= need) & (begin < wide))
    for w, b, m, n in zip(which[good].tolist(), begin[good].tolist(), size[good].tolist(), inside[good].tolist()):
        out.append((int(row[w]), int(item[w]), int(band[w]), b, m, n))
    return out


def verify(items: Items, data: np.ndarray, offsets: np.ndarray, work: list[tuple[int, int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, begin, end) of the regions within the budget; begin and end are places in ``data``."""
    out: list[tuple[int, int, int, int, int]] = []
    work = sorted(work, key=lambda w: w[4])
    for begin in range(0, len(work), ALIGN):
        part = work[begin : begin + ALIGN]
        size = max(w[4] for w in part)
        slack = edit_budget(size)
        width = 2 * BAND + 2 * slack
        stretches, patterns, spans = [], [], []
        for row, item, band, s, m, _ in part:
            low = band * BAND - slack + s  # in the row
            a, b = offsets[row], offsets[row + 1]
            region = np.zeros(width + size, np.uint8)
            x, y = max(a, a + low), min(b, a + low + width + m)
            if x < y:
                region[x - a - low : y - a - low] = data[x:y]
            stretches.append(region)
            patterns.append(items.texts[item][s : s + m])
            spans.append((int(x), int(max(x, y))))
        for w, edits, (x, y) in zip(part, align(patterns, stretches).tolist(), spans):
            if edits <= edit_budget(w[4]):
                out.append((w[0], w[1], edits, x, y))
    return out


def find(items: Items, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, begin, end) of found items, one or more of each."""
    work = regions(items, candidate_bands(items, data, offsets))
    best: dict[tuple[int, int], tuple] = {}
    for w in work:
        if w[:2] not in best or w[5] > best[w[:2]][5]:
            best[w[:2]] = w
    out = verify(items, data, offsets, list(best.values()))
    done = {(row, item) for row, item, *_ in out}
    return out + verify(items, data, offsets, [w for w in work if w[:2] not in done and w is not best[w[:2]]])


MATCHES = ArrayType(
    StructType([StructField("item_id", LongType()), StructField("edits", IntegerType()), StructField("begin", LongType()), StructField("end", LongType())])
)
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())]))


def search_block(items: Items, column: pa.Array) -> pa.Array:
    """For each text one match per item found: the one with fewest edits, and the code points it lies within."""
    out: list[list[dict]] = []
    for a, b in t.slices(column):
        raw, raw_offsets = t.buffer(pc.utf8_lower(column.slice(a, b - a)))  # as many code points
        data, offsets, place = normalise(raw, raw_offsets)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, item, edits, x, y in find(items, data, offsets):
            if (row, item) not in best or (edits, x) < best[row, item][:2]:
                best[row, item] = (edits, x, y)
        rows: list[list[dict]] = [[] for _ in range(b - a)]
        for (row, item), (edits, x, y) in sorted(best.items()):
            text = raw[raw_offsets[row] : raw_offsets[row + 1]]
            point = lambda p: int(((text[: max(0, p - raw_offsets[row])] & 0xC0) != 0x80).sum())  # noqa: E731, B023
            end = place[y - 1] + 1 if y > x else place[x] if x < len(place) else len(raw)
            rows[row].append({"item_id": int(items.ids[item]), "edits": edits, "begin": point(place[x]) if x < len(place) else point(end), "end": point(end)})
        out += rows
    return pa.array(out, _ARROW)


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items in blocks of about ``most`` bytes."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL AND id IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0
    n = -(-total // most)
    return [items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


_built: dict[str, Items] = {}  # of this worker, the last block only


def _items(name: str, sent) -> Items:
    if name not in _built:
        _built.clear()
        _built[name] = Items(*sent.value)
    return _built[name]


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", output: str = "leaks") -> DataFrame:
    """``docs`` with ``output``: item_id, edits, begin and end (code points that hold the match) per item found."""
    blocks = []
    for block in benchmark_blocks(benchmark):
        rows = sorted((r["id"], r["text"]) for r in block.collect())  # a block, whose size is bounded
        blocks.append((uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))))

    def compute(column: pa.Array) -> list[pa.Array]:
        found: list[list[dict]] = [[] for _ in range(len(column))]
        for name, sent in blocks:
            for row, more in zip(found, search_block(_items(name, sent), column).to_pylist()):
                row += more
        return [pa.array(found, _ARROW)]

    if not blocks:
        kept = docs.drop(output) if output != text else docs
        return kept.withColumn(output, F.array().cast(MATCHES))
    return t.add_columns(docs, [text], [(output, MATCHES)], compute)
