"""Repeated passages of words by compressed FM-indexes over shards of passages.

A window of ``WINDOW`` words that starts in several documents is found by search
in an index. To keep that linear in the corpus, equal windows are brought to the
same shard first. Each window is keyed by its minimizer, the smallest hash of its
runs of ``GRAM`` words; consecutive windows with one minimizer form a passage. A
passage whose minimizer occurs in one document only can't hold a repeated window
and is left out by a combining aggregate. Of equal passages, however many
documents hold them, one goes on, with the smallest document that has it.

A shard builds one FM-index over its passages' words: suffixes in the order of
their first 16 words (prefix doubling), the Burrows-Wheeler transform in a wavelet
matrix of packed bits with rank counts, and the common prefixes of neighbouring
suffixes. The passages then stream through it: backward search extends a match
by the word before, and shortens it from the right by the common prefixes when it has
reached the window's length or can't be extended. That yields the matching
statistics up to the window's length; where they reach it, the suffix interval
is the set of all places of the window, and its smallest document is the owner.
A minimizer with more than ``HOT`` different passages isn't indexed, as no shard could
hold it: each window of these passages gets its smallest document from a combining
aggregate over minimizer and window hash, however many passages have the window.

The owners go back to all places of the passages. A word is removed if a window that
covers it has an owner with a smaller id than the document at hand.

Defined results: a null or empty text has no words; a text shorter than a window
keeps all; rows that repeat an id are taken for the same document, and a document
never removes its own words; rows with a null id keep all words; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm import textops as t
from lumenflow.llm.minmax import staged

WINDOW = 13
GRAM = 4
DEPTH = 16
SHARD_PASSAGES = 30_000
HOT = 5_000
#: Longer passages are searched in parts that overlap by a window less a word.
QUERY_WORDS = 64


class WaveletMatrix:
    """Rank of any symbol in a sequence, as one packed bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            packed = np.zeros((len(bit) // 64 + 1) * 8, np.uint8)
            small = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[: len(small)] = small
            words = packed.view(np.uint64)
            counts = np.zeros(len(words), np.uint32)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:], dtype=np.uint32)
            self.bits.append(words)
            self.counts.append(counts)
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        self.starts = self._descend(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (words, counts, zeros) in enumerate(zip(self.bits, self.counts, self.zeros)):
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[block].astype(np.int64) + np.bitwise_count(words[block] & below)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before place ``at``."""
        return self._descend(symbol, at) - self.starts[symbol]


class FMIndex:
    """Search for runs of up to ``DEPTH`` words in passages (words[bounds[i]:bounds[i+1]])."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.known, ids = np.unique(words, return_inverse=True)
        passage = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.text = np.zeros(len(words) + len(bounds) - 1, np.int64)  # 0 ends a passage
        self.place = np.arange(len(words)) + passage
        self.text[self.place] = ids + 1
        n = self.size = len(self.text)
        rank = self.text
        step = 1
        while step < DEPTH:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            _, rank = np.unique(rank * (n + 2) + after, return_inverse=True)
            step *= 2
        self.order = np.argsort(rank, kind="stable")
        top = len(self.known)
        self.first = np.searchsorted(np.sort(self.text), np.arange(top + 1))
        self.matrix = WaveletMatrix(self.text[self.order - 1], top)
        shared = np.zeros(n, np.int8)  # words that a suffix has in common with the one before
        same = np.ones(n, bool)
        padded = np.concatenate([self.text, np.zeros(DEPTH, np.int64)])
        for k in range(DEPTH):
            here = padded[self.order + k]
            same[1:] &= (here[1:] == here[:-1]) & (here[1:] > 0)
            same[0] = False
            shared += same
        self.group_starts = [np.flatnonzero(shared < length) for length in range(DEPTH + 1)]
        self.group_starts[0] = np.zeros(1, np.int64)

    def shorten(self, low: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the first ``length`` words of the suffixes at ``low``."""
        new_low, new_high = np.empty_like(low), np.empty_like(low)
        for k in np.unique(length).tolist():
            at = length == k
            starts = self.group_starts[k]
            i = np.searchsorted(starts, low[at], side="right")
            new_low[at] = starts[i - 1]
            new_high[at] = np.append(starts, self.size)[i]
        return new_low, new_high

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the words in the index; 0 for a word that it doesn't have."""
        i = np.searchsorted(self.known, words)
        i[i == len(self.known)] = 0
        return np.where(self.known[i] == words, i + 1, 0) if len(self.known) else np.zeros(len(words), np.int64)

    def statistics(self, words: np.ndarray, bounds: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Steps of (place in words, matching statistic up to ``window``, low end of the suffix interval)."""
        symbol = self.symbols(words)
        ends = bounds[1:]
        order = np.argsort(-np.diff(bounds), kind="stable")
        sizes = np.diff(bounds)[order]
        ends = ends[order]
        low = np.zeros(len(order), np.int64)
        high = np.full(len(order), self.size, np.int64)
        length = np.zeros(len(order), np.int64)
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 1):
            live = int(np.searchsorted(-sizes, -back, side="right"))
            c = symbol[ends[:live] - back]
            full = np.flatnonzero(length[:live] == window)
            if len(full):
                length[full] -= 1
                low[full], high[full] = self.shorten(low[full], length[full])
            missing = c == 0
            length[:live][missing], low[:live][missing], high[:live][missing] = 0, 0, self.size
            todo = np.flatnonzero(~missing)
            while len(todo):
                sym = c[todo]
                new_low = self.first[sym] + self.matrix.rank(sym, low[todo])
                new_high = self.first[sym] + self.matrix.rank(sym, high[todo])
                found = new_low < new_high
                done = todo[found]
                low[done], high[done] = new_low[found], new_high[found]
                length[done] += 1
                todo = todo[~found]
                if len(todo):
                    length[todo] -= 1  # a known word alone is always found, so this stays at 0 or more
                    low[todo], high[todo] = self.shorten(low[todo], length[todo])
            yield ends[:live] - back, length[:live].copy(), low[:live].copy()


def window_owners(words: np.ndarray, bounds: np.ndarray, documents: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each place in ``words`` where a window starts, the smallest document of a passage that has the window.

    ``documents`` has one id per passage. Other places have the largest integer.
    """
    index = FMIndex(words, bounds)
    passage = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    by_text = np.full(index.size, np.iinfo(np.int64).max)
    by_text[index.place] = documents[passage]
    starts = index.group_starts[window]
    least = np.minimum.reduceat(by_text[index.order], starts)
    owners = np.full(len(words), np.iinfo(np.int64).max)
    parts = _parts(bounds, window)
    for place, length, low in index.statistics(words[parts[0]], parts[1], window):
        hit = length == window
        group = np.searchsorted(starts, low[hit], side="right") - 1
        owners[parts[0][place[hit]]] = least[group]
    return owners


def _parts(bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Long passages as parts: (index of each part's words, bounds of the parts)."""
    sizes = np.diff(bounds)
    step = QUERY_WORDS - window + 1
    many = np.maximum(1, -(-(sizes - window + 1) // step))
    of = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    begin = bounds[:-1][of] + number * step
    size = np.minimum(bounds[1:][of] - begin, QUERY_WORDS)
    new = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(begin - new[:-1], size) + np.arange(new[-1]), new


def _passages(hashes: np.ndarray, first: np.ndarray, window: int, gram: int):
    """(row, first word in the row, windows, minimizer, hash) of each passage of a slice."""
    grams, _, _ = t.windows(hashes, first, gram)
    gram_first = np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - (gram - 1), 0))])
    per_row = np.maximum(np.diff(first) - (window - 1), 0)
    total = int(per_row.sum())
    row = np.repeat(np.arange(len(per_row)), per_row)
    within = np.arange(total) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    width = window - gram + 1
    least = grams[: len(grams) - width + 1].copy()
    for k in range(1, width):
        np.minimum(least, grams[k : len(grams) - width + 1 + k], out=least)
    minimizer = least[gram_first[row] + within]
    fresh = np.ones(total, bool)
    fresh[1:] = (minimizer[1:] != minimizer[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(fresh)
    windows = np.diff(np.append(begin, total))
    row, within = row[begin], within[begin]
    start = first[row] + within
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * t._power("up", t._BASE, len(hashes))[: len(hashes)], out=sums[1:])
    size = windows + window - 1
    body = (sums[start + size] - sums[start]) * t._power("down", t._BASE_INVERSE, len(hashes) + 1)[start]
    return row, within, windows, minimizer[begin], t.mix(body + size.astype(np.uint64))


def passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, start, windows, minimizer, passage) of all passages of (id, text)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b in t.slices(batch.column(1)):
                ids = batch.column(0).slice(a, b - a)
                data, offsets = t.buffer(batch.column(1).slice(a, b - a))
                starts, ends, first = t.words(data, offsets)
                row, start, windows, minimizer, name = _passages(t.span_hashes(data, starts, ends), first, window, gram)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(t.signed(minimizer)), pa.array(t.signed(name))],
                    names=["id", "start", "windows", "minimizer", "passage"],
                )

    return docs.select("id", "text").mapInArrow(run, f"id {id_type}, start int, windows int, minimizer long, passage long")


def _with_words(located: DataFrame, window: int) -> DataFrame:
    """(minimizer, passage, windows, offset, owner, words, shard_key) of (id, text, wanted).

    A hot passage becomes one row per window, with the window's hash as shard key.
    """

    def run(batches):
        for batch in batches:
            wanted = batch.column(2)
            for a, b in t.slices(batch.column(1)):
                data, offsets = t.buffer(batch.column(1).slice(a, b - a))
                starts, ends, first = t.words(data, offsets)
                hashes = t.span_hashes(data, starts, ends)
                part = wanted.slice(a, b - a)
                counts = part.value_lengths().to_numpy(zero_copy_only=False)
                if not len(part) or not counts.sum():
                    continue
                row = np.repeat(np.arange(b - a), counts)
                flat = part.flatten()
                get = lambda k: flat.field(k).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                begin, windows, hot = first[row] + get("start"), get("windows").astype(np.int64), get("hot")
                pieces = np.where(hot, windows, 1)
                of = np.repeat(np.arange(len(row)), pieces)
                offset = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                size = np.where(hot[of], window, windows[of] + window - 1)
                at = begin[of] + offset
                bounds = np.concatenate([[0], np.cumsum(size)])
                words = hashes[np.repeat(at - bounds[:-1], size) + np.arange(bounds[-1])]
                key = get("minimizer")[of].copy()
                split = np.flatnonzero(hot[of])
                h = np.zeros(len(split), np.uint64)
                for k in range(window):
                    h = t.mix(h * np.uint64(3) + words[bounds[split] + k])
                key[split] = t.signed(h)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(get("minimizer")[of]),
                        pa.array(get("passage")[of]),
                        pa.array(windows[of].astype(np.int32)),
                        pa.array(offset.astype(np.int32)),
                        batch.column(0).slice(a, b - a).cast(pa.int64()).take(pa.array(row[of])),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(t.signed(words))),
                        pa.array(key),
                    ],
                    names=["minimizer", "passage", "windows", "offset", "owner", "words", "shard_key"],
                )

    schema = "minimizer long, passage long, windows int, offset int, owner long, words array<long>, shard_key long"
    return located.select("id", "text", "wanted").mapInArrow(run, schema)


def _search_shard(table: pa.Table) -> pa.Table:
    """Owners of the windows of a shard's passages."""
    lists = table.column("words").combine_chunks()
    words = lists.flatten().to_numpy().view(np.uint64)
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    owners = window_owners(words, bounds, table.column("owner").to_numpy(), WINDOW)
    count = sizes - WINDOW + 1
    new = np.concatenate([[0], np.cumsum(count)])
    own = owners[np.repeat(bounds[:-1] - new[:-1], count) + np.arange(new[-1])]
    return pa.table(
        {
            **{c: table.column(c) for c in ("minimizer", "passage", "windows", "offset")},
            "owners": pa.ListArray.from_arrays(pa.array(new.astype(np.int32)), pa.array(own)),
        }
    )


def _hot_owners(pieces: DataFrame) -> DataFrame:
    """Owners of the windows of hot passages, given a row per window of each."""
    key = ["minimizer", "window"]
    least = pieces.groupBy(key).agg(F.min("owner").alias("least"))
    return pieces.join(least.hint("merge"), key).select("minimizer", "passage", "windows", "offset", F.array("least").alias("owners"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(id, starts): for each document of (id, text) the places of windows that a smaller id has too."""
    docs = docs.where("id IS NOT NULL")
    found = passages(docs)
    shared = found.groupBy("minimizer").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("minimizer")
    places = staged(found.join(shared.hint("merge"), "minimizer", "left_semi"), "places")
    kinds = places.groupBy("minimizer", "passage", "windows").agg(F.min(F.struct("id", "start")).alias("at"))
    kinds = staged(kinds, "passages")
    hot = staged(kinds.groupBy("minimizer").agg(F.count(F.lit(1)).alias("n")).where(f"n > {HOT}").select("minimizer"), "hot")
    any_hot = not hot.isEmpty()

    def worded(kinds: DataFrame, is_hot: bool) -> DataFrame:
        place = F.struct(F.col("at.start").alias("start"), "windows", "minimizer", "passage", F.lit(is_hot).alias("hot"))
        wanted = kinds.select(F.col("at.id").alias("id"), place.alias("w")).groupBy("id").agg(F.collect_list("w").alias("wanted"))  # no more than the document's words
        return _with_words(docs.join(wanted.hint("merge"), "id"), WINDOW)

    shards = max(1, -(-kinds.count() // SHARD_PASSAGES))
    owners = (
        worded(kinds.join(hot, "minimizer", "left_anti") if any_hot else kinds, False)
        .withColumn("shard", F.pmod(F.xxhash64("shard_key"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_search_shard, "minimizer long, passage long, windows int, offset int, owners array<long>")
    )
    owners = staged(owners, "owners")
    if any_hot:
        pieces = worded(kinds.join(hot.hint("merge"), "minimizer", "left_semi"), True).drop("words").withColumnRenamed("shard_key", "window")
        owners = owners.unionByName(_hot_owners(staged(pieces, "hot-windows")))
    starts = F.filter(
        F.transform("owners", lambda o, i: F.when(o < F.col("id"), F.col("start") + F.col("offset") + i)), lambda x: x.isNotNull()
    )
    return (
        places.join(owners, ["minimizer", "passage", "windows"])
        .select("id", starts.alias("s"))
        .where(F.size("s") > 0)
        .groupBy("id")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("starts"))  # no more than the document's words
    )


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_removed, kept): the words left, joined by one space."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    located = docs.join(repeated_windows(docs).hint("merge"), "id", "left").select("id", "text", "starts")
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            total, removed, kept = [], [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                total.append(len(words))
                if starts.is_valid:
                    at = starts.values.to_numpy()
                    edge = np.zeros(len(words) + WINDOW + 1, np.int64)
                    edge[at] += 1
                    edge[at + WINDOW] -= 1
                    left = np.cumsum(edge)[: len(words)] == 0
                    words = [w for w, keep in zip(words, left.tolist()) if keep]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array([k.decode() for k in kept], pa.string())],
                names=["id", "n_words", "n_removed", "kept"],
            )

    done = located.mapInArrow(run, f"id {id_type}, n_words long, n_removed long, kept string")
    return done.withColumnRenamed("id", id_col)
