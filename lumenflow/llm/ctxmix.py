"""Texts scored by online logistic mixing of hashed-context bit predictors.

Bytes are predicted bit by bit. Each of the orders 0 to 5 has a predictor: a
table of 2 ** ``TABLE_BITS`` slots, addressed by a hash of the last bytes and the
bits of the byte known so far, with counts of zeros and ones. The predictions
are stretched (logit), weighted and added; the weights are those of a gate, chosen
by the bit's place and by how much the two highest orders have seen. A last stage refines
the mix by what happened before at that node and confidence.

Training sees every training text: their windows of six bytes (a byte and the five
before it, zeros before the text) are counted in a combining aggregate, and the
tables are filled from the counts. The weights are learnt online: each task runs
through its windows in small batches, first predicting, with the window's own
contribution taken out of the counts, then moving the weights against the error; the
tasks' weights, a few thousand numbers, are averaged by how much each gate has seen.
Counts, weights and the refining stage cover every window of every training text.
Scoring is static: no weight or count changes while texts are scored.
The tables have a fixed size, which bounds what the driver collects and broadcasts;
the counts behind them grow with the corpus.

A text's score depends on its windows only, so a task predicts each different
window once and adds up. Besides the score a text gets its unigram base. Token
counts are exact, of any number of different words: a task's distinct words go to
their totals and back by shuffles, in blocks of about ``BLOCK_BYTES`` of text, where they
meet the block's texts again. A block is a part of a file split, however much text that has; the driver
sends out how many parts each split has, a number per split. Nothing of the vocabulary passes through it.

Defined results: a null or empty text is its end alone; a NUL byte counts as byte 1; rows
that repeat an id are scored each; without training texts all counts are 0 and
the tables predict evenly; an empty table gives an empty table; other columns are not
looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.llm import textops as t
from lumenflow.llm.minmax import staged

ORDERS = 6
TABLE_BITS = 20
#: Bytes of texts that are taken apart at once.
SLICE, SCORE_SLICE = 2 << 20, 1 << 20
#: Windows or words of slices that a counting task holds before it adds them up; half as many different ones are passed on.
HELD, HELD_WORDS = 1 << 20, 2 << 20
#: Bytes of an Arrow batch: executors hold one several times outside their heap while they send it.
BATCH_BYTES = 4 << 20
#: Slices whose different windows are predicted together.
SCORED_TOGETHER = 4
#: Different windows that a training task holds at once, or one Arrow batch more.
PART = 1 << 18
#: Windows in a batch of training, rounds over a part of a task's windows, and the learning rate.
BATCH, ROUNDS, RATE = 1024, 2, 0.05
LEVELS = 6
REFINE_BUCKETS = 24
#: Bytes of text in a block, bytes that a row counts besides, and rows of a split that are dealt to blocks together.
BLOCK_BYTES, ROW_BYTES, BLOCK_ROWS = 16 << 20, 32, 10_000
#: Slots that a filling task passes on at once.
SLOTS_OUT = 1 << 18
_END = np.uint64(0x6C8E9CF570932BD5)  # the token at the end of a text


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(six bytes up to each byte of each text and its end as one number, bounds of the texts)."""
    n = len(offsets) - 1
    bounds = offsets + np.arange(n + 1)
    stream = np.insert(np.maximum(data, 1), offsets[1:], 0).astype(np.uint64)
    out, shifted = stream.copy(), np.empty_like(stream)
    for k in range(1, ORDERS):
        np.left_shift(stream[:-k], np.uint64(8 * k), out=shifted[k:])
        out[k:] |= shifted[k:]
    for k in range(ORDERS - 1):  # what comes before a text isn't its context
        at = bounds[:-1][np.diff(bounds) > k] + k
        out[at] &= np.uint64((1 << 8 * (k + 1)) - 1)
    return out, bounds


def _distinct(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different values and the sums of their counts."""
    codes, kinds = pd.factorize(np.concatenate(found))
    return kinds, np.bincount(codes, np.concatenate(counts), len(kinds)).astype(np.int64)


def _contexts(window: np.ndarray, first: int = 0) -> list[np.ndarray]:
    """A hash of the last bytes before the window's byte, for each order from ``first`` on."""
    before = window >> np.uint64(8)
    return [t.mix((before & np.uint64((1 << 8 * order) - 1)) + np.uint64((order + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) for order in range(first, ORDERS)]


def _node(window: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(node of the byte's tree before the bit, whether the bit is set)."""
    byte = window & np.uint64(255)
    node = np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))
    return node, ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)


def _slot(context: np.ndarray, node: np.ndarray, order: int) -> np.ndarray:
    h = (context + node * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64) + (order << TABLE_BITS)


def _packed(array: np.ndarray) -> tuple[bytes, str]:
    return zlib.compress(array.tobytes(), 1), array.dtype.str


def _unpacked(kind: type, *parts: tuple[bytes, str]):
    return kind(*(np.frombuffer(zlib.decompress(data), dtype) for data, dtype in parts))


class Packed:
    """Arrays that are compressed when they are sent to the executors."""

    def __reduce__(self):
        return _unpacked, (type(self), *map(_packed, vars(self).values()))


@dataclass
class Tables(Packed):
    """Counts of zeros and ones per slot."""

    zeros: np.ndarray
    ones: np.ndarray


@dataclass
class Mixer:
    """Weights by gate and order, and the refining stage's counts by node and bucket."""

    weights: np.ndarray
    seen: np.ndarray
    refine: np.ndarray | None = None


GATES = 8 * LEVELS * LEVELS


def new_mixer() -> Mixer:
    return Mixer(np.full((GATES, ORDERS), 1.5 / ORDERS), np.zeros(GATES))


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.05)) / (zeros + np.float32(0.05)))


def _level(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(zeros + ones + 1), LEVELS - 1).astype(np.uint8)


def _gate(bit: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Weight set: the bit's place and how much the two highest orders have seen."""
    return (bit * LEVELS + high.astype(np.int64)) * LEVELS + low


def _inputs(tables: Tables, contexts: list[np.ndarray], window: np.ndarray, bit: int):
    """(stretched predictions, gate, node, bit) as they were before each window was seen once more."""
    node, value = _node(window, bit)
    stretched, levels = [], []
    for order in range(ORDERS):
        slot = _slot(contexts[order], node, order)
        zeros = np.maximum(tables.zeros[slot] - (1 - value), 0)
        ones = np.maximum(tables.ones[slot] - value, 0)
        stretched.append(_stretch(zeros, ones))
        if order >= ORDERS - 2:
            levels.append(_level(zeros, ones))
    return np.stack(stretched), _gate(bit, levels[1], levels[0]), node.astype(np.int64), value


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def _bucket(mixed: np.ndarray) -> np.ndarray:
    return np.clip(((mixed + 12) * (REFINE_BUCKETS / 24)).astype(np.int64), 0, REFINE_BUCKETS - 1)


def learn(mixer: Mixer, tables: Tables, parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Mixer:
    """Online: for each batch of the parts' (windows, counts) predict, then move the gates' weights."""
    squares = np.full(mixer.weights.shape, 1e-6)
    for window, count in (part for part in parts for _ in range(ROUNDS)):
        for begin in range(0, len(window), BATCH):
            w, c = window[begin : begin + BATCH], count[begin : begin + BATCH].astype(float)
            contexts = _contexts(w)
            for bit in range(8):
                x, gate, _, value = _inputs(tables, contexts, w, bit)
                error = value - _squash((mixer.weights[gate].T * x).sum(axis=0))
                step = np.zeros_like(mixer.weights)
                for order in range(ORDERS):
                    step[:, order] = np.bincount(gate, c * error * x[order], GATES)
                total = np.bincount(gate, c, GATES)
                mixer.seen += total
                step /= np.maximum(total, 1)[:, None]
                squares += step**2
                mixer.weights += RATE * step / np.sqrt(squares)
    return mixer


def refine_counts(mixer: Mixer, tables: Tables, parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Counts of zeros and ones by node and bucket of the mix."""
    out = np.zeros((2, 256 * REFINE_BUCKETS))
    for window, count in parts:
        for begin in range(0, len(window), 64 * BATCH):
            w, n = window[begin : begin + 64 * BATCH], count[begin : begin + 64 * BATCH]
            contexts = _contexts(w)
            for bit in range(8):
                x, gate, node, value = _inputs(tables, contexts, w, bit)
                at = node * REFINE_BUCKETS + _bucket((mixer.weights[gate].T * x).sum(axis=0))
                for v in (0, 1):
                    out[v] += np.bincount(at[value == v], n[value == v], out.shape[1])
    return out


@dataclass
class Predictors(Packed):
    """The tables as scoring reads them: the stretched prediction and the level of each slot."""

    stretched: np.ndarray
    level: np.ndarray


def predictors(tables: Tables) -> Predictors:
    return Predictors(_stretch(tables.zeros, tables.ones).astype(np.float32), _level(tables.zeros, tables.ones))


def _near(tables: Predictors) -> list[np.ndarray]:
    """The stretched predictions of orders 0 and 1 by node, and by byte before and node: small enough to need no hashing."""
    contexts, nodes = _contexts(np.arange(256, dtype=np.uint64) << np.uint64(8)), np.arange(256, dtype=np.uint64)
    return [tables.stretched[_slot(contexts[0][0], nodes, 0)], tables.stretched[_slot(contexts[1][:, None], nodes, 1)].ravel()]


def bits_of(mixer: Mixer, tables: Predictors, window: np.ndarray) -> np.ndarray:
    """Bits that the model needs for the last byte of each window."""
    total = np.zeros(len(window))
    weights = np.ascontiguousarray(mixer.weights.T.astype(np.float32))
    near = _near(tables)
    for begin in range(0, len(window), 64 * BATCH):  # in parts that stay in the cache
        part = window[begin : begin + 64 * BATCH]
        contexts = _contexts(part, 2)
        before = (part & np.uint64(0xFF00)).astype(np.int64)
        for bit in range(8):
            node, value = _node(part, bit)
            slots = [_slot(context, node, order) for order, context in enumerate(contexts, 2)]
            gate = _gate(bit, tables.level.take(slots[-1]), tables.level.take(slots[-2]))
            at = node.astype(np.int64)
            mixed = weights[0].take(gate) * near[0].take(at)
            mixed += weights[1].take(gate) * near[1].take(before | at)
            for order, slot in enumerate(slots, 2):
                mixed += weights[order].take(gate) * tables.stretched.take(slot)
            p = _squash(mixed)
            if mixer.refine is not None:
                at = at * REFINE_BUCKETS + _bucket(mixed)
                zeros, ones = mixer.refine[0].take(at), mixer.refine[1].take(at)
                p = (p + (ones + 20 * p) / (zeros + ones + 20)) / 2
            p = np.clip(p, 1e-6, 1 - 1e-6)
            total[begin : begin + 64 * BATCH] -= np.log2(np.where(value == 1, p, 1 - p))
    return total


def window_counts(training: DataFrame) -> DataFrame:
    """(window, n) over the training texts."""

    def run(batches):
        found, counts = [], []
        for batch in batches:
            for a, b in t.slices(batch.column(0), SLICE):
                codes, kinds = pd.factorize(windows(*t.buffer(batch.column(0).slice(a, b - a), lower=True))[0])
                found.append(kinds)
                counts.append(np.bincount(codes, minlength=len(kinds)))
                del codes, kinds
                if sum(map(len, found)) > HELD:
                    found, counts = ([x] for x in _distinct(found, counts))
                    if len(found[0]) > HELD // 2:
                        yield made(found, counts)
                        found, counts = [], []
        if found:
            yield made(found, counts)
        t.settle()

    def made(found, counts):
        kinds, n = _distinct(found, counts)
        return pa.RecordBatch.from_arrays([pa.array(t.signed(kinds)), pa.array(n)], names=["window", "n"])

    return training.select("text").mapInArrow(run, "window long, n long").groupBy("window").agg(F.sum("n").alias("n"))


def fill_tables(counted: DataFrame) -> Tables:
    """The predictors' tables; at most ORDERS * 2 ** TABLE_BITS slots reach the driver."""

    def run(batches):
        sums = np.zeros((2, ORDERS << TABLE_BITS))  # of fixed size in each task; counts stay exact to 2 ** 53
        for batch in batches:
            window, n = (batch.column(i).to_numpy() for i in range(2))
            contexts = _contexts(window.view(np.uint64))
            for bit in range(8):
                node, value = _node(window.view(np.uint64), bit)
                for order in range(ORDERS):
                    at = _slot(contexts[order], node, order)
                    for v in (0, 1):
                        np.add.at(sums[v], at[value == v], n[value == v].astype(float))
        for begin in range(0, sums.shape[1], SLOTS_OUT):
            slot = np.flatnonzero(sums[:, begin : begin + SLOTS_OUT].any(axis=0)) + begin
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot.astype(np.int32)), *(pa.array(s[slot].astype(np.int64)) for s in sums)], names=["slot", "zeros", "ones"]
            )
        del sums
        t.settle()

    summed = counted.mapInArrow(run, "slot int, zeros long, ones long").groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    rows = summed.select("slot", F.col("zeros").cast("float"), F.col("ones").cast("float")).toArrow()
    tables = Tables(*(np.zeros(ORDERS << TABLE_BITS, np.float32) for _ in range(2)))
    slot = rows.column("slot").to_numpy()
    tables.zeros[slot], tables.ones[slot] = rows.column("zeros").to_numpy(), rows.column("ones").to_numpy()
    return tables


def _summed(df: DataFrame, compute) -> list[np.ndarray]:
    """Sums over tasks of the arrays that ``compute`` makes of a task's (window, n), given in parts."""

    def parts(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PART:
                yield joined(held)
                held, size = [], 0
        if size:
            yield joined(held)

    def joined(held):
        window, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(2))
        return window.view(np.uint64), n

    def run(batches):
        found = parts(batches)
        if (first := next(found, None)) is not None:
            made = compute(chain([first], found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(made)), pa.int32()), pa.array([m.astype("<f8").tobytes() for m in made], pa.binary())], names=["k", "data"]
            )

    sums: dict[int, np.ndarray] = {}
    for row in df.mapInArrow(run, "k int, data binary").toLocalIterator():  # a few KB per task
        part = np.frombuffer(row["data"], "<f8")
        sums[row["k"]] = sums.get(row["k"], 0) + part
    return [sums[k] for k in sorted(sums)]


def train(training: DataFrame) -> tuple[Tables, Mixer]:
    """Tables and mixer from the (text) rows of ``training``."""
    counted = staged(window_counts(training), "windows")
    tables = fill_tables(counted)
    mixer = new_mixer()
    sent = training.sparkSession.sparkContext.broadcast(tables)  # of fixed size

    def weights(parts):
        made = learn(new_mixer(), sent.value, parts)
        return [(made.weights * made.seen[:, None]).ravel(), made.seen]

    if sums := _summed(counted, weights):
        seen = sums[1][:, None]
        mixer.weights = np.where(seen > 0, sums[0].reshape(GATES, ORDERS) / np.maximum(seen, 1), mixer.weights)
        mixer.seen = sums[1]
        gates = mixer.weights
        (refine,) = _summed(counted, lambda parts: [refine_counts(Mixer(gates, gates[:, 0]), sent.value, parts).ravel()])
        mixer.refine = refine.reshape(2, -1)
    sent.destroy()
    return tables, mixer


def blocked(rows: DataFrame) -> DataFrame:
    """``rows`` (split, chunk, id, text, ...) with their ``block`` in place of split and chunk.

    A split's rows are dealt by a hash of id and text to as many parts as its largest chunk of ``BLOCK_ROWS`` rows
    needs. A block lies in one chunk, so that a task has its words together.
    """
    size = F.sum(F.octet_length("text").cast("long") + ROW_BYTES)
    parts = F.ceil(F.max("bytes") / BLOCK_BYTES).cast("long")
    sizes = rows.groupBy("split", "chunk").agg(size.alias("bytes")).groupBy("split").agg(parts.alias("parts")).where("parts > 1")
    dealt = rows.join(F.broadcast(staged(sizes, "split-parts")), "split", "left")  # a number per split, as the driver's list of splits has
    part = F.pmod(F.xxhash64("id", "text"), F.coalesce("parts", F.lit(1)))
    return dealt.withColumn("block", F.xxhash64("split", "chunk", part)).drop("split", "chunk", "parts")


def _token_rows(docs: DataFrame) -> DataFrame:
    """(block, word, n): the words of each block, and how often its training texts have them; ends are words too."""

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        size = 0
        for batch in batches:
            block, train_row = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(block, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                column, weight = batch.column(2).take(pa.array(at)), train_row[at]
                for a, b in t.slices(column, SCORE_SLICE):
                    data, offsets = t.buffer(column.slice(a, b - a), lower=True)
                    starts, ends, first = t.words(data, offsets)
                    codes, kinds = pd.factorize(np.concatenate([t.span_hashes(data, starts, ends), np.full(b - a, _END)]))
                    found, counts = held.setdefault(int(block[at[0]]), ([], []))
                    found.append(kinds)
                    counts.append(np.bincount(codes, np.concatenate([np.repeat(weight[a:b], np.diff(first)), weight[a:b]]), len(kinds)))
                    size += len(kinds)
                    if size > HELD_WORDS:
                        for one, (found, counts) in held.items():
                            kinds, n = _distinct(found, counts)
                            held[one] = [kinds], [n]
                        size = sum(len(found[0]) for found, _ in held.values())
                        if size > HELD_WORDS // 2:
                            yield from made(held)
                            size = 0
        yield from made(held)
        t.settle()

    def made(held):
        while held:
            one, (found, counts) = held.popitem()
            kinds, n = _distinct(found, counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), one)), pa.array(t.signed(kinds)), pa.array(n)], names=["block", "word", "n"])

    return docs.select("block", "training", "text").mapInArrow(run, "block long, word long, n long")


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of ``BATCH_BYTES`` in the jobs that run inside, unless the session has a limit of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key, None)
    if own is None:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)


def score(docs: DataFrame, training: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row.

    ``training``: SQL condition on ``id_col`` that tells the training rows.
    """
    with small_batches(docs.sparkSession):
        return staged(_scored(docs, training, id_col, text_col), "scores").withColumnRenamed("id", id_col)


def _scored(docs: DataFrame, training: str, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    chunk = F.floor(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK_ROWS)  # by the row's number in its task
    rows = docs.select(
        F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"),
        F.when(F.input_file_name() == "", F.lit(0)).otherwise(chunk).alias("chunk"),  # rows of no file may come in another order
        F.coalesce(F.expr(training), F.lit(False)).alias("training"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    tables, mixer = train(rows.where("training").select("text"))
    rows = blocked(rows)

    totals = staged(_token_rows(rows).groupBy("word").agg(F.sum("n").alias("total")), "token-totals")
    all_tokens, distinct = totals.where("total > 0").agg(F.coalesce(F.sum("total"), F.lit(0)), F.count(F.lit(1))).first()
    known = _token_rows(rows).select("block", "word").join(totals.hint("merge"), "word")
    sent = docs.sparkSession.sparkContext.broadcast((predictors(tables), mixer))  # of fixed size
    log_all = float(np.log10(all_tokens + distinct + 1))

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        texts = texts.combine_chunks()
        order = np.argsort(words.column("word").to_numpy())
        word = words.column("word").to_numpy()[order]
        total = words.column("total").to_numpy()[order]
        slots, mixer = sent.value
        column = texts.column("text").chunk(0) if texts.num_rows else pa.array([], pa.string())
        out: dict[str, list[np.ndarray]] = {c: [] for c in ("n_tokens", "n_known", "base_score", "score", "bytes")}
        parts = iter(t.slices(column, SCORE_SLICE))
        while together := list(islice(parts, SCORED_TOGETHER)):
            held, found = [], []
            for a, b in together:
                all_windows, bounds = windows(*t.buffer(column.slice(a, b - a), lower=True))
                codes, kinds = pd.factorize(all_windows)
                del all_windows
                held.append((codes.astype(np.int32 if len(kinds) < 1 << 31 else np.int64), bounds))
                found.append(kinds)
            codes, kinds = pd.factorize(np.concatenate(found))
            bits_by_kind = np.split(bits_of(mixer, slots, kinds)[codes], np.cumsum([len(f) for f in found])[:-1])
            del found, codes, kinds
            for (codes, bounds), by_kind in zip(held, bits_by_kind):
                bits = np.concatenate([[0.0], np.cumsum(by_kind[codes])])
                out["score"].append(-(bits[bounds[1:]] - bits[bounds[:-1]]) * np.log10(2))
                out["bytes"].append(np.diff(bounds))
            del held, bits, codes
        for a, b in t.slices(column, SCORE_SLICE):
            data, offsets = t.buffer(column.slice(a, b - a), lower=True)
            starts, ends, first = t.words(data, offsets)
            end = total[np.searchsorted(word, t.signed(np.array([_END])))]
            codes, kinds = pd.factorize(t.signed(t.span_hashes(data, starts, ends)))
            count = total[np.searchsorted(word, kinds)]
            base = np.concatenate([[0.0], np.cumsum((np.log10(count + 1) - log_all)[codes])])
            out["n_tokens"].append(np.diff(first) + 1)
            out["n_known"].append(t.per_row((count > 0)[codes], first) + (end > 0))
            out["base_score"].append(base[first[1:]] - base[first[:-1]] + np.log10(end + 1) - log_all)
        one = {c: np.concatenate(v) for c, v in out.items()}
        del data, starts, ends, first, codes, kinds, count, base, word, total, order
        t.settle()
        return pa.table(
            {
                "id": texts.column("id"),
                "held_out": pa.array(~texts.column("training").to_numpy(zero_copy_only=False).astype(bool)),
                "n_tokens": one["n_tokens"].astype(np.int64),
                "n_known": one["n_known"].astype(np.int64),
                "train_tokens": np.full(texts.num_rows, all_tokens, np.int64),
                "base_score": one["base_score"],
                "score": one["score"],
                "bits_per_byte": -one["score"] / np.log10(2) / one["bytes"],
            }
        )

    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run,
        f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double",
    )
