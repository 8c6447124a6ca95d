"""Words, hashes and column plumbing on Arrow text columns.

Everything here works on one Arrow batch inside a task. Texts are handled as
one UTF-8 byte buffer with document offsets, so that words, lines, shingles and
windows are numpy arrays instead of Python objects. Batches are cut into
slices of a few MB; a longer document is a slice of its own, never cut.

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR.
Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType

SLICE_BYTES = 2 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C55)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def settle() -> None:
    """Give what a task has freed back to the machine: a worker that waits for its next task should hold little."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def add_columns(
    df: DataFrame,
    inputs: Sequence[str],
    outputs: Sequence[tuple[str, DataType]],
    compute: Callable[..., Sequence],
    finish: Callable[[], None] | None = None,
) -> DataFrame:
    """``df`` plus ``outputs``, computed from the Arrow arrays of ``inputs``.

    All columns pass through. A column of ``df`` that has the name of an
    output is replaced by it. ``finish`` is called at the end of a task.
    """
    given = list(df.columns)
    made = [f"__made_{i}" for i in range(len(outputs))]
    schema = StructType(list(df.schema.fields) + [StructField(m, t) for m, (_, t) in zip(made, outputs)])
    at = [given.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = compute(*[batch.column(i) for i in at])
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*given, *made])
            del new
        if finish:
            finish()
        settle()

    names = {name for name, _ in outputs}
    out = df.mapInArrow(run, schema).drop(*[c for c in given if c in names])
    return out.withColumnsRenamed({m: name for m, (name, _) in zip(made, outputs)})


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column, each of ``most`` bytes or a single row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def buffer(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows); a null text is empty. ``lower``: A-Z only."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return (_LOWER[data] if lower else data), offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of each row's first word and the total)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the lines between LF bytes; a row has one at least."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    # a break that ends a row's text begins the row's empty last line
    row = np.searchsorted(offsets, starts, side="right") - 1
    per_row = np.bincount(np.searchsorted(offsets, breaks, side="right") - 1, minlength=len(offsets) - 1) + 1
    row = np.repeat(np.arange(len(offsets) - 1), per_row)
    return starts, ends, row


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finish)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, from one running polynomial of the buffer."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n + 1)[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power("down", _BASE_INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of one row: (hash, first word, row)."""
    per_row = np.maximum(np.diff(first) - (size - 1), 0)
    row = np.repeat(np.arange(len(per_row)), per_row)
    total = int(per_row.sum())
    at = np.arange(total) - np.repeat(np.cumsum(per_row) - per_row, per_row) + first[:-1][row]
    h = np.zeros(total, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(3) + hashes[at + k])
    return h, at, row


def per_row(counted: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``counted`` between consecutive ``bounds``."""
    sums = np.zeros(len(counted) + 1, np.int64)
    np.cumsum(counted, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark's long."""
    return h.astype(np.uint64, copy=False).view(np.int64)
