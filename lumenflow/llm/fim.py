"""Fill-in-the-middle: a text cut twice at unit borders and put in another order.

A unit is a word with the separators before it; separators at the end of a text are a
unit of their own. The two cuts come from a hash of the document's id, so a rerun cuts alike.

Method, on slices of a few MB of UTF-8 inside a task (a longer text is a slice of its own):
every byte gets one of four classes (does a unit end after it, does a code point begin with
it), and a wavelet matrix is built over the classes. Ranks of the two ending classes add up
to the number of units before any place, those of the two beginning classes to the number of
code points. The units of a text are a difference of two such counts; a cut after ``u`` units
is found by bisection on the counts, for all texts of the slice at once. No list of tokens is
made; memory is a few bits and one class byte per byte of text.

The middle goes last: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is
``<S>suffix<P>prefix<M>middle``; a text that is empty, holds a mark itself, or isn't drawn
stays as it is (``plain``).

Odd input: a null text is empty (0 units, plain); a null id is hashed as no characters; rows
that repeat an id are cut by the same two hashes, each at its own units; texts of separators
only are one unit; an empty table gives an empty result; columns of the input with the name
of an output are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from lumenflow.llm.fmindex import WaveletMatrix
from lumenflow.llm.textops import add_columns, buffer, slices

#: Fixed values of the form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
#: Classes of bytes: inside or at the end of a unit; in or at the beginning of a code point.
ENDING, BEGINNING = (1, 3), (2, 3)


def classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Class of each byte: 1 where a unit of its row ends after it, plus 2 where a code point begins."""
    separator = _SEPARATOR[data]
    ends = np.zeros(len(data), bool)
    ends[:-1] = ~separator[:-1] & separator[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = True  # the last byte of a text ends a word or the separators at the end
    return ends.astype(np.uint8) | ((data & 0xC0 != 0x80).astype(np.uint8) << 1)


class Units:
    """Counts and places of units and code points in a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.matrix = WaveletMatrix(classes(data, offsets), 3)
        self.begin, self.end = offsets[:-1], offsets[1:]

    def _before(self, kinds: Sequence[int], at: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(np.full(len(at), kind), at) for kind in kinds)

    def number(self) -> np.ndarray:
        """Units of each text."""
        return self._before(ENDING, self.end) - self._before(ENDING, self.begin)

    def chars(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        return self._before(BEGINNING, end) - self._before(BEGINNING, begin)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The place after the first ``units`` units of each text."""
        wanted = self._before(ENDING, self.begin) + units
        low, high = self.begin.copy(), self.end.copy()
        while np.any(low < high):
            middle = (low + high) // 2
            reached = self._before(ENDING, middle) >= wanted
            high = np.where(reached, middle, high)
            low = np.where(reached, low, np.minimum(middle + 1, high))
        return high


def _arrange(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array, fim_percent: int, spm_percent: int) -> list[pa.Array]:
    draws = [np.asarray(h.to_numpy(zero_copy_only=False), np.int64) for h in (h1, h2, h3, h4)]
    marked = np.zeros(len(text), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.fill_null(pc.match_substring(text, mark), False).to_numpy(zero_copy_only=False)
    number, form, prefix, middle, output = [], [], [], [], []
    for begin, end in slices(text):
        data, offsets = buffer(text.slice(begin, end - begin))
        units = Units(data, offsets)
        n = units.number()
        a, b, c, d = (h[begin:end] for h in draws)
        first, second = a % (n + 1), b % (n + 1)
        cut1, cut2 = units.cut(np.minimum(first, second)), units.cut(np.maximum(first, second))
        plain = (n == 0) | marked[begin:end] | (c % 100 >= fim_percent)
        spm = d % 100 < spm_percent
        number += n.tolist()
        sizes = zip(units.chars(units.begin, cut1).tolist(), units.chars(cut1, cut2).tolist())
        raw = data.tobytes()
        for is_plain, is_spm, low, x, y, high, (in_prefix, in_middle) in zip(plain.tolist(), spm.tolist(), units.begin.tolist(), cut1.tolist(), cut2.tolist(), units.end.tolist(), sizes):
            form.append("plain" if is_plain else "spm" if is_spm else "psm")
            prefix.append(None if is_plain else in_prefix)
            middle.append(None if is_plain else in_middle)
            p, m, s = raw[low:x], raw[x:y], raw[y:high]
            if is_plain:
                output.append(raw[low:high])
            elif is_spm:
                output.append(b"".join((SUFFIX.encode(), s, PREFIX.encode(), p, MIDDLE.encode(), m)))
            else:
                output.append(b"".join((PREFIX.encode(), p, SUFFIX.encode(), s, MIDDLE.encode(), m)))
    return [pa.array(number, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]


def transform(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """``docs`` plus n (units), form, prefix_chars, middle_chars and output (the text in its form)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [f"__draw_{i}" for i in range(4)]
    drawn = docs.select("*", *[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(draws)])
    outputs = [("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType()), ("output", StringType())]
    return add_columns(drawn, [text, *draws], outputs, lambda *given: _arrange(*given, fim_percent, spm_percent)).drop(*draws)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that ``output`` in ``form`` was made of. A text in marks holds each mark once, so splitting there is exact."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "<[PSM]>", -1)
    one, two, three = (F.get(parts, i) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)
