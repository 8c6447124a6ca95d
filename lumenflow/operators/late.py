"""Rows that come late or at the mark itself (S6/P6 beyond the strict mark).

A strict mark (``change_key > mark``) loses rows that carry the mark's own time but come after it was read, and all that
come later still with an older time. Here the increment begins at the mark less a lookback window, and
rows that the table holds already are taken out by their identity, so each is loaded exactly once.

Most of such an increment is known or surely new, and the exact anti-join need only see the rest:
a Bloom filter of the held rows is built with Spark's bitmap functions (two bits per row in ``BITS`` bits, one
partial aggregate, a table of at most ``BITS / 32768`` rows of 4 KB, which is broadcast) and lets
through to the join only rows that may be held. The filter says "new" only of rows that are; how many it passes on
in vain depends on how full it is, the result never does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.functions.columns import canonical

#: Size of the filter: 1 MB, under 5 % of new rows passed on in vain up to about a million held rows in the window.
BITS = 1 << 23
_HASHES = 2


def _identity(df: DataFrame, row_key: list[str]) -> Column:
    """The columns that tell rows apart as one struct; nulls equal nulls, maps in any order of entries."""
    return F.struct(*[canonical(F.col(c), df.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(row_key)])


def _places(identity: str) -> list[Column]:
    # functions of bitmaps count places from 1
    return [F.pmod(F.xxhash64(F.col(identity), F.lit(seed)), F.lit(BITS)) + 1 for seed in range(_HASHES)]


def bloom_filter(df: DataFrame, identity: str) -> DataFrame:
    """(bucket, bits): the bits of all rows' identities."""
    places = df.select(F.explode(F.array(*_places(identity))).alias("place"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    return places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(bits)


def _maybe_held(df: DataFrame, identity: str, held: DataFrame) -> DataFrame:
    """``df`` with ``__maybe``: whether all bits of a row's identity are set."""
    out, maybe = df, F.lit(True)
    for i, place in enumerate(_places(identity)):
        table = held.select(F.col("bucket").alias(f"__bucket_{i}"), F.col("bits").alias(f"__bits_{i}"))
        out = out.withColumn(f"__place_{i}", place)
        out = out.join(F.broadcast(table), F.bitmap_bucket_number(f"__place_{i}") == F.col(f"__bucket_{i}"), "left")
        position = f"bitmap_bit_position(__place_{i})"
        byte = f"CAST(conv(hex(substring(__bits_{i}, CAST({position} DIV 8 AS INT) + 1, 1)), 16, 10) AS BIGINT)"
        maybe = maybe & F.coalesce(F.expr(f"getbit({byte}, CAST({position} % 8 AS INT)) = 1"), F.lit(False))
    helpers = [f"__{name}_{i}" for i in range(_HASHES) for name in ("place", "bucket", "bits")]
    return out.withColumn("__maybe", maybe).drop(*helpers)


def rows_not_held(candidates: DataFrame, held: DataFrame, row_key: list[str] | None = None) -> DataFrame:
    """Rows of ``candidates`` whose identity no row of ``held`` has; of candidates with one identity, one.

    ``row_key`` (default: all columns of ``candidates``) tells rows apart. ``candidates`` is read twice: give a staged copy.
    """
    key = row_key or candidates.columns
    marked = candidates.withColumn("__id", _identity(candidates, key))
    known = held.select(_identity(held, key).alias("__id"))
    marked = marked.dropDuplicates(["__id"])
    split = _maybe_held(marked, "__id", bloom_filter(known, "__id"))
    checked = split.where("__maybe").join(known, "__id", "left_anti")
    return split.where("NOT __maybe").unionByName(checked).select(*candidates.columns)
