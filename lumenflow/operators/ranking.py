"""Per-key sequence numbers (``row_number`` over a key, ordered).

Two strategies with identical results:

* ``window`` - ``row_number().over(partitionBy(keys).orderBy(order))``:
  one shuffle on the keys; every row of a key lands in one task.
* ``range`` - skew-safe. Rows are range-partitioned on ``keys + order``
  (a hot key is spread over many partitions by the sampled bounds), each
  partition numbers its own run of a key, and a small per
  (partition, key) count table turns local numbers into global ones via a
  running sum. No task ever holds more than one range partition, whatever
  the key distribution. Costs one extra shuffle of the data plus a
  shuffle of the (much smaller) count table. Only the first key of a range can have rows in earlier
  ones, so the numbers to be added are at most one per range and are broadcast.

With the number of rows known (``rows``; ``auto`` counts them) both use as many tasks as the rows need.

* ``auto`` - counts rows per key first (a partial aggregate that reads
  only the key columns) and takes ``range`` when the largest key holds more
  than ``hot_key_rows`` rows, ``window`` otherwise.

The ordering must be total (add a unique tie-break column) for either
strategy to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.session import ROWS_PER_TASK, sized


def _order_cols(order: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


# Rows one task can sort and number comfortably (a few hundred MB).
DEFAULT_HOT_KEY_ROWS = 5_000_000


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows of the largest key group, rows of all); zeros for an empty frame."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return int(found[0] or 0), int(found[1] or 0)


def hottest_key_rows(df: DataFrame, keys: list[str]) -> int:
    """Row count of the largest key group (0 for an empty frame)."""
    return group_sizes(df, keys)[0]


def sequence_within_key(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    out_col: str = "version",
    strategy: str = "window",
    num_partitions: int | None = None,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    rows: int | None = None,
) -> DataFrame:
    if strategy == "auto":
        largest, rows = group_sizes(df, keys)
        strategy = "range" if largest > hot_key_rows else "window"
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
        return sized(df, rows or 0, *keys).withColumn(out_col, F.row_number().over(w))
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")

    n = num_partitions or max(-(-(rows or 0) // ROWS_PER_TASK), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order_cols = _order_cols(order)
    # 1. spread rows by ranges of (keys, order); hot keys span partitions.
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], *order_cols)
    ranged = ranged.withColumn("__pid", F.spark_partition_id())
    # The partition id must be fixed before it is used twice.
    ranged = ranged.checkpoint(eager=True)
    # 2. local number inside (partition, key): groups bounded by partition size.
    local_w = Window.partitionBy("__pid", *keys).orderBy(*order_cols)
    numbered = sized(ranged, rows or 0, "__pid", *keys).withColumn("__local", F.row_number().over(local_w))
    # 3. rows of each key held by earlier partitions.
    counts = ranged.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__cnt").over(before), F.lit(0))).where("__offset > 0")
    own = {k: f"__of_{i}" for i, k in enumerate(["__pid", *keys])}
    offsets = offsets.select(*[F.col(k).alias(name) for k, name in own.items()], "__offset")
    same = [F.col(k).eqNullSafe(F.col(name)) for k, name in own.items()]
    joined = numbered.join(F.broadcast(offsets), same, "left")  # at most a row per range
    version = (F.col("__local") + F.coalesce("__offset", F.lit(0))).cast("int").alias(out_col)
    return joined.select(*[F.col(c) for c in df.columns if c != out_col], version)
