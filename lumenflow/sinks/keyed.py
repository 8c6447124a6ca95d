"""Keyed document sink with upsert semantics (K2), connector-free.

Stand-in for a document index whose id field is a key column: *last write wins* per key, by
batch and within a batch by ``order``. Documents lie in a :class:`DeltaStore`: a batch costs what the batch
holds, a batch that was applied is skipped when it comes again, and a stream that starts
over with a new checkpoint is a run of its own, none of whose batches is taken for an old one.

Rows whose key is null cannot be addressed in an index; they are written to
a side folder ``_null_keys`` (one folder per run and batch) instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.session import discard, staged
from lumenflow.sinks.deltas import DeltaStore


class KeyedUpsertSink:
    def __init__(self, root: str, key: str, order: list[str] | None = None, buckets: int = 16, unique: bool = False):
        """``unique``: no batch has two rows of one key, so none needs merging in itself."""
        self.root = root.rstrip("/")
        self.key = key
        self.order = order or []
        self.unique = unique
        self.store = DeltaStore(f"{self.root}/index", [key], "last", self.order, buckets)

    def read(self, spark: SparkSession) -> DataFrame | None:
        return self.store.read(spark)

    def null_keys(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/_null_keys")

    def upsert(self, batch: DataFrame, batch_id: int, run: str = "", replay: bool = False, count: int | None = None) -> bool:
        """Merge ``batch`` (of ``count`` rows, if known); returns False when the batch was already applied."""
        spark = batch.sparkSession
        if self.store.applied(spark, run, batch_id, replay):
            return False
        key, side = F.col(self.key), f"{self.root}/_null_keys/run={run or 'none'}/batch={batch_id}"
        if not batch.schema[self.key].nullable:  # an expression that is never null: the batch feeds one write only
            spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(side)
            return self.store.apply(batch, run, batch_id, replay, unique=self.unique, count=count)
        # The batch feeds two writes (null keys, index): compute it once, into a copy that outlives executors.
        batch, path = staged(batch, "upsert")
        try:
            batch.where(key.isNull()).write.mode("overwrite").parquet(side)
            return self.store.apply(batch.where(key.isNotNull()), run, batch_id, replay, unique=self.unique, count=batch.count())
        finally:
            discard(spark, path)
