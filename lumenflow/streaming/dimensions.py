"""Static dimensions next to a stream.

Two options, choose per dimension:

* leave it **uncached**: a stream-static join re-reads the static side in
  every micro-batch, so changes in the source show up at the next batch
  (right for small JDBC tables and for files that are replaced);
* :class:`DimensionHolder`: a parsed copy in the shared folder, written anew after ``ttl_seconds``. With
  ``bucket_by`` the copy is a bucketed table, so joins on these columns read it without a shuffle, however often a
  batch joins it. Nothing is kept in executors: a lost one costs a read, not a new load from the source.

A refresh writes a new version beside the old one and then shows it. The old version stays until the next
refresh, as a running batch may still read it; the one before is removed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenflow.session import discard, scratch_path


class DimensionHolder:
    def __init__(self, loader: Callable[[], DataFrame], ttl_seconds: float = 60.0,
                 view_name: str | None = None, clock: Callable[[], float] = time.monotonic,
                 bucket_by: tuple[int, list[str]] | None = None):
        self._loader = loader
        self._ttl = ttl_seconds
        self._view = view_name
        self._clock = clock
        self._bucket_by = bucket_by
        self._df: DataFrame | None = None
        self._spark: SparkSession | None = None
        self._versions: list[tuple[str, str | None]] = []  # (folder, table) of the live versions
        self._loaded_at = 0.0
        self.refreshes = 0

    def current(self) -> DataFrame:
        if self._df is None or self._clock() - self._loaded_at >= self._ttl:
            self.refresh()
        return self._df

    def refresh(self) -> DataFrame:
        loaded = self._loader()
        self._spark = spark = loaded.sparkSession
        path, table = scratch_path(spark, "dimension"), None
        if self._bucket_by:
            n, columns = self._bucket_by
            table = f"dimension_{uuid.uuid4().hex[:12]}"
            # rebalanced: a key with very many rows is spread over tasks, whose files are of one bucket all the same
            loaded.hint("rebalance", *columns).write.bucketBy(n, *columns).sortBy(*columns).option("path", path).saveAsTable(table)
            new = spark.table(table)
        else:
            loaded.write.parquet(path)
            new = spark.read.schema(loaded.schema).parquet(path)
        self._df, self._loaded_at = new, self._clock()
        self.refreshes += 1
        if self._view:
            new.createOrReplaceTempView(self._view)
        self._versions.append((path, table))
        while len(self._versions) > 2:
            self._remove(*self._versions.pop(0))
        return new

    def _remove(self, path: str, table: str | None) -> None:
        if table:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        discard(self._spark, path)

    def close(self) -> None:
        for version in self._versions:
            self._remove(*version)
        self._versions, self._df = [], None
