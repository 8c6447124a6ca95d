"""Catalog-table sinks (K1) and display helpers (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None,
               partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
               fmt: str = "parquet") -> None:
    """``saveAsTable``; ``path`` makes it an external table in a shared folder."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """``select * from db.table``."""
    return spark.table(table)


def show(df: DataFrame, n: int = 20, truncate: bool = False, schema: bool = False) -> None:
    """K5: print the schema and/or ``n`` rows (only ``n`` reach the driver)."""
    if schema:
        df.printSchema()
    df.show(n, truncate)
