"""SQL text files as jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql_file(spark: SparkSession, path: str, views: dict[str, DataFrame], args: dict | None = None) -> DataFrame:
    """The whole file (any number of lines) is one statement, run over
    the given named inputs; ``args`` binds ``:name`` parameter markers."""
    texts = [r[0] for r in spark.read.text(path, wholetext=True).take(2) if r[0].strip()]
    if len(texts) != 1:
        raise ValueError(f"{path} must hold exactly one statement file, not {len(texts)}")
    text = texts[0]
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args) if args else spark.sql(text)
