"""Registered driver queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the warehouse tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenflow.plans import enrichment, history_queries, io_queries, operator_queries, stream_queries

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, Query]:
    return {
        "enrich_customers": enrichment.enrich_customers,
        "enrich_customers_skew_safe": enrichment.enrich_customers_skew_safe,
        "enrich_counts": enrichment.enrich_counts,
        **history_queries.QUERIES,
        **io_queries.QUERIES,
        **operator_queries.QUERIES,
        **stream_queries.QUERIES,
    }
