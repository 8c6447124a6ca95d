"""Enrichment job shells: bind sources -> operators -> sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lumenflow import schemas
from lumenflow.operators import enrich as E
from lumenflow.session import spread
from lumenflow.sources import derived as D
from lumenflow.sources import files


@dataclass
class EnrichmentInputs:
    users: DataFrame
    custprof: DataFrame
    weblog: DataFrame
    status: DataFrame
    doc_quarantine: DataFrame
    log_quarantine: DataFrame


def users_from_json(values: DataFrame, schema=schemas.USER_DOC, value_col: str = "value"):
    """JSON text -> (flattened users, quarantined text)."""
    good, bad = files.split_corrupt(files.parse_json_column(values, schema, value_col))
    return E.flatten_users(good), bad


def derived_inputs(spark: SparkSession, sf_dir: str) -> EnrichmentInputs:
    """All enrichment inputs derived from the warehouse tables."""
    docs = D.documents(spark, sf_dir)
    users, doc_bad = users_from_json(docs)
    orders = spread(D.table(spark, sf_dir, "orders"))
    weblog, log_bad = files.split_quarantine(files.parse_weblog(D.weblog_lines(orders)))
    return EnrichmentInputs(
        users=users,
        custprof=D.custprof_from_customer(D.table(spark, sf_dir, "customer")),
        weblog=weblog,
        status=D.status_dimension(spark),
        doc_quarantine=doc_bad,
        log_quarantine=log_bad,
    )


def enrich_customers(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    i = derived_inputs(spark, sf_dir)
    return E.enrich(i.users, i.custprof, i.weblog, i.status, key_length=D.KEY_WIDTH, **kw)


def enrich_counts(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    i = derived_inputs(spark, sf_dir)
    return E.enrich_counts(i.users, i.custprof, i.weblog, i.status, key_length=D.KEY_WIDTH, **kw)


def enrich_customers_skew_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 with the skew-safe version numbering (same result)."""
    return enrich_customers(spark, sf_dir, version_strategy="range")
