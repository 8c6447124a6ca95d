"""Registered source/sink queries: each stages a warehouse table in the
format under test (in the shared stage folder), reads it back with the
engine's source and returns the result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow import schemas
from lumenflow.operators import enrich as E
from lumenflow.operators import scd
from lumenflow.plans.history import overwrite_from_self, run_scd
from lumenflow.plans.history_queries import CHANGE_KEY, KEYS, TIEBREAK, before_cutoff
from lumenflow.sinks import tables
from lumenflow.sources import derived as D
from lumenflow.sources import files, jdbc
from lumenflow.session import scratch_path, spread
from lumenflow.sources.sqltext import run_sql_file
from lumenflow.streaming.schema_sampling import SchemaStore, sample_schema

USER_OUT = [
    "page", "cell", "first", "age", "email", "uscity", "latitude", "longitude", "country", "state",
    "tz_offset", "tz_description", "username",
]


def _flat_users(users: DataFrame) -> DataFrame:
    return users.select(
        *[c for c in E.USER_COLUMNS if c != "timezone"],
        F.col("timezone.offset").alias("tz_offset"),
        F.col("timezone.description").alias("tz_description"),
    ).select(*USER_OUT)


def xml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written as XML, read back by row tag with inference."""
    path = scratch_path(spark, "xml")
    files.write_xml(D.table(spark, sf_dir, "customer"), path, row_tag="customer", root_tag="customers")
    return files.read_xml(spark, path, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def _weblog_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "weblog")
    files.write_text(D.weblog_lines(spread(D.table(spark, sf_dir, "orders"))), path)
    return path


def weblog_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-log text file -> 18 string columns (good lines)."""
    good, _ = files.read_weblog(spark, _weblog_file(spark, sf_dir))
    return good


def weblog_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 (trap 6): short lines with their reason instead of a failed batch."""
    _, bad = files.read_weblog(spark, _weblog_file(spark, sf_dir))
    return bad


def csv_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless CSV -> catalog table -> ``select *``."""
    src = scratch_path(spark, "csv")
    D.table(spark, sf_dir, "customer").write.mode("overwrite").csv(src)
    table = f"csv_ingest_{uuid.uuid4().hex[:8]}"
    tables.save_table(files.read_csv_strings(spark, src), table, path=scratch_path(spark, "tbl"))
    return tables.read_table(spark, table)


def json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema inferred from the JSON text itself, then parsed."""
    docs = D.documents(spark, sf_dir)
    found = files.infer_json_schema(docs)
    good, _ = files.split_corrupt(files.parse_json_column(docs, found))
    return _flat_users(E.flatten_users(good))


def json_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed documents isolated with their text."""
    docs = D.documents(spark, sf_dir)
    _, bad = files.split_corrupt(files.parse_json_column(docs, schemas.USER_DOC))
    return bad


def json_mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of changing shape, single and in arrays, read with the schema inferred from them."""
    docs = D.mixed_documents(spread(D.table(spark, sf_dir, "events")))
    good, bad = files.read_json_column(docs)
    wanted = ["id", "v", "extra.n", "extra.m", F.size("tags").alias("n_tags"), "none", F.lit(None).cast("string").alias("corrupt")]
    return good.select(*wanted).unionByName(bad.select(F.col(schemas.CORRUPT_COLUMN).alias("corrupt")), allowMissingColumns=True)


def json_sample_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled documents -> text files -> inferred schema, merged with the expected one at every
    depth -> kept as a version of the stream's schema -> used to parse every document, with a field that only the sample knows."""
    docs = D.documents_from_events(spread(D.table(spark, sf_dir, "events")), ranked=True)
    store = SchemaStore(scratch_path(spark, "schema"), schemas.USER_DOC)
    sample_schema(docs.sample(fraction=0.05, seed=7), scratch_path(spark, "sample"), store=store)
    good, _ = files.split_corrupt(files.parse_json_column(docs, store.current(spark)))
    rank = good.select("info.page", F.explode("results").alias("u")).select("page", "u.login.username", "u.rank.tier", "u.rank.points")
    return rank.where("page IS NOT NULL")


# The history job as one SQL statement (S15): rows of the increment are numbered
# within their customer from the last number the history has; equal rows count once.
SCD2_SQL = """
WITH last_number AS (
  SELECT o_custkey, max(version) AS n FROM order_history GROUP BY o_custkey
),
numbered AS (
  SELECT i.*, row_number() OVER (PARTITION BY i.o_custkey ORDER BY i.o_orderdate, i.o_orderkey) AS k
  FROM order_increment i
)
SELECT o_orderkey, d.o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(k + ifnull(n, 0) AS INT) AS version
FROM numbered d LEFT JOIN last_number l ON d.o_custkey <=> l.o_custkey
UNION DISTINCT
TABLE order_history
"""


def sql_text_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sql")
    spark.createDataFrame([(SCD2_SQL,)], "value string").write.mode("overwrite").text(path)
    orders = D.table(spark, sf_dir, "orders")
    old = scd.scd2_initial(before_cutoff(orders), KEYS, CHANGE_KEY, TIEBREAK)
    new = scd.incremental_after(orders, old, CHANGE_KEY)
    return run_sql_file(spark, path, {"order_history": old, "order_increment": new})


def scd2_merge_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history job with the merge given as a SQL file."""
    path = scratch_path(spark, "sql")
    text = SCD2_SQL.replace("order_history", "history").replace("order_increment", "increment")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    orders, table = D.table(spark, sf_dir, "orders"), f"orders_sql_{uuid.uuid4().hex[:8]}"
    for source in (before_cutoff(orders), orders):
        run_scd(spark, 2, table, source, KEYS, CHANGE_KEY, TIEBREAK, location_root=scratch_path(spark, "history"), merge_sql=path)
    return spark.table(table)


def text_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows -> delimited text files -> read back as strings."""
    path = scratch_path(spark, "text")
    o = D.table(spark, sf_dir, "orders")
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in
                             ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")])
    files.write_text(o.select(line.alias("value")), path)
    return files.read_text(spark, path).selectExpr("CAST(value AS STRING) AS line")


def checkpoint_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3/V4/K1: a table replaced by a transform of its own contents."""
    table = f"ckpt_customer_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, "tbl")
    if not spark.catalog.tableExists(table):
        tables.save_table(D.table(spark, sf_dir, "customer"), table, path=path)
    return overwrite_from_self(
        spark, table, lambda cur: cur.withColumn("c_mktsegment", F.lower("c_mktsegment")), path=path
    )


# --------------------------------------------------------------------- JDBC
def _derby_with(spark: SparkSession, sf_dir: str, name: str) -> jdbc.JdbcSource:
    src = jdbc.derby_memory(f"lf{uuid.uuid4().hex[:10]}")
    jdbc.write_table(D.table(spark, sf_dir, name), src, name.upper())
    return src


def jdbc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-table read."""
    return jdbc.read_table(spark, _derby_with(spark, sf_dir, "customer"), "CUSTOMER")


def jdbc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate pushed into the database as SQL text."""
    src = _derby_with(spark, sf_dir, "customer")
    q = ('SELECT "c_nationkey", COUNT(*) AS "n_customers", SUM("c_acctbal") AS "sum_acctbal" '
         'FROM CUSTOMER GROUP BY "c_nationkey"')
    return jdbc.read_query(spark, src, q).select(
        "c_nationkey", F.col("n_customers").cast("bigint").alias("n_customers"),
        F.round("sum_acctbal", 2).alias("sum_acctbal"),
    )


def jdbc_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 at scale: four parallel range reads on the key."""
    customer = D.table(spark, sf_dir, "customer")
    src = _derby_with(spark, sf_dir, "customer")
    lo, hi = jdbc.key_bounds(customer, "c_custkey")
    return jdbc.read_table(spark, src, "CUSTOMER", jdbc.Partitioning("c_custkey", lo, hi + 1, 4))


def jdbc_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after the high-water mark, filter pushed into the database."""
    orders = D.table(spark, sf_dir, "orders")
    src = _derby_with(spark, sf_dir, "orders")
    mark = scd.high_water_mark(before_cutoff(orders), CHANGE_KEY)
    lo, hi = jdbc.key_bounds(orders, "o_orderkey")
    return jdbc.read_incremental(spark, src, "ORDERS", CHANGE_KEY, mark,
                                 jdbc.Partitioning("o_orderkey", lo, hi + 1, 4))


QUERIES = {
    "xml_rows": xml_rows,
    "weblog_text": weblog_text,
    "weblog_quarantine": weblog_quarantine,
    "csv_to_table": csv_to_table,
    "json_infer": json_infer,
    "json_corrupt": json_corrupt,
    "json_mixed_documents": json_mixed_documents,
    "json_sample_schema": json_sample_schema,
    "sql_text_job": sql_text_job,
    "scd2_merge_sql_job": scd2_merge_sql_job,
    "text_sink_roundtrip": text_sink_roundtrip,
    "checkpoint_overwrite": checkpoint_overwrite,
    "jdbc_table": jdbc_table,
    "jdbc_query": jdbc_query,
    "jdbc_partitioned": jdbc_partitioned,
    "jdbc_incremental": jdbc_incremental,
}
