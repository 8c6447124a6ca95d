"""Registered queries for the individual operators of the enrichment and
the column helpers (P*, J1-J3, W1, S14, P10, D1-D8, C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow import schemas
from lumenflow.functions import columns as C
from lumenflow.operators import enrich as E
from lumenflow.operators.joins import key_equals
from lumenflow.operators.ranking import sequence_within_key
from lumenflow.plans.enrichment import derived_inputs
from lumenflow.plans.io_queries import _flat_users
from lumenflow.sources import derived as D

FIXED_TS = "2024-01-01 00:00:00"


def project_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 with a fixed timestamp in place of ``current_timestamp``."""
    users = derived_inputs(spark, sf_dir).users
    return E.project_users(users, F.lit(FIXED_TS).cast("timestamp_ntz"))


def explode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page filter + explode + nested paths."""
    return _flat_users(derived_inputs(spark, sf_dir).users)


def left_join_computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users left-joined with the profile on the cell key."""
    i = derived_inputs(spark, sf_dir)
    u = i.users.select("username", "cell", C.cell_key("cell", D.KEY_WIDTH).alias("cell_key"))
    cp = i.custprof
    j = u.join(cp, key_equals(F.col("cell_key"), u.schema["cell_key"].dataType, F.col("id"), cp.schema["id"].dataType), "left")
    return j.select("username", "cell", "cell_key", F.col("age").alias("profile_age"), "profession")


def left_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output row per (user row, log line of that user)."""
    i = derived_inputs(spark, sf_dir)
    u = i.users.select("username", "page", C.cell_key("cell", D.KEY_WIDTH).alias("cell_key"))
    wl = i.weblog.select(F.col("username").alias("log_user"), "ip", "dt", "statuscd")
    j = u.join(wl, F.col("log_user") == F.col("cell_key"), "left")
    return j.select("username", "page", "ip", "dt", "statuscd")


def left_join_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text status code against the numeric code of the dimension."""
    i = derived_inputs(spark, sf_dir)
    ws = i.status
    cond = key_equals(F.col("statuscd"), i.weblog.schema["statuscd"].dataType, F.col("cd"), ws.schema["cd"].dataType)
    return i.weblog.join(ws, cond, "left").select("username", "dt", "statuscd", "category", "desc")


def row_number_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines numbered per user by the text time parts
    (month names sort alphabetically, as in the reference)."""
    wl = derived_inputs(spark, sf_dir).weblog
    order = [F.col(c).asc_nulls_first() for c in E.LOG_TIME_PARTS + ["ip", "dt", "verb", "page", "statuscd"]]
    return sequence_within_key(wl, ["username"], order, "version").select(
        "username", "dt", "yr", "month", "day", "hr", "mt", "sec", "version"
    )


def nested_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested record per conversation turn, read back by path."""
    conv = D.table(spark, sf_dir, "conversations")
    words = F.size(F.split(F.col("text"), " "))
    rec = conv.select(
        "conv_id", "turn",
        F.array(F.col("turn").cast("int"), F.length("text"), words).alias("an_array"),
        F.create_map("role", "text").alias("a_map"),
        F.struct(F.col("turn").cast("int").alias("x")).alias("a_struct"),
        F.array(
            F.struct(F.col("role").alias("foo"), F.col("turn").cast("int").alias("bar"),
                     F.array(F.length("text").cast("double"), words.cast("double")).alias("vals"))
        ).alias("an_array_of_structs"),
    )
    typed = rec.select("conv_id", "turn", *[F.col(f.name).cast(f.dataType) for f in schemas.NESTED_RECORD.fields])
    return typed.select(
        "conv_id", "turn",
        *C.element_columns("an_array", 3),
        F.col("a_map")[F.lit("user")].alias("user_text"),
        F.col("a_struct.x").alias("x"),
        F.col("an_array_of_structs")[0]["foo"].alias("foo"),
        F.get(F.col("an_array_of_structs")[0]["vals"], 1).alias("val1"),
    )


def _nums(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = D.table(spark, sf_dir, "orders")
    nums = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(
        F.array((F.col("o_custkey") % 5).cast("int"), (F.col("o_orderkey") % 3).cast("int"),
                (F.col("o_custkey") % 5).cast("int"))
    )
    return o.select("o_orderkey", nums.alias("nums"))


def array_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct, join with '@', union, first three elements."""
    df = _nums(spark, sf_dir).withColumn("arr_dist", C.distinct_elements("nums"))
    return df.select(
        "o_orderkey",
        C.join_elements("arr_dist", "@").alias("joined"),
        C.join_elements(C.union_elements("nums", "arr_dist"), ",").alias("union_text"),
        *C.element_columns("nums", 3),
    )


def mask_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional masks of cell (0, 4) and email (0, 5)."""
    u = derived_inputs(spark, sf_dir).users
    return u.select("username", C.mask_prefix("cell", 0, 4).alias("cell_masked"),
                    C.mask_prefix("email", 0, 5).alias("email_masked"))


def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits out of the username, punctuation out of the phone, a
    wide projection with a time stamp, and the row as one delimited line."""
    u = derived_inputs(spark, sf_dir).users
    ts = F.lit(FIXED_TS).cast("timestamp_ntz")
    return u.select(
        "username",
        C.strip_digits(F.concat(F.col("first"), F.col("username"))).alias("name_letters"),
        C.strip_phone_punctuation("cell").alias("cell_digits"),
        ts.alias("time_stamp"),
        C.delimited(["first", "email", "uscity", "state", "country"], ",").alias("line"),
    )


QUERIES = {
    "project_users": project_users,
    "explode_filter": explode_filter,
    "left_join_computed_key": left_join_computed_key,
    "left_join_fanout": left_join_fanout,
    "left_join_status": left_join_status,
    "row_number_version": row_number_version,
    "nested_collection": nested_collection,
    "array_helpers": array_helpers,
    "mask_columns": mask_columns,
    "clean_columns": clean_columns,
}
