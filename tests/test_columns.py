from pyspark.sql import functions as F

from lumenflow.functions import columns as C


def test_cell_key_strips_punctuation_and_takes_five(spark):
    df = spark.createDataFrame([("(017)-84-1234",), ("(01)-2",), (None,)], "cell string")
    got = [r[0] for r in df.select(C.cell_key("cell")).collect()]
    assert got == ["01784", "012", None]


def test_substr_zero_start_equals_one(spark):
    # trap 1: substr(x, 0, 5) in Spark is the same as substr(x, 1, 5)
    r = spark.sql("select substr('0178412', 0, 5) a, substring('0178412', 1, 5) b").first()
    assert r.a == r.b == "01784"


def test_full_date_and_custid_null_propagation(spark):
    df = spark.createDataFrame([("2011", "11", "17"), (None, "11", "17")], "yr string, m string, d string")
    assert [r[0] for r in df.select(C.full_date("yr", "m", "d")).collect()] == ["2011-11-17", None]


def test_customer_type(spark):
    df = spark.createDataFrame([("x",), (None,)], "dt string")
    assert [r[0] for r in df.select(C.customer_type("dt")).collect()] == ["existing customer", "new customer"]


def test_mask_prefix(spark):
    df = spark.createDataFrame([("(017)-84-1234",), ("ab",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(C.mask_prefix("s", 0, 4)).collect()]
    assert got == ["****)-84-1234", "**", "", None]
    got = [r[0] for r in df.select(C.mask_prefix("s", 2, 3)).collect()]
    assert got == ["(0***-84-1234", "ab", "", None]


def test_strip_helpers(spark):
    df = spark.createDataFrame([("ann01", "(017)-84,12")], "u string, c string")
    r = df.select(C.strip_digits("u"), C.strip_phone_punctuation("c")).first()
    assert tuple(r) == ("ann", "0178412")


def test_array_helpers_fixture(spark):
    # FIXTURES nums: [1,2], [1,2,3,1], null
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3, 1],), (None,)], "nums array<int>")
    df = df.withColumn("d", C.distinct_elements("nums"))
    out = df.select(
        C.join_elements("d", "@").alias("j"),
        C.union_elements("nums", "d").alias("u"),
        *C.element_columns("nums", 3),
    ).collect()
    assert out[0].j == "1@2" and out[1].j == "1@2@3" and out[2].j is None
    assert out[1].u == [1, 2, 3]
    assert (out[0].col0, out[0].col1, out[0].col2) == (1, 2, None)  # out of range -> null
    assert out[2].col0 is None


def test_delimited_and_timestamped_id(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(C.delimited(["x", "y", "z"])).first()[0] == "a,c"
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert df.select(C.timestamped_id("x", ts)).first()[0] == "a2024-01-01 00:00:00"


def test_evaluate_once_keeps_rows_and_values(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    out = C.evaluate_once(df, ["k"], sq=F.col("k") * F.col("k")).where(F.col("sq") > 3)
    assert sorted(tuple(r) for r in out.collect()) == [(2, 4), (3, 9), (4, 16)]
