import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lumenflow import schemas
from lumenflow.sinks import tables
from lumenflow.sources import files, jdbc
from lumenflow.sources.sqltext import run_sql_file

XML = """<statuses>
  <httpstatus><cd>100</cd><category>Informational</category><desc>Continue</desc></httpstatus>
  <httpstatus><cd>404</cd><category>Client error</category><desc>Not found</desc></httpstatus>
</statuses>"""


def test_xml_rows_inferred(spark, tmp_dir):
    with open(f"{tmp_dir}/http_status.xml", "w") as fh:
        fh.write(XML)
    df = files.read_xml(spark, f"{tmp_dir}/http_status.xml", "httpstatus")
    assert df.schema["cd"].dataType.typeName() == "long"
    assert sorted((r.cd, r.desc) for r in df.collect()) == [(100, "Continue"), (404, "Not found")]
    typed = files.read_xml(spark, f"{tmp_dir}/http_status.xml", "httpstatus", schemas.HTTP_STATUS)
    assert typed.count() == 2


def test_csv_strings_to_table(spark, tmp_dir):
    with open(f"{tmp_dir}/t.csv", "w") as fh:
        fh.write("1,a,2.5\n2,b,\n")
    df = files.read_csv_strings(spark, f"{tmp_dir}/t.csv")
    assert df.columns == ["_c0", "_c1", "_c2"] and all(f.dataType.typeName() == "string" for f in df.schema)
    tables.save_table(df, "people_table", path=f"{tmp_dir}/tbl")
    assert tables.read_table(spark, "people_table").count() == 2


def test_text_sink_roundtrip_and_single_column_rule(spark, tmp_dir):
    df = spark.createDataFrame([("a|b",), ("c|d",)], "line string")
    files.write_text(df, f"{tmp_dir}/txt")
    assert sorted(r.value for r in files.read_text(spark, f"{tmp_dir}/txt").collect()) == ["a|b", "c|d"]
    with pytest.raises(ValueError):
        files.write_text(df.withColumn("x", F.lit(1)), f"{tmp_dir}/txt2")


def test_sql_text_file_multiline_with_parameters(spark, tmp_dir):
    path = f"{tmp_dir}/q.sql"
    with open(path, "w") as fh:
        fh.write("SELECT id\nFROM tv_nums\nWHERE id > :lo\n")
    out = run_sql_file(spark, path, {"tv_nums": spark.range(5)}, args={"lo": 2})
    assert sorted(r.id for r in out.collect()) == [3, 4]


def test_nested_records_from_collection(spark):
    data = [
        ([10, 20, 30], {"k1": "v1"}, (7,), [("north", 3, [0.5, 1.5, 5.0]), ("south", 4, [2.5, 3.5, 5.0])]),
        ([40, 50, 60], {"k2": "v2"}, (8,), [("east", 5, [6.5, 7.5]), ("west", 6, [8.5, 9.5])]),
    ]
    df = spark.createDataFrame(data, schemas.NESTED_RECORD)
    assert [r.an_array for r in df.select("an_array").collect()] == [[10, 20, 30], [40, 50, 60]]
    third = [r[0] for r in df.select(F.get(F.col("an_array_of_structs")[1]["vals"], 2)).collect()]
    assert third == [5.0, None]  # get() tolerates short arrays under ANSI
    # map columns cannot take part in set operations (SCD union must avoid them)
    with pytest.raises(AnalysisException):
        df.union(df).distinct().collect()


@pytest.fixture(scope="module")
def derby(spark):
    src = jdbc.derby_memory("lftests")
    df = spark.createDataFrame(
        [("04715", 33, "engineer"), ("02000", 41, "teacher"), ("03000", 25, "nurse")], schemas.CUSTPROF
    ).withColumn("n", F.monotonically_increasing_id())
    jdbc.write_table(df, src, "CUSTPROF")
    return src


def test_jdbc_table_query_partitioned(spark, derby):
    assert jdbc.read_table(spark, derby, "CUSTPROF").count() == 3
    q = jdbc.read_query(spark, derby, 'SELECT "id", "age" FROM CUSTPROF WHERE "age" > 30')
    assert sorted(r.id for r in q.collect()) == ["02000", "04715"]
    part = jdbc.read_table(spark, derby, "CUSTPROF", jdbc.Partitioning("age", 20, 50, 3))
    assert part.rdd.getNumPartitions() == 3 and part.count() == 3
    pq = jdbc.read_query(spark, derby, 'SELECT * FROM CUSTPROF WHERE "profession" <> \'nurse\'',
                         jdbc.Partitioning("age", 20, 50, 2))
    assert pq.count() == 2


def test_jdbc_incremental_pushdown(spark, derby):
    inc = jdbc.read_incremental(spark, derby, "CUSTPROF", "age", 33)
    assert [r.id for r in inc.collect()] == ["02000"]
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(age,33)" in plan


def test_kafka_options_shape():
    from lumenflow.sources.streams import kafka_options

    o = kafka_options("h:9092", ["users", "orders"], "earliest", '{"orders":{"0":2}}')
    assert o["subscribe"] == "users,orders" and o["endingOffsets"] == '{"orders":{"0":2}}'
    assert o["startingOffsets"] == "earliest"
