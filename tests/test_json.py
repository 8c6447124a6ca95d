import json

from pyspark.sql import types as T

from lumenflow import schemas
from lumenflow.operators import enrich as E
from lumenflow.sources import files

from fixtures import DOCS


def _docs(spark):
    return spark.createDataFrame([(d,) for d in DOCS], "value string")


def test_parse_with_quarantine(spark):
    good, bad = files.split_corrupt(files.parse_json_column(_docs(spark), schemas.USER_DOC))
    assert good.count() == len(DOCS) - 1
    assert bad.first()[0].startswith('{"info": {"page": "p6"}')


def test_flatten_users_cases(spark):
    good, _ = files.split_corrupt(files.parse_json_column(_docs(spark), schemas.USER_DOC))
    users = E.flatten_users(good)
    pages = sorted(r.page for r in users.collect())
    # p1 has two results, p2/p3 none, null page and missing info dropped
    assert pages == ["p1", "p1", "p4", "p5"]
    r = users.where("page = 'p4'").first()
    assert (r.cell, r.first, r.age, r.uscity, r.username) == ("(030)-00-1234", "Cy", 40 - 10, "Austin", "03000")
    assert r.timezone.offset == "-6:00" and r.latitude == "30.2"


def test_infer_schema_distributed(spark):
    found = files.infer_json_schema(_docs(spark))
    assert set(found.fieldNames()) >= {"info", "results", "extra"}
    res = found["results"].dataType.elementType
    assert res["dob"].dataType["age"].dataType == T.LongType()
    assert sorted(files.unknown_fields(schemas.USER_DOC, found)) == ["extra", "info.seed"]


def test_merge_schema_keeps_expected_types(spark):
    found = T.StructType([T.StructField("info", T.StringType()), T.StructField("new", T.LongType())])
    merged = files.merge_schemas(schemas.USER_DOC, found)
    assert merged["info"].dataType == schemas.USER_DOC["info"].dataType
    assert merged.fieldNames()[-1] == "new"


def test_json_to_dataframe_worksheet_sample(spark):
    text = """
{
  "a": {
     "b": 1
  }
}
"""
    schema = T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.IntegerType())]))])
    assert files.json_to_dataframe(spark, text, schema).select("a.b").first()[0] == 1
    inferred = files.json_to_dataframe(spark, text)
    assert inferred.select("a.b").first()[0] == 1
    assert inferred.schema["a"].dataType["b"].dataType == T.LongType()


def test_read_json_files_multiline_drop_malformed(spark, tmp_dir):
    for i, d in enumerate(DOCS[:2] + [DOCS[-1]]):
        with open(f"{tmp_dir}/doc{i}.json", "w") as fh:
            fh.write(json.dumps(json.loads(d), indent=2) if not d.endswith("[") else d)
    df = files.read_json_files(spark, tmp_dir, multiline=True, drop_malformed=True)
    assert df.count() == 2
    # One document per line (as sampled stream values are written)
    with open(f"{tmp_dir}/line-0.txt", "w") as fh:
        fh.write(DOCS[0] + "\n" + DOCS[5] + "\n")
    schema = files.json_files_schema(spark, f"{tmp_dir}/line-*.txt")
    assert {"info", "results", "extra"} <= set(schema.fieldNames())


ODD_DOCUMENTS = [
    '{"a b": 1, "OBJECT<x": 2, "d": 1.50, "e": 1e3, "big": 123456789012345678901, "n": null, "o": {}, "l": [], "m": [1, "x"], "t": true}',
    '{"q": [{"z": 1}, {"z": "s", "y": null}], "d": 2, "o": {"k": 1}, "n": [{}]}',
    '[{"v": 1, "w": [1, 2]}, {"v": {"k": 2}, "w": [1.5]}]',
    '{"v": [1], "deep": {"x": {"y": [{"z": 1}]}}}',
    '{"deep": {"x": {"y": [{"z": 2.5, "u": false}]}}, "only": [null], "VOID": {"VARIANT": "VOID"}}',
    '\t [{"v": 9}]', '\t{"t": null}',
    "nope", "[]", "7", '"text"', "", '{"cut": ', '{"t": "yes"}',
]


def test_inference_equals_the_reader_of_files(spark, tmp_dir):
    docs = spark.createDataFrame([(d,) for d in ODD_DOCUMENTS], "value string")
    docs.coalesce(1).write.text(f"{tmp_dir}/lines")
    reader = spark.read.option("mode", "DROPMALFORMED").json(f"{tmp_dir}/lines")
    found = files.infer_json_schema(docs)
    by_name = lambda schema: {f.name: f.dataType for f in schema.fields}
    assert by_name(found) == {n: t for n, t in by_name(reader.schema).items() if n != "_corrupt_record"}
    good, bad = files.read_json_column(docs)
    columns = [f"to_json(struct(`{c}`))" for c in sorted(found.fieldNames())]
    unspaced = lambda df: sorted(tuple(x.replace(" ", "") for x in r) for r in df.selectExpr(*columns).collect())
    assert unspaced(good) == unspaced(reader)
    assert {r[0] for r in bad.collect()} == {"nope", "7", '"text"', '{"cut": '}


def test_documents_without_fields_are_not_corrupt(spark):
    docs = spark.createDataFrame([("{}",), ("[{}, {}]",), ("x",), (None,)], "value string")
    good, bad = files.read_json_column(docs)
    assert files.infer_json_schema(docs) == T.StructType([]) and good.count() == 3 and [r[0] for r in bad.collect()] == ["x"]
    assert files.infer_json_schema(docs.where("false")) == T.StructType([])


def test_schemas_merge_at_every_depth():
    of = lambda text: T.StructType.fromDDL(text)
    old = of("a struct<b: array<struct<c: int>>, m: map<string, struct<x: int>>>, k string")
    new = of("k struct<z: int>, a struct<b: array<struct<c: string, d: struct<e: int>>>, m: map<string, struct<y: int>>, f: int>, g int")
    want = of("a struct<b: array<struct<c: int, d: struct<e: int>>>, m: map<string, struct<x: int, y: int>>, f: int>, k string, g int")
    assert files.merge_schemas(old, new) == want
    assert files.merge_schemas(want, old) == want


def test_schema_store_keeps_versions(spark, tmp_dir):
    from lumenflow.streaming.schema_sampling import SchemaStore

    of = lambda text: T.StructType.fromDDL(text)
    store = SchemaStore(f"{tmp_dir}/schema", of("a int"))
    assert store.current(spark) == of("a int") and store.versions(spark) == {}
    assert store.extend(spark, of("a string, b struct<c: int>")) == (of("a int, b struct<c: int>"), ["b"])
    assert store.extend(spark, of("b struct<c: int>"))[1] == [] and len(store.versions(spark)) == 1
    assert store.extend(spark, of("b struct<d: int>")) == (of("a int, b struct<c: int, d: int>"), ["b.d"])
    assert store.current(spark) == of("a int, b struct<c: int, d: int>") and sorted(store.versions(spark)) == [1, 2]
