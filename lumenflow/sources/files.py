"""File sources: XML, web-log text, headerless CSV, JSON documents, text.

Parsing is expressed as DataFrame -> DataFrame functions, so the same code
serves a file read, a Kafka value column and a streaming micro-batch.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow import schemas
from lumenflow.functions import columns as C

ERROR_COLUMN = "_error"


# --------------------------------------------------------------------- XML
def read_xml(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One row per ``<row_tag>`` element.

    Inference costs a full extra pass over the files; pass ``schema`` for
    large inputs (the HTTP-status dimension is tiny, so inference is fine).
    """
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


# ------------------------------------------------------------------ web log
def parse_weblog(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Comma-split lines into the 18 web-log string columns plus ``_error``.

    Like a JVM ``String.split``, trailing empty fields are dropped before
    counting; a line then needs at least 17 fields (extra fields are
    ignored). Short or empty lines are *kept* with a reason in ``_error`` so
    callers can route them to quarantine instead of failing the batch.
    """
    # Each stage is evaluated once per row (see ``evaluate_once``): the
    # line may be an expensive expression, and the field array is used 18x.
    step = C.evaluate_once(lines, [], _line=F.col(value_col))
    trimmed = F.regexp_replace(F.col("_line"), ",+$", "")
    step = C.evaluate_once(step, ["_line"], __parts=F.split(trimmed, ",", -1))
    parts = F.col("__parts")
    blank = F.col("_line").isNull() | (F.trim(F.col("_line")) == "")
    only_empty = (F.size(parts) == 1) & (F.get(parts, 0) == "")
    n_fields = F.when(only_empty, F.lit(0)).otherwise(F.size(parts))
    error = F.when(blank, F.lit("empty line")).when(
        n_fields < schemas.WEBLOG_INPUT_FIELDS,
        F.concat(F.lit("expected 17 fields, found "), n_fields.cast("string")),
    )
    cols = [f"get(__parts, {i}) AS `{name}`" for name, i in zip(schemas.WEBLOG_COLUMNS, schemas.WEBLOG_FIELD_SOURCE)]
    return step.withColumn(ERROR_COLUMN, error).selectExpr(*cols, ERROR_COLUMN, "_line")


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without helper columns, bad rows with line and reason)."""
    good = parsed.where(F.col(ERROR_COLUMN).isNull()).select(*schemas.WEBLOG_COLUMNS)
    bad = parsed.where(F.col(ERROR_COLUMN).isNotNull()).select("_line", ERROR_COLUMN)
    return good, bad


def read_weblog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read the web-log text file(s); returns (good, quarantine)."""
    return split_quarantine(parse_weblog(spark.read.text(path)))


# --------------------------------------------------------------------- CSV
def read_csv_strings(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """S3: headerless CSV, every column a string named ``_c0, _c1, ...``."""
    return spark.read.option("header", str(header).lower()).option("inferSchema", "false").csv(path)


# -------------------------------------------------------------------- JSON
def parse_json_column(
    df: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    keep: list[str] | None = None,
) -> DataFrame:
    """Parse a JSON text column against ``schema``.

    A ``_corrupt_record`` column receives text that is not a JSON object;
    ``keep`` carries extra columns of ``df`` (e.g. a batch id) through.
    """
    full = schemas.with_corrupt_column(schema)
    if not schema.fields:  # from_json finds every text corrupt that has no field to fill
        text = F.col(value_col).cast("string")
        is_object = F.coalesce(F.expr(f"schema_of_variant(try_parse_json(CAST(`{value_col}` AS STRING))) LIKE 'OBJECT%'"), F.lit(False))
        return df.select(*(keep or []), F.when(~is_object, text).alias(schemas.CORRUPT_COLUMN))
    parsed = F.from_json(
        F.col(value_col).cast("string"),
        full,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN},
    )
    # Parsed exactly once per row: a plain select let Catalyst re-run
    # from_json inside every predicate pushed below it.
    keep = keep or []
    return C.evaluate_once(df, keep, __doc=parsed).select(*keep, "__doc.*")


def split_corrupt(parsed: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows whose text went to ``_corrupt_record``, with the columns ``keep``)."""
    c = F.col(schemas.CORRUPT_COLUMN)
    good = parsed.where(c.isNull()).drop(schemas.CORRUPT_COLUMN)
    bad = parsed.where(c.isNotNull()).select(*(keep or []), c)
    return good, bad


def json_documents(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One row per document: a text that is an array gives its elements, any other text itself, blank text and null
    nothing (as ``read.json`` sees files). Elements are spelled anew, without spaces between their parts."""
    text = F.col(value_col).cast("string")
    elements = F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<variant>"))
    listed = F.when(elements.isNotNull(), F.transform(elements, lambda e: F.to_json(e))).otherwise(F.array(text))
    return df.where(text.rlike(r"\S")).select(*(keep or []), F.explode(listed).alias(value_col))


#: A field with which the type of an object without fields is spelled; it is taken out again.
_NO_FIELDS = "__no_fields"


def _reader_type(kind: T.DataType) -> T.DataType | None:
    """A type as ``read.json`` infers it: fractions are doubles, objects without fields don't appear."""
    if isinstance(kind, T.DecimalType):
        return kind if kind.scale == 0 else T.DoubleType()
    if isinstance(kind, T.ArrayType):
        element = _reader_type(kind.elementType)
        return element and T.ArrayType(element)
    if isinstance(kind, T.StructType):
        fields = [(f.name, _reader_type(f.dataType)) for f in kind.fields if f.name != _NO_FIELDS]
        return T.StructType([T.StructField(n, t) for n, t in fields if t]) if any(t for _, t in fields) else None
    return kind


def _from_variant_schema(text: str) -> T.StructType:
    """The type that ``schema_of_variant`` spells, conflicting and unknown types being strings."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)  # names in quotes stay as they are
    for i in range(0, len(parts), 2):
        spelled = parts[i].replace("OBJECT<>", f"STRUCT<{_NO_FIELDS}: STRING>").replace("OBJECT<", "STRUCT<")
        parts[i] = re.sub(r"\b(VARIANT|VOID)\b(?!:)", "STRING", spelled)
    whole = T.DataType.fromDDL(f"whole {''.join(parts)}")
    return _reader_type(whole["whole"].dataType) or T.StructType([])


def infer_json_schema(df: DataFrame, value_col: str = "value") -> T.StructType:
    """Schema of JSON text as ``read.json`` infers it, by a distributed aggregate.

    ``schema_of_variant_agg`` widens types over nested objects and arrays and merges them
    (partial per task, one small merge at the end): no text is collected on
    the driver, only the resulting type string. Arrays of documents count by their elements, a field of
    conflicting types is a string, one that is always null is a string, and text that is no object is left out.
    """
    documents = json_documents(df.where(F.col(value_col).isNotNull()), value_col)
    objects = documents.where(F.col(value_col).rlike(r"^\s*\{"))
    text = objects.select(F.expr(f"schema_of_variant_agg(try_parse_json(`{value_col}`))")).first()[0]
    return _from_variant_schema(text) if text and text.startswith("OBJECT") else T.StructType([])


def read_json_column(df: DataFrame, value_col: str = "value", schema: T.StructType | None = None, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined text) of a column of JSON text; without ``schema`` it is inferred first."""
    found = schema if schema is not None else infer_json_schema(df, value_col)
    return split_corrupt(parse_json_column(json_documents(df, value_col, keep), found, value_col, keep), keep)


def _merged_type(expected: T.DataType, found: T.DataType) -> T.DataType:
    if isinstance(expected, T.StructType) and isinstance(found, T.StructType):
        return merge_schemas(expected, found)
    if isinstance(expected, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_merged_type(expected.elementType, found.elementType), expected.containsNull)
    if isinstance(expected, T.MapType) and isinstance(found, T.MapType):
        return T.MapType(expected.keyType, _merged_type(expected.valueType, found.valueType), expected.valueContainsNull)
    return expected


def merge_schemas(expected: T.StructType, found: T.StructType) -> T.StructType:
    """Expected fields first (their types win), then fields only ``found``; objects are merged at any depth, in arrays and maps too."""
    own = {f.name: f.dataType for f in found.fields}
    fields = [T.StructField(f.name, _merged_type(f.dataType, own.get(f.name, f.dataType)), f.nullable, f.metadata) for f in expected.fields]
    return T.StructType(fields + [f for f in found.fields if f.name not in expected.fieldNames()])


def unknown_fields(expected: T.StructType, found: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths present in ``found`` but not in ``expected`` (drift report)."""
    out: list[str] = []
    exp = {f.name: f.dataType for f in expected.fields}
    for f in found.fields:
        path = prefix + f.name
        if f.name not in exp:
            out.append(path)
            continue
        a, b = exp[f.name], f.dataType
        if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
            a, b = a.elementType, b.elementType
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            out.extend(unknown_fields(a, b, path + "."))
    return out


def has_path(kind: T.DataType, path: str) -> bool:
    """Whether a dotted path of fields exists in a type."""
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def read_json_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = True,
    drop_malformed: bool = True,
) -> DataFrame:
    """JSON files (one document per file when multi-line), S10/S12."""
    reader = spark.read.option("multiLine", str(multiline).lower())
    reader = reader.option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def json_files_schema(spark: SparkSession, path_glob: str) -> T.StructType:
    """Schema inferred from files matched by a glob."""
    return spark.read.json(path_glob).schema


def json_to_dataframe(spark: SparkSession, text: str, schema: T.StructType | None = None) -> DataFrame:
    """One (possibly multi-line) JSON document -> DataFrame.

    A convenience for single small documents typed in by a user; bulk JSON
    goes through :func:`parse_json_column` on a distributed column.
    """
    one = spark.createDataFrame([(text,)], "value string")
    return read_json_column(one, schema=schema)[0]


# -------------------------------------------------------------------- text
def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one string column -> text files."""
    if len(df.columns) != 1:
        raise ValueError("text sink needs exactly one string column")
    df.select(F.col(df.columns[0]).cast("string")).write.mode(mode).text(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
