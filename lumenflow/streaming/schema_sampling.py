"""Schema sampling for JSON streams.

The reference read two messages, wrote them as text, inferred a schema
from the files and froze it. Here the sample size is a parameter, the
inferred schema is merged with the expected one at every depth (expected types win),
fields the expected schema does not know are reported, and every change is kept as
a version of the stream's schema, which the jobs parse with and extend as batches come in.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.sources import files

CORRUPT = "_corrupt_record"


class SchemaStore:
    """Versions of a stream's schema as small files in one folder of the shared store.

    A version is only ever added; the newest holds all fields of those before it. Two writers
    that add at once leave two files of one number; the reader merges them, so neither loses a field.
    """

    def __init__(self, root: str, expected: T.StructType):
        self.root = root.rstrip("/")
        self.expected = expected

    def versions(self, spark: SparkSession) -> dict[int, T.StructType]:
        try:
            rows = spark.read.schema("version int, fields string").json(f"{self.root}/v=*").orderBy("version", "fields").collect()
        except AnalysisException:  # no version yet
            return {}
        found: dict[int, T.StructType] = {}
        for r in rows:
            schema = T.StructType.fromJson(json.loads(r["fields"]))
            found[r["version"]] = files.merge_schemas(found[r["version"]], schema) if r["version"] in found else schema
        return found

    def current(self, spark: SparkSession) -> T.StructType:
        """The newest version; the expected schema before there is one."""
        found = self.versions(spark)
        return found[max(found)] if found else self.expected

    def extend(self, spark: SparkSession, found: T.StructType) -> tuple[T.StructType, list[str]]:
        """(the schema with the fields of ``found``, paths that were new); a new version if there were any."""
        known = self.versions(spark)
        schema = known[max(known)] if known else self.expected
        new = files.unknown_fields(schema, found)
        merged = files.merge_schemas(schema, found)
        if new or not known:
            number = max(known, default=0) + 1
            row = spark.range(1).select(F.lit(number).alias("version"), F.lit(json.dumps(merged.jsonValue())).alias("fields"))
            row.write.json(f"{self.root}/v={number:06d}-{uuid.uuid4().hex[:8]}")
        return merged, new


def sample_schema(
    bounded: DataFrame,
    stage_path: str,
    expected: T.StructType | None = None,
    value_col: str = "value",
    store: SchemaStore | None = None,
) -> tuple[T.StructType, list[str]]:
    """Write the bounded sample as text, infer from the files, merge.

    Returns ``(schema, unknown_field_paths)``; with a ``store`` the schema is its next version.
    """
    spark = bounded.sparkSession
    files.write_text(bounded.select(value_col), stage_path)
    found = files.json_files_schema(spark, f"{stage_path.rstrip('/')}/part-*.txt")
    found = T.StructType([f for f in found.fields if f.name != CORRUPT])
    if store is not None:
        return store.extend(spark, found)
    if expected is None:
        return found, []
    return files.merge_schemas(expected, found), files.unknown_fields(expected, found)
