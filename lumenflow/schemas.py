"""Logical schemas of the engine's inputs (see FIXTURES.md).

Leaf types of the user document are our choice: the documents arrive as
JSON text, so they are parsed against this schema (plus a corrupt-record
column) instead of being re-inferred per batch.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

TIMEZONE = T.StructType(
    [
        T.StructField("offset", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

COORDINATES = T.StructType(
    [
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("timezone", TIMEZONE),
        T.StructField("coordinates", COORDINATES),
    ]
)

USER_RESULT = T.StructType(
    [
        T.StructField("cell", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("name", T.StructType([T.StructField("first", T.StringType())])),
        T.StructField("dob", T.StructType([T.StructField("age", T.LongType())])),
        T.StructField("login", T.StructType([T.StructField("username", T.StringType())])),
        T.StructField("location", LOCATION),
    ]
)

USER_DOC = T.StructType(
    [
        T.StructField("info", T.StructType([T.StructField("page", T.StringType())])),
        T.StructField("results", T.ArrayType(USER_RESULT)),
    ]
)

# The web log: 17 comma separated input fields become 18 string columns;
# input field 15 feeds both referrer columns (fixed layout of the log).
WEBLOG_COLUMNS = [
    "username", "ip", "dt", "day", "month", "time1", "yr", "hr", "mt",
    "sec", "tz", "verb", "page", "index", "fullpage", "referrer",
    "referrer2", "statuscd",
]
WEBLOG_FIELD_SOURCE = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 15, 16]
WEBLOG_INPUT_FIELDS = 17

HTTP_STATUS = T.StructType(
    [
        T.StructField("cd", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("desc", T.StringType()),
    ]
)

CUSTPROF = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("profession", T.StringType()),
    ]
)

NESTED_RECORD = T.StructType(
    [
        T.StructField("an_array", T.ArrayType(T.IntegerType())),
        T.StructField("a_map", T.MapType(T.StringType(), T.StringType())),
        T.StructField("a_struct", T.StructType([T.StructField("x", T.IntegerType())])),
        T.StructField(
            "an_array_of_structs",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("foo", T.StringType()),
                        T.StructField("bar", T.IntegerType()),
                        T.StructField("vals", T.ArrayType(T.DoubleType())),
                    ]
                )
            ),
        ),
    ]
)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """Schema plus the string column that receives unparseable input."""
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
