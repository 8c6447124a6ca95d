"""Column-level helpers: all built on JVM-side ``pyspark.sql.functions``.

Nothing here is a Python UDF - every helper returns a ``Column`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.session import sized

__all__ = [
    "as_col",
    "cell_key",
    "full_date",
    "customer_id",
    "customer_type",
    "coordinates",
    "mask_prefix",
    "strip_digits",
    "strip_phone_punctuation",
    "distinct_elements",
    "join_elements",
    "union_elements",
    "element_columns",
    "delimited",
    "timestamped_id",
    "evaluate_once",
    "canonical",
    "distinct_rows",
    "has_map",
    "key_text",
    "NEW_CUSTOMER",
    "EXISTING_CUSTOMER",
    "EMPTY_MARK",
]

# Fixed values that must equal the reference's output.
NEW_CUSTOMER = "new customer"
EXISTING_CUSTOMER = "existing customer"
EMPTY_MARK = "0001-01-01 00:00:00"  # high-water mark of an empty history
PHONE_PUNCTUATION = "[()-]"  # removed from the cell number before keying
KEY_LENGTH = 5  # digits of the cell number that form the profile key


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cell_key(cell: str | Column, length: int = KEY_LENGTH) -> Column:
    """First five digits of a phone number with ``( ) -`` removed.

    The reference wrote ``substr(x, 0, 5)``; Spark treats a 0 start as 1,
    so the explicit form is ``substring(x, 1, 5)``.
    """
    return F.substring(F.regexp_replace(as_col(cell), PHONE_PUNCTUATION, ""), 1, length)


def full_date(yr: str | Column, month_number: str | Column, day: str | Column) -> Column:
    """``yr-month-day`` text; null when any part is null (``concat``)."""
    return F.concat(as_col(yr), F.lit("-"), as_col(month_number), F.lit("-"), as_col(day))


def customer_id(username, day, month, yr, hr, mt, sec) -> Column:
    """Document id: username followed by the log line's time parts."""
    return F.concat(*[as_col(c) for c in (username, day, month, yr, hr, mt, sec)])


def customer_type(log_dt: str | Column) -> Column:
    return F.when(as_col(log_dt).isNull(), F.lit(NEW_CUSTOMER)).otherwise(F.lit(EXISTING_CUSTOMER))


def coordinates(latitude: str | Column, longitude: str | Column) -> Column:
    return F.concat(as_col(latitude), as_col(longitude))


def mask_prefix(c: str | Column, start: int, length: int, mask_char: str = "*") -> Column:
    """Replace ``length`` characters from 0-based ``start`` by ``mask_char``.

    Never lengthens a short value: the masked span is clipped to the text.
    """
    col = as_col(c)
    span = F.greatest(F.least(F.length(col) - F.lit(start), F.lit(length)), F.lit(0))
    head = F.substring(col, 1, start) if start > 0 else F.lit("")
    tail = col.substr(F.lit(start + 1) + span, F.length(col) + F.lit(1))
    return F.concat(head, F.repeat(F.lit(mask_char), span), tail)


def strip_digits(c: str | Column) -> Column:
    return F.regexp_replace(as_col(c), "[0-9]", "")


def strip_phone_punctuation(c: str | Column) -> Column:
    return F.regexp_replace(as_col(c), "[(),-]", "")


def distinct_elements(arr: str | Column) -> Column:
    return F.array_distinct(as_col(arr))


def join_elements(arr: str | Column, sep: str = "@") -> Column:
    return F.array_join(as_col(arr), sep)


def union_elements(a: str | Column, b: str | Column) -> Column:
    return F.array_union(as_col(a), as_col(b))


def element_columns(arr: str | Column, n: int, prefix: str = "col") -> list[Column]:
    """``arr[0..n-1]`` as columns; out-of-range gives null (``get``)."""
    return [F.get(as_col(arr), i).alias(f"{prefix}{i}") for i in range(n)]


def delimited(cols: list[str | Column], sep: str = ",") -> Column:
    """Row -> one delimited string (nulls skipped, like ``concat_ws``)."""
    return F.concat_ws(sep, *[as_col(c).cast("string") for c in cols])


def timestamped_id(username: str | Column, ts: Column | None = None) -> Column:
    """``concat(username, ts)``; ``ts`` defaults to the query's current time."""
    stamp = ts if ts is not None else F.current_timestamp()
    return F.concat(as_col(username), stamp.cast("string"))




def evaluate_once(df: DataFrame, keep: list[str], **named: Column) -> DataFrame:
    """``df.select(*keep, *named)`` where each named expression is computed
    exactly once per row.

    A plain projection may be inlined by the optimizer into every filter
    pushed below it and every later expression that references it, which
    re-runs expensive work (JSON parsing, text rendering, splitting) several
    times per row. Wrapping the values in ``explode(array(struct(...)))``
    emits the same single row, but Catalyst cannot move predicates or
    expressions through the generator.
    """
    packed = F.struct(*[c.alias(n) for n, c in named.items()])
    carry = [F.col(c) for c in keep]
    return df.select(*carry, F.explode(F.array(packed)).alias("__once")).select(*carry, "__once.*")


def has_map(kind: T.DataType) -> bool:
    """Whether a type is or holds a map."""
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and has_map(kind.elementType))


def canonical(c: Column, kind: T.DataType) -> Column:
    """A value that is equal, groupable and sortable where ``c`` is equal: every map as its entries sorted by key."""
    if not has_map(kind):
        return c
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(canonical(e["key"], kind.keyType).alias("key"), canonical(e["value"], kind.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(c), entry))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: canonical(e, kind.elementType))
    whole = F.struct(*[canonical(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
    return F.when(c.isNull(), F.lit(None)).otherwise(whole)


def distinct_rows(df: DataFrame, rows: int = 0) -> DataFrame:
    """``df.distinct()``, also for rows with map columns (equal maps are equal in any order of their entries).

    ``rows``: about how many there are, if known; many are hashed into as many tasks as they need before they are compared.
    """
    maps = [f for f in df.schema.fields if has_map(f.dataType)]
    if not maps:
        return sized(df, rows, *[F.col(f"`{c}`") for c in df.columns]).distinct()
    forms = {f"__form_{i}": canonical(F.col(f"`{f.name}`"), f.dataType) for i, f in enumerate(maps)}
    plain = [c for c in df.columns if c not in {f.name for f in maps}]
    placed = sized(df.withColumns(forms), rows, *[F.col(f"`{c}`") for c in (*plain, *forms)])
    return placed.dropDuplicates([*plain, *forms]).drop(*forms)


def key_text(keys: list[str]) -> Column:
    """The key columns as one text that is never null and differs where a key does: each part with its length, a null as ``-``."""
    part = lambda c: F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.concat(*[part(F.col(k)) for k in keys])
