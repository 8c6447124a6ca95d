"""Reference-shaped inputs derived from the warehouse tables.

The enrichment and history jobs consume user documents (JSON), a web-log
text file, a customer profile, an HTTP-status dimension and an orders
source. The driver's test data has none of these directly, so they are
*derived* with Spark expressions from ``events``, ``customer`` and
``orders``; every derivation is row-local (no grouping), so its cost grows
linearly with the tables and it partitions like its input.

Event type -> document shape (one JSON document per event):

* ``error``    - text that lacks its last two characters (malformed; goes to quarantine)
* ``signup``   - ``info`` without ``page`` (dropped by the page filter)
* ``view``     - ``results`` is an empty array (explode yields nothing)
* ``click``    - one result, the event's user
* ``purchase`` - two results: the user and a referred user numbered
  ``REFERRAL_BASE + user_id`` (above the customer key space, so it has neither a profile nor log lines: a *new customer*)

The web log has one line per order of the whole ``orders`` table; orders
with status ``P`` are written without their status field, i.e. 16 fields
(quarantine).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow import schemas
from lumenflow.functions import columns as C

# Fixed values of the derivation (the SQL oracle repeats them).
KEY_WIDTH = 12  # digits of a user number; two numbers share a key only beyond them
REFERRAL_BASE = 100_000_000_000  # referred user number = REFERRAL_BASE + user_id, above all customers
LOG_TZ = "-0500"
HISTORY_CUTOFF = "2000-01-01"
STATUS_ROWS = [
    (100, "Informational", "Continue"),
    (200, "Success", "OK"),
    (302, "Redirection", "Found"),
]
PRIORITY_STATUS = {"1": "100", "2": "200", "3": "302", "4": "404"}  # else "n/a"
ORDER_STATUS_VERB = {"F": "GET", "O": "POST"}  # else "PUT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_key(c: Column) -> Column:
    return F.lpad(c.cast("string"), KEY_WIDTH, "0")


def _user_sql(u: str, more: str = "") -> str:
    """SQL text of a ``results[]`` element for user number expression ``u``
    (one expression string: a single round trip to build, however wide).
    ``more``: further fields, as pairs of name and expression."""
    u = f"({u})"
    k = f"lpad(CAST({u} AS STRING), {KEY_WIDTH}, '0')"
    return f"""named_struct(
      'cell', concat('(', substring({k}, 1, 3), ')-', substring({k}, 4, {KEY_WIDTH - 3}), '-0000'),
      'email', concat('user', CAST({u} AS STRING), '@example.com'),
      'name', named_struct('first', concat('First', CAST({u} AS STRING))),
      'dob', named_struct('age', CAST(18 + {u} % 60 AS BIGINT)),
      'login', named_struct('username', {k}),
      'location', named_struct(
        'city', concat('City', CAST({u} % 40 AS STRING)),
        'state', concat('State', CAST({u} % 10 AS STRING)),
        'country', 'US',
        'timezone', named_struct('offset', '-05:00', 'description', 'Eastern'),
        'coordinates', named_struct(
          'latitude', concat(CAST(30 + {u} % 17 AS STRING), '.5'),
          'longitude', concat('-', CAST(70 + {u} % 23 AS STRING), '.25'))){more})"""


def mixed_documents(events: DataFrame) -> DataFrame:
    """``events`` as JSON text of changing shape: single documents, arrays of documents, a field ``v`` that is a
    number, text, flag or object, fields that are always null or missing, and malformed text."""
    return events.selectExpr("""CASE event_type
      WHEN 'click' THEN to_json(named_struct('id', event_id, 'v', event_id % 10, 'extra', named_struct('n', event_id)))
      WHEN 'purchase' THEN concat('[', to_json(named_struct('id', event_id, 'v', concat('s', CAST(event_id % 7 AS STRING)))),
                                  ', {"id": -', CAST(event_id AS STRING), ', "v": true, "extra": null, "none": null}]')
      WHEN 'view' THEN concat('{"id": ', CAST(event_id AS STRING), ', "v": {"k":', CAST(event_id % 3 AS STRING), '}, "tags": []}')
      WHEN 'signup' THEN concat(' {"id": ', CAST(event_id AS STRING), ', "extra": {"n": 1.5, "m": null}, "object": {}}')
      ELSE concat('{"id": ', CAST(event_id AS STRING), ', "v": ') END AS value""")


def documents_from_events(events: DataFrame, keep: list[str] | None = None, ranked: bool = False) -> DataFrame:
    """``events`` -> one JSON text per event in column ``value``; ``ranked`` adds an object ``rank`` to the user,
    which the expected schema doesn't know."""
    results_type = schemas.USER_DOC["results"].dataType.simpleString()
    if ranked:
        more = ", 'rank', named_struct('tier', concat('T', CAST(user_id % 4 AS STRING)), 'points', user_id % 9)"
        doc = f"""to_json(named_struct(
          'info', named_struct('page', CASE WHEN event_type <> 'signup' THEN event_type END),
          'results', array({_user_sql('user_id', more)})))"""
        return events.select(*(keep or []), F.expr(doc).alias("value"))
    doc = f"""to_json(named_struct(
      'info', CASE WHEN event_type = 'signup' THEN named_struct('page', CAST(NULL AS STRING))
                   ELSE named_struct('page', event_type) END,
      'results', CASE WHEN event_type = 'view' THEN CAST(array() AS {results_type})
                      WHEN event_type = 'purchase' THEN array({_user_sql('user_id')}, {_user_sql(f'{REFERRAL_BASE} + user_id')})
                      ELSE array({_user_sql('user_id')}) END))"""
    text = F.expr(doc)
    value = F.when(F.col("event_type") == "error", text.substr(F.lit(1), F.length(text) - 2)).otherwise(text)
    carry = [F.col(c) for c in (keep or [])]
    return events.select(*carry, value.alias("value"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as JSON documents, spread over all cores when
    the table arrives in fewer splits (JSON work is CPU heavy)."""
    from lumenflow.session import spread

    return documents_from_events(spread(table(spark, sf_dir, "events")))


def custprof_from_customer(customer: DataFrame) -> DataFrame:
    return customer.select(
        user_key(F.col("c_custkey")).alias("id"),
        (F.lit(20) + F.col("c_custkey") % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("profession"),
    )


def status_dimension(spark: SparkSession) -> DataFrame:
    """The fixed codes as a local relation, whose size the planner knows (so the join broadcasts it)."""
    names = schemas.HTTP_STATUS.fieldNames()
    rows = ", ".join(f"(CAST({code} AS BIGINT), '{category}', '{text}')" for code, category, text in STATUS_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(names)})").to(schemas.HTTP_STATUS)


def _priority_case() -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{v}'" for p, v in PRIORITY_STATUS.items())
    return f"CASE substring(o_orderpriority, 1, 1) {whens} ELSE 'n/a' END"


def _verb_case() -> str:
    whens = " ".join(f"WHEN '{s}' THEN '{v}'" for s, v in ORDER_STATUS_VERB.items())
    return f"CASE o_orderstatus {whens} ELSE 'PUT' END"


def weblog_field_sql() -> list[str]:
    """SQL text of the 17 input fields of a log line for one order."""
    day, mon, num, yr = (f"date_format(o_orderdate, '{p}')" for p in ("dd", "MMM", "MM", "yyyy"))
    hr = "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0')"
    mt = "lpad(CAST((o_orderkey * 7) % 60 AS STRING), 2, '0')"
    sec = "lpad(CAST((o_orderkey * 13) % 60 AS STRING), 2, '0')"
    page = "concat('/p/', substring(o_orderpriority, 1, 1))"
    ip = "concat_ws('.', '10', '0', CAST(o_custkey % 256 AS STRING), CAST(o_orderkey % 256 AS STRING))"
    dt = f"concat({day}, '/', {mon}, '/', {yr}, ':', {hr}, ':', {mt}, ':', {sec}, ' {LOG_TZ}')"
    return [
        f"lpad(CAST(o_custkey AS STRING), {KEY_WIDTH}, '0')", ip, dt, day, mon, num, yr, hr, mt, sec,
        f"'{LOG_TZ}'", _verb_case(), page, "'0'", page, "concat('agent-', o_orderstatus)", _priority_case(),
    ]


def weblog_lines(orders: DataFrame) -> DataFrame:
    """Text lines (column ``value``) of the log: one per order."""
    names = [f"f{i}" for i in range(17)]
    staged = C.evaluate_once(orders, ["o_orderstatus"], **{n: F.expr(e) for n, e in zip(names, weblog_field_sql())})
    full, short = ", ".join(names), ", ".join(names[:-1])
    return staged.selectExpr(
        f"CASE WHEN o_orderstatus = 'P' THEN concat_ws(',', {short}) ELSE concat_ws(',', {full}) END AS value"
    )
