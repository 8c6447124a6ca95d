"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement recomputes, straight from the warehouse tables, what the
Spark query derives and processes. The shared CTEs mirror
``lumenflow.sources.derived`` one to one.

Dialect notes: ``||`` (null if any side is null, like Spark's ``concat``),
``substr`` from 1, explicit ``NULLS FIRST`` (Spark's ascending default).
"""

from __future__ import annotations

# user number -> document fields (mirror of derived._user_sql)
_USER_FIELDS = """
    '(' || substr(lpad(CAST(u AS VARCHAR), 12, '0'), 1, 3) || ')-' || substr(lpad(CAST(u AS VARCHAR), 12, '0'), 4, 9) || '-0000' AS cell,
    'First' || CAST(u AS VARCHAR) AS first,
    CAST(18 + u % 60 AS BIGINT) AS age,
    'user' || CAST(u AS VARCHAR) || '@example.com' AS email,
    'City' || CAST(u % 40 AS VARCHAR) AS uscity,
    CAST(30 + u % 17 AS VARCHAR) || '.5' AS latitude,
    '-' || CAST(70 + u % 23 AS VARCHAR) || '.25' AS longitude,
    'US' AS country,
    'State' || CAST(u % 10 AS VARCHAR) AS state,
    lpad(CAST(u AS VARCHAR), 12, '0') AS username"""

# flattened users: click -> user, purchase -> user and referred user 10^11 + user
USD = f"""usd AS (
  SELECT page, {_USER_FIELDS}
  FROM (
    SELECT event_type AS page, user_id AS u FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL
    SELECT event_type AS page, 100000000000 + user_id AS u FROM events WHERE event_type = 'purchase'
  ) r
)"""

CP = """cp AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS id,
         CAST(20 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS profession
  FROM customer
)"""

# one log line per order (before quarantine), as 17 fields
_LOG_ALL = """log_fields AS (
  SELECT
    lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS username,
    '10.0.' || CAST(o_custkey % 256 AS VARCHAR) || '.' || CAST(o_orderkey % 256 AS VARCHAR) AS ip,
    strftime(o_orderdate, '%d') AS day,
    strftime(o_orderdate, '%b') AS month,
    strftime(o_orderdate, '%m') AS time1,
    strftime(o_orderdate, '%Y') AS yr,
    lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS hr,
    lpad(CAST((o_orderkey * 7) % 60 AS VARCHAR), 2, '0') AS mt,
    lpad(CAST((o_orderkey * 13) % 60 AS VARCHAR), 2, '0') AS sec,
    '-0500' AS tz,
    CASE o_orderstatus WHEN 'F' THEN 'GET' WHEN 'O' THEN 'POST' ELSE 'PUT' END AS verb,
    '/p/' || substr(o_orderpriority, 1, 1) AS page,
    '0' AS "index",
    '/p/' || substr(o_orderpriority, 1, 1) AS fullpage,
    'agent-' || o_orderstatus AS referrer,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '100' WHEN '2' THEN '200' WHEN '3' THEN '302'
         WHEN '4' THEN '404' ELSE 'n/a' END AS statuscd,
    o_orderstatus
  FROM orders
),
log_all AS (
  SELECT *, day || '/' || month || '/' || yr || ':' || hr || ':' || mt || ':' || sec || ' -0500' AS dt
  FROM log_fields
)"""

WL = _LOG_ALL + """,
wl AS (
  SELECT username, ip, dt, day, month, time1, yr, hr, mt, sec, tz, verb, page, "index", fullpage,
         referrer, referrer AS referrer2, statuscd
  FROM log_all WHERE o_orderstatus <> 'P'
)"""

WS = """ws AS (
  SELECT * FROM (VALUES (100, 'Informational', 'Continue'), (200, 'Success', 'OK'),
                        (302, 'Redirection', 'Found')) t(cd, category, "desc")
)"""

_JOINED = """joined AS (
  SELECT usd.page, usd.cell, usd.first, usd.age, usd.email, usd.latitude, usd.longitude,
         usd.uscity, usd.country, usd.state, usd.username,
         cp.age AS profile_age, cp.profession,
         wl.ip, wl.dt, wl.day, wl.month, wl.time1, wl.yr, wl.hr, wl.mt, wl.sec, wl.verb,
         wl.page AS log_page, wl.statuscd, ws.category, ws."desc"
  FROM usd
  LEFT JOIN cp ON substr(replace(replace(replace(usd.cell, '(', ''), ')', ''), '-', ''), 1, 12) = cp.id
  LEFT JOIN wl ON wl.username = substr(replace(replace(replace(usd.cell, '(', ''), ')', ''), '-', ''), 1, 12)
  LEFT JOIN ws ON TRY_CAST(wl.statuscd AS BIGINT) = ws.cd
)"""

ENRICH_CTES = ",\n".join([USD, CP, WL, WS, _JOINED])

_TIE = ", ".join(
    f"{c} NULLS FIRST"
    for c in [
        "page", "cell", "first", "age", "email", "coordinates", "uscity", "country", "state",
        "profile_age", "profession", "ip", "dt", "verb", "log_page", "statuscd", "category", '"desc"',
    ]
)

ENRICH_CUSTOMERS = f"""
WITH {ENRICH_CTES},
shaped AS (
  SELECT username || day || month || yr || hr || mt || sec AS custid,
         page, cell, first, age, email, latitude || longitude AS coordinates, uscity, country,
         state, username, profile_age, profession, ip, dt, yr || '-' || time1 || '-' || day AS fulldt,
         verb, log_page, statuscd, category, "desc",
         CASE WHEN dt IS NULL THEN 'new customer' ELSE 'existing customer' END AS custtype,
         yr, month, day, hr, mt, sec
  FROM joined
)
SELECT custid,
       CAST(row_number() OVER (PARTITION BY username ORDER BY yr NULLS FIRST, month NULLS FIRST,
            day NULLS FIRST, hr NULLS FIRST, mt NULLS FIRST, sec NULLS FIRST, {_TIE}) AS INTEGER) AS version,
       page, cell, first, age, email, coordinates, uscity, country, state, username, profile_age,
       profession, ip, dt, fulldt, verb, log_page, statuscd, category, "desc", custtype
FROM shaped
"""

ENRICH_COUNTS = f"""
WITH {ENRICH_CTES}
SELECT username || day || month || yr || hr || mt || sec AS custid,
       page, cell, first, age, email, latitude || longitude AS coordinates, uscity, country, state,
       username AS wbuser, profile_age, profession, ip, dt, yr || '-' || time1 || '-' || day AS fulldt,
       verb, log_page, statuscd, category, "desc",
       CASE WHEN dt IS NULL THEN 'new customer' ELSE 'existing customer' END AS custtype,
       CAST(count(*) AS BIGINT) AS cnt
FROM joined
GROUP BY ALL
"""


ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

LATEST_PER_CUSTOMER = f"""
SELECT {ORDERS_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
) t WHERE rn = 1
"""

VERSIONED_ORDERS = f"""
SELECT {ORDERS_COLS},
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS version
FROM orders
"""

HISTORY = {
    "scd1_initial": f"SELECT {ORDERS_COLS} FROM orders",
    "scd1_increment": LATEST_PER_CUSTOMER,
    "scd2_initial": VERSIONED_ORDERS,
    "scd2_increment": VERSIONED_ORDERS,
    "scd2_late_rows": """
WITH dealt AS (
  SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 2
                 WHEN o_orderkey % 10 = 3 AND o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 30 DAYS THEN 1 ELSE 0 END AS load
  FROM orders
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY load, o_orderdate, o_orderkey) AS INTEGER) AS version
FROM dealt
""",
    "scd2_increment_maps": VERSIONED_ORDERS,
    "scd2_increment_skew_safe": VERSIONED_ORDERS,
    "scd2_merge_sql_job": VERSIONED_ORDERS,
    "scd_noop": LATEST_PER_CUSTOMER,
    "incremental_extract": f"""
SELECT {ORDERS_COLS} FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
""",
    "scd2_job": VERSIONED_ORDERS,
    "scd1_job": f"""
WITH hist AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
inc AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM hist)),
newest AS (
  SELECT {ORDERS_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM inc
  ) t WHERE rn = 1
)
SELECT * FROM hist WHERE o_custkey NOT IN (SELECT o_custkey FROM inc)
UNION ALL
SELECT * FROM newest
""",
    "hwm_empty_default": """
SELECT 'empty' AS source, coalesce(CAST(max(o_orderdate) AS VARCHAR), '0001-01-01 00:00:00') AS hwm
FROM orders WHERE false
UNION ALL
SELECT 'history' AS source, coalesce(CAST(max(o_orderdate) AS VARCHAR), '0001-01-01 00:00:00') AS hwm
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
""",
}


USERS_FLAT = f"""
WITH {USD}
SELECT page, cell, first, age, email, uscity, latitude, longitude, country, state,
       '-05:00' AS tz_offset, 'Eastern' AS tz_description, username
FROM usd
"""

WEBLOG_COLS = ('username, ip, dt, day, month, time1, yr, hr, mt, sec, tz, verb, page, "index", '
               'fullpage, referrer, referrer2, statuscd')

IO = {
    "xml_rows": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
""",
    "weblog_text": f"WITH {WL} SELECT {WEBLOG_COLS} FROM wl",
    "weblog_quarantine": f"""
WITH {_LOG_ALL}
SELECT concat_ws(',', username, ip, dt, day, month, time1, yr, hr, mt, sec, tz, verb, page, "index",
                 fullpage, referrer) AS _line,
       'expected 17 fields, found 16' AS _error
FROM log_all WHERE o_orderstatus = 'P'
""",
    "csv_to_table": """
SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2,
       CAST(c_acctbal AS VARCHAR) AS _c3, c_mktsegment AS _c4
FROM customer
""",
    "json_infer": USERS_FLAT,
    "json_corrupt": """
WITH u AS (SELECT user_id AS n, lpad(CAST(user_id AS VARCHAR), 12, '0') AS k FROM events WHERE event_type = 'error')
SELECT '{"info":{"page":"error"},"results":[{"cell":"(' || substr(k, 1, 3) || ')-' || substr(k, 4, 9) || '-0000","email":"user' || n
       || '@example.com","name":{"first":"First' || n || '"},"dob":{"age":' || (18 + n % 60) || '},"login":{"username":"' || k
       || '"},"location":{"city":"City' || (n % 40) || '","state":"State' || (n % 10)
       || '","country":"US","timezone":{"offset":"-05:00","description":"Eastern"},"coordinates":{"latitude":"' || (30 + n % 17)
       || '.5","longitude":"-' || (70 + n % 23) || '.25"}}}' AS _corrupt_record
FROM u
""",
    "json_mixed_documents": """
SELECT event_id AS id,
       CASE event_type WHEN 'click' THEN CAST(event_id % 10 AS VARCHAR) WHEN 'purchase' THEN 's' || (event_id % 7)
                       WHEN 'view' THEN '{"k":' || (event_id % 3) || '}' END AS v,
       CASE event_type WHEN 'click' THEN CAST(event_id AS DOUBLE) WHEN 'signup' THEN 1.5 END AS n,
       CAST(NULL AS VARCHAR) AS m, CASE event_type WHEN 'view' THEN 0 END AS n_tags,
       CAST(NULL AS VARCHAR) AS "none", CAST(NULL AS VARCHAR) AS corrupt
FROM events WHERE event_type IN ('click', 'purchase', 'view', 'signup')
UNION ALL
SELECT -event_id, 'true', NULL, NULL, NULL, NULL, NULL FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{"id": ' || event_id || ', "v": ' FROM events
WHERE event_type IS NULL OR event_type NOT IN ('click', 'purchase', 'view', 'signup')
""",
    "json_sample_schema": """
SELECT event_type AS page, lpad(CAST(user_id AS VARCHAR), 12, '0') AS username, 'T' || (user_id % 4) AS tier, user_id % 9 AS points
FROM events WHERE event_type <> 'signup'
""",
    "sql_text_job": VERSIONED_ORDERS,
    "text_sink_roundtrip": """
SELECT concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                 CAST(o_orderdate AS VARCHAR), o_orderpriority) AS line
FROM orders
""",
    "checkpoint_overwrite": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment FROM customer
""",
    "jdbc_table": "SELECT * FROM customer",
    "jdbc_query": """
SELECT c_nationkey, CAST(count(*) AS BIGINT) AS n_customers, round(sum(c_acctbal), 2) AS sum_acctbal
FROM customer GROUP BY c_nationkey
""",
    "jdbc_partitioned": "SELECT * FROM customer",
    "jdbc_incremental": HISTORY["incremental_extract"],
}

_CELL_KEY = "substr(replace(replace(replace(cell, '(', ''), ')', ''), '-', ''), 1, 12)"

OPERATORS = {
    "project_users": f"""
WITH {USD} SELECT username || '2024-01-01 00:00:00' AS custid, uscity, country, state, username FROM usd
""",
    "explode_filter": USERS_FLAT,
    "left_join_computed_key": f"""
WITH {USD}, {CP}
SELECT usd.username, usd.cell, {_CELL_KEY} AS cell_key, cp.age AS profile_age, cp.profession
FROM usd LEFT JOIN cp ON {_CELL_KEY} = cp.id
""",
    "left_join_fanout": f"""
WITH {USD}, {WL}
SELECT usd.username, usd.page, wl.ip, wl.dt, wl.statuscd
FROM usd LEFT JOIN wl ON wl.username = {_CELL_KEY}
""",
    "left_join_status": f"""
WITH {WL}, {WS}
SELECT wl.username, wl.dt, wl.statuscd, ws.category, ws."desc"
FROM wl LEFT JOIN ws ON TRY_CAST(wl.statuscd AS BIGINT) = ws.cd
""",
    "row_number_version": f"""
WITH {WL}
SELECT username, dt, yr, month, day, hr, mt, sec,
       CAST(row_number() OVER (PARTITION BY username ORDER BY yr NULLS FIRST, month NULLS FIRST,
            day NULLS FIRST, hr NULLS FIRST, mt NULLS FIRST, sec NULLS FIRST, ip NULLS FIRST,
            dt NULLS FIRST, verb NULLS FIRST, page NULLS FIRST, statuscd NULLS FIRST) AS INTEGER) AS version
FROM wl
""",
    "nested_collection": """
SELECT conv_id, turn,
       CAST(turn AS INTEGER) AS col0, CAST(length(text) AS INTEGER) AS col1,
       CAST(len(string_split(text, ' ')) AS INTEGER) AS col2,
       CASE WHEN role = 'user' THEN text END AS user_text,
       CAST(turn AS INTEGER) AS x,
       role AS foo,
       CAST(len(string_split(text, ' ')) AS DOUBLE) AS val1
FROM conversations
""",
    "array_helpers": """
WITH n AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE [CAST(o_custkey % 5 AS INTEGER), CAST(o_orderkey % 3 AS INTEGER), CAST(o_custkey % 5 AS INTEGER)]
         END AS nums
  FROM orders
), d AS (
  SELECT o_orderkey, nums,
         list_filter(nums, lambda x, i: NOT list_contains(nums[1:i - 1], x)) AS arr_dist
  FROM n
)
SELECT o_orderkey,
       array_to_string(arr_dist, '@') AS joined,
       array_to_string(arr_dist, ',') AS union_text,
       nums[1] AS col0, nums[2] AS col1, nums[3] AS col2
FROM d
""",
    "mask_columns": f"""
WITH {USD}
SELECT username,
       repeat('*', least(length(cell), 4)) || substr(cell, 5) AS cell_masked,
       repeat('*', least(length(email), 5)) || substr(email, 6) AS email_masked
FROM usd
""",
    "clean_columns": f"""
WITH {USD}
SELECT username,
       regexp_replace(first || username, '[0-9]', '', 'g') AS name_letters,
       regexp_replace(cell, '[(),-]', '', 'g') AS cell_digits,
       TIMESTAMP '2024-01-01 00:00:00' AS time_stamp,
       concat_ws(',', first, email, uscity, state, country) AS line
FROM usd
""",
}

_REFRESHED = ENRICH_CTES.replace(
    "cp.age AS profile_age, cp.profession,",
    "cp.age AS profile_age, CASE WHEN usd.page = 'purchase' THEN lower(cp.profession) "
    "ELSE cp.profession END AS profession,",
)
assert _REFRESHED != ENRICH_CTES

STREAMED_INDEX = f"""
WITH {ENRICH_CTES},
shaped AS (
  SELECT username || day || month || yr || hr || mt || sec AS custid,
         page, cell, first, age, email, latitude || longitude AS coordinates, uscity, country,
         state, username, profile_age, profession, ip, dt, yr || '-' || time1 || '-' || day AS fulldt,
         verb, log_page, statuscd, category, "desc",
         CASE WHEN dt IS NULL THEN 'new customer' ELSE 'existing customer' END AS custtype,
         yr, month, day, hr, mt, sec
  FROM joined
),
versioned AS (
  SELECT *,
         CAST(row_number() OVER (PARTITION BY page, username ORDER BY yr NULLS FIRST, month NULLS FIRST,
              day NULLS FIRST, hr NULLS FIRST, mt NULLS FIRST, sec NULLS FIRST, {_TIE}) AS INTEGER) AS version,
         CASE page WHEN 'click' THEN 4 WHEN 'purchase' THEN 5 END AS batch
  FROM shaped
),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY custid ORDER BY batch DESC, version DESC) AS pick
  FROM versioned WHERE custid IS NOT NULL
)
SELECT custid, version, page, cell, first, age, email, coordinates, uscity, country, state, username,
       profile_age, profession, ip, dt, fulldt, verb, log_page, statuscd, category, "desc", custtype
FROM latest WHERE pick = 1
"""

STREAMING = {
    "dimension_refresh": ENRICH_COUNTS.replace(ENRICH_CTES, _REFRESHED),
    "stream_enrich_counts": ENRICH_COUNTS,
    "stream_counts_complete": ENRICH_COUNTS,
    "stream_versions": ENRICH_CUSTOMERS.replace(
        "PARTITION BY username ORDER BY yr", "PARTITION BY username ORDER BY CASE page WHEN 'click' THEN 4 WHEN 'purchase' THEN 5 END, yr"
    ),
    "stream_foreach_batch_enrich": STREAMED_INDEX,
    "stream_dead_letter_replay": STREAMED_INDEX,
}



def statements() -> dict[str, str]:
    return {
        "enrich_customers": ENRICH_CUSTOMERS,
        "enrich_customers_skew_safe": ENRICH_CUSTOMERS,
        "enrich_counts": ENRICH_COUNTS,
        **HISTORY,
        **IO,
        **OPERATORS,
        **STREAMING,
    }
