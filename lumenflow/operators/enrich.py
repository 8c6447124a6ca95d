"""Customer-360 enrichment.

``flatten_users`` turns user documents into one row per result;
``enrich`` left-joins the rows with the customer profile, the web log
and the HTTP-status dimension, numbers versions per user and labels each
row as a new or existing customer; ``enrich_counts`` is the grouped
(counting) form used by the streaming job; ``project_users`` is the
minimal projection sent to the document index.

Plan shape (batch): the status dimension is joined to the log lines before they
fan out (a document without a line has no status either). The documents are shuffled once on
the computed cell key; the profile and the web log are joined on that same key, so both
joins reuse one partitioning, unless Spark broadcasts a side by its bytes. Hot users are found by
sketches while both sides are staged, and joined in a grid of cells (``operators.skew``). The staged rows and the
rows of the result are known before the join, so the number of tasks grows with them (``session.sized``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.functions import columns as C
from lumenflow.operators import skew
from lumenflow.operators.joins import key_equals
from lumenflow.operators.ranking import DEFAULT_HOT_KEY_ROWS, sequence_within_key
from lumenflow.session import ROWS_PER_TASK, sized

USER_COLUMNS = [
    "page", "cell", "first", "age", "email", "uscity", "latitude", "longitude",
    "country", "state", "timezone", "username",
]

# Output of ``enrich`` in order. The reference emitted two ``page`` and two
# ``age`` columns; the dimension copies are renamed ``log_page`` and
# ``profile_age`` so the result can be written.
ENRICH_COLUMNS = [
    "custid", "version", "page", "cell", "first", "age", "email", "coordinates",
    "uscity", "country", "state", "username", "profile_age", "profession", "ip",
    "dt", "fulldt", "verb", "log_page", "statuscd", "category", "desc", "custtype",
]

COUNT_COLUMNS = [c for c in ENRICH_COLUMNS if c not in ("version", "username")]
COUNT_COLUMNS.insert(COUNT_COLUMNS.index("profile_age"), "wbuser")
COUNT_COLUMNS.append("cnt")

LOG_TIME_PARTS = ["yr", "month", "day", "hr", "mt", "sec"]
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def flatten_users(docs: DataFrame, carry: dict[str, str] | None = None) -> DataFrame:
    """Documents with a page -> one row per element of ``results``.

    ``explode`` (not ``explode_outer``): documents whose ``results`` is empty
    or null produce no rows. ``carry``: further columns, name -> path below the element.
    """
    res = F.col("res")
    return (
        docs.where(F.col("info.page").isNotNull())
        .select(F.col("info.page").alias("page"), F.explode("results").alias("res"))
        .select(
            "page",
            res["cell"].alias("cell"),
            res["name"]["first"].alias("first"),
            res["dob"]["age"].alias("age"),
            res["email"].alias("email"),
            res["location"]["city"].alias("uscity"),
            res["location"]["coordinates"]["latitude"].alias("latitude"),
            res["location"]["coordinates"]["longitude"].alias("longitude"),
            res["location"]["country"].alias("country"),
            res["location"]["state"].alias("state"),
            res["location"]["timezone"].alias("timezone"),
            res["login"]["username"].alias("username"),
            *[F.col(f"res.{path}").alias(name) for name, path in (carry or {}).items()],
        )
    )


def _join_dims(users: DataFrame, custprof: DataFrame, weblog: DataFrame, status: DataFrame, key_length: int,
               grid: skew.Grid | None = None, log_extra: tuple[str, ...] = (), side_rows: int = 0) -> DataFrame:
    """``side_rows``: rows of users and log, if known; large sides are hashed into as many tasks as that takes."""
    u = users.withColumn("_key", C.cell_key("cell", key_length))
    cp = custprof.select(
        F.col("id").alias("_cp_id"), F.col("age").alias("profile_age"), F.col("profession")
    )
    wl = weblog.select(
        F.col("username").alias("_wl_user"), "ip", "dt", "day", "month", "time1", "yr",
        "hr", "mt", "sec", "verb", F.col("page").alias("log_page"), "statuscd", *log_extra,
    )
    ws = status.select(F.col("cd").alias("_ws_cd"), "category", "desc")
    key, cp_id, wl_user = F.col("_key"), F.col("_cp_id"), F.col("_wl_user")
    cp_type, ws_type = custprof.schema["id"].dataType, status.schema["cd"].dataType
    wl = wl.join(ws, key_equals(F.col("statuscd"), T.StringType(), F.col("_ws_cd"), ws_type), "left")
    own_profile, own_lines = key_equals(key, T.StringType(), cp_id, cp_type), wl_user == key
    by_text = not isinstance(cp_type, T.NumericType)  # else the profile is joined by a number and the log by its text
    if grid is None:
        if by_text:
            u, cp = sized(u, side_rows, key), sized(cp, side_rows, cp_id)
        j = u.join(cp, own_profile, "left")
        return (j if by_text else sized(j, side_rows, key)).join(sized(wl, side_rows, wl_user), own_lines, "left")
    u = grid.left(u, key)
    cp = grid.every(cp, lambda hot: key_equals(hot, T.StringType(), cp_id, cp_type)).withColumnRenamed(skew.CELL, "_cp_cell")
    wl = grid.right(wl, wl_user).withColumnRenamed(skew.CELL, "_wl_cell")
    cell, cp_cell, wl_cell = F.col(skew.CELL), F.col("_cp_cell"), F.col("_wl_cell")
    if by_text:
        u, cp = sized(u, side_rows, key, cell), sized(cp, side_rows, cp_id, cp_cell)
    j = u.join(cp, own_profile & (cell == cp_cell), "left")
    j = (j if by_text else sized(j, side_rows, key, cell)).join(sized(wl, side_rows, wl_user, wl_cell), own_lines & (cell == wl_cell), "left")
    return j.where(skew.met(wl_user))


def _find_hot(users: DataFrame, weblog: DataFrame, key_length: int, cell_rows: int, **owner: Column):
    """(staged users, staged web log, grid of the hot keys or None, the two sketches)."""
    key = C.cell_key("cell", key_length)
    (users, of_users), (weblog, of_log) = skew.staged_together(
        users.sparkSession, (users, "enrich-users", {"key": key, **owner}), (weblog, "enrich-log", {"key": F.col("username")})
    )
    counts = skew.hot_counts(users, key, of_users, weblog, F.col("username"), of_log, cell_rows)
    cells = skew.plan_cells(counts, cell_rows)
    spread_nulls = of_users.nulls["key"] > cell_rows
    return users, weblog, skew.Grid(users.sparkSession, cells) if cells or spread_nulls else None, of_users, of_log


def _largest_group(of_users: skew.Sketch, of_log: skew.Sketch) -> int:
    """About the most output rows of one username (sketched as ``username NUL key``), by the frequent ones of both sides."""
    most_lines = math.ceil(4 * of_log.rows / skew.TRACKED)
    rows: dict[str, int] = {}
    for owner, docs in of_users.top["owner"].items():
        username, _, key = owner.partition("\0")
        rows[username] = rows.get(username, 0) + docs * max(of_log.count("key", key), most_lines, 1)
    rest = math.ceil(4 * of_users.rows / skew.TRACKED) * max([most_lines, *of_log.top["key"].values()])
    return max([rest, *rows.values()])


def _version_order(legacy_order: bool) -> list[Column]:
    if legacy_order:
        # The reference ordered by the text parts (month names sort
        # alphabetically); kept for parity.
        head = [F.col(c).asc_nulls_first() for c in LOG_TIME_PARTS]
    else:
        head = [F.try_to_timestamp(F.col("dt"), F.lit(LOG_TIME_FORMAT)).asc_nulls_first()]
    # Tie-break on every remaining output column: rows still tied are equal
    # in all columns, so the numbering is deterministic as a multiset.
    tail = [
        F.col(c).asc_nulls_first()
        for c in ENRICH_COLUMNS
        if c not in ("custid", "version", "username", "fulldt", "custtype")
    ]
    return head + tail


def enrich(
    users: DataFrame,
    custprof: DataFrame,
    weblog: DataFrame,
    status: DataFrame,
    legacy_order: bool = True,
    with_version: bool = True,
    version_strategy: str = "auto",
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    key_length: int = C.KEY_LENGTH,
    find_hot: bool = True,
    cell_rows: int = skew.CELL_ROWS,
) -> DataFrame:
    """Flattened users -> enriched rows (``ENRICH_COLUMNS``).

    * profile: ``cell_key(cell) = custprof.id`` (left)
    * web log: ``weblog.username = cell_key(cell)`` (left, fans out one row
      per log line of the user - the output size is docs x lines per user)
    * status: ``weblog.statuscd = status.cd`` (left; text vs number via
      ``try_cast``)
    * ``version``: ``row_number`` per ``username`` ordered by the log time
      (``legacy_order``: the text parts yr, month, day, hr, mt, sec).
    * ``find_hot``: users and log are staged in the shared folder and sketched on the way;
      a key whose join would make more than ``cell_rows`` rows is joined in cells.
      ``version_strategy='auto'`` (default) takes the skew-safe ``range`` numbering
      when, by the sketches, one user gets more than ``hot_key_rows`` rows, else the window.
      Without ``find_hot`` (bounded input such as a micro-batch) ``auto`` is the window.
    """
    grid, side_rows, out_rows = None, 0, None
    if find_hot:
        owner = F.concat(F.col("username"), F.lit("\0"), F.coalesce(C.cell_key("cell", key_length), F.lit("")))
        users, weblog, grid, of_users, of_log = _find_hot(users, weblog, key_length, cell_rows, owner=owner)
        side_rows = of_users.rows + of_log.rows
        if with_version:
            enough = ROWS_PER_TASK * users.sparkSession.sparkContext.defaultParallelism
            out_rows = skew.joined_rows(users, C.cell_key("cell", key_length), of_users, weblog, F.col("username"), of_log, enough)
    if version_strategy == "auto":
        version_strategy = "range" if find_hot and _largest_group(of_users, of_log) > hot_key_rows else "window"
    j = _join_dims(users, custprof, weblog, status, key_length, grid, side_rows=side_rows)
    out = j.select(
        C.customer_id("username", "day", "month", "yr", "hr", "mt", "sec").alias("custid"),
        "page", "cell", "first", "age", "email",
        C.coordinates("latitude", "longitude").alias("coordinates"),
        "uscity", "country", "state", "username", "profile_age", "profession", "ip", "dt",
        C.full_date("yr", "time1", "day").alias("fulldt"),
        "verb", "log_page", "statuscd", "category", "desc",
        C.customer_type("dt").alias("custtype"),
        *LOG_TIME_PARTS,
    )
    if with_version:
        out = sequence_within_key(
            out, ["username"], _version_order(legacy_order), "version", strategy=version_strategy, rows=out_rows,
        )
    else:
        out = out.withColumn("version", F.lit(None).cast("int"))
    return out.select(*ENRICH_COLUMNS)


DOC_GROUP = ["page", "cell", "first", "age", "email", "latitude", "longitude", "uscity", "country", "state", "username"]
LOG_GROUP = ["username", "ip", "dt", "day", "month", "time1", "yr", "hr", "mt", "sec", "verb", "page", "statuscd"]


def user_counts(users: DataFrame) -> DataFrame:
    """Identical user rows as one row with their number ``_n_doc``."""
    return users.groupBy(*DOC_GROUP).agg(F.count(F.lit(1)).alias("_n_doc"))


def log_counts(weblog: DataFrame) -> DataFrame:
    """Identical log lines as one row with their number ``_n_log``."""
    return weblog.groupBy(*LOG_GROUP).agg(F.count(F.lit(1)).alias("_n_log"))


def _count_select() -> list[Column]:
    return [
        C.customer_id("wbuser", "day", "month", "yr", "hr", "mt", "sec").alias("custid"),
        F.col("page"), F.col("cell"), F.col("first"), F.col("age"), F.col("email"),
        C.coordinates("latitude", "longitude").alias("coordinates"),
        F.col("uscity"), F.col("country"), F.col("state"), F.col("wbuser"),
        F.col("profile_age"), F.col("profession"), F.col("ip"), F.col("dt"),
        C.full_date("yr", "time1", "day").alias("fulldt"),
        F.col("verb"), F.col("log_page"), F.col("statuscd"), F.col("category"), F.col("desc"),
        C.customer_type("dt").alias("custtype"),
    ]


def enrich_counts(
    users: DataFrame,
    custprof: DataFrame,
    weblog: DataFrame,
    status: DataFrame,
    sort: bool = True,
    pre_aggregate: bool = True,
    key_length: int = C.KEY_LENGTH,
    find_hot: bool = True,
    cell_rows: int = skew.CELL_ROWS,
) -> DataFrame:
    """Enrichment grouped on its 22 output expressions with ``cnt``.

    ``pre_aggregate`` (batch only) collapses identical user rows and
    identical log lines *before* the joins and multiplies their counts
    afterwards: the joins then see distinct tuples instead of every
    document x every log line, which is what keeps a hot user from
    exploding the shuffle. ``find_hot`` (batch): as for :func:`enrich`, over the
    distinct tuples. Spark cannot aggregate a stream before a join, so a streaming
    ``users`` is joined row by row, with the log collapsed all the same; the state
    store keeps the running counts.
    """
    grid, side_rows = None, 0
    if "_n_doc" not in users.columns:
        counted = pre_aggregate and not users.isStreaming
        users = user_counts(users) if counted else users.withColumn("_n_doc", F.lit(1).cast("long"))
    if "_n_log" not in weblog.columns:
        weblog = log_counts(weblog) if pre_aggregate else weblog.withColumn("_n_log", F.lit(1).cast("long"))
    if find_hot and not users.isStreaming:
        users, weblog, grid, of_users, of_log = _find_hot(users, weblog, key_length, cell_rows)
        side_rows = of_users.rows + of_log.rows
    j = _join_dims(users, custprof, weblog, status, key_length, grid, ("_n_log",), side_rows).withColumnRenamed("username", "wbuser")
    # A user without log lines still counts its own rows once.
    n = F.col("_n_doc") * F.coalesce(F.col("_n_log"), F.lit(1))
    out = j.groupBy(*_count_select()).agg(F.sum(n).alias("cnt")).select(*COUNT_COLUMNS)
    return out.orderBy("custid") if sort else out


def project_users(users: DataFrame, ts: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """``custid = concat(username, ts)`` plus location columns.

    ``ts`` defaults to ``current_timestamp()`` (constant within one query,
    so a user present twice in one batch gets one id: last write wins in a
    keyed sink).
    """
    return users.select(
        C.timestamped_id("username", ts).alias("custid"), "uscity", "country", "state", "username", *(carry or [])
    )
