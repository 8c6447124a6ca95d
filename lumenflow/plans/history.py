"""History jobs (C4, C9, V3, V4, K1): what is written once stays where it is.

``run_scd`` creates or advances a table of type 1 or 2. The table is a view; its properties
tell where the rows lie, and replacing or reading the view is one step of the catalog:

* **Type 2** appends. A storage table is partitioned by load. A run writes the new versions to a
  folder of its own and then adds the folder as a partition (one step): old loads are never
  read for writing, let alone rewritten, and a job that dies before that step leaves the table as it was.
* **Type 1** replaces buckets. Rows are hashed by their key into a fixed number of buckets, each a
  folder of files that Spark knows to be bucketed, so the merge joins the touched buckets with the increment without
  shuffling them. New files are written for touched buckets only; a new storage table lists them and the old
  folders of all others, and the view is pointed at it (one step). ``vacuum`` removes folders
  that no listed bucket uses any more.

Around the merge: the increment is staged once in the shared folder and removed at the end, so a moving source or a
lost executor can't give it a second face; an empty increment leaves the table untouched; a table of other origin under
the name is adopted first (type 2 drops its equal rows, U1). ``merge_sql`` names a file whose statement
gives the new table from the views ``history`` and ``increment``; that table then replaces the old one as a whole.

Known limits: the first load of type 1 keeps rows that repeat a key, as the reference does, so a bucket can be
uneven until its keys are merged. A type 2 run reads two columns of the history (key and version) for the keys of the increment.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.functions.columns import distinct_rows, key_text
from lumenflow.operators import scd
from lumenflow.operators.late import rows_not_held
from lumenflow.session import discard, folders, staged
from lumenflow.sources.sqltext import run_sql_file

LOAD, BUCKET, KEY = "__load", "__bucket", "__row_key"
STATE = "lumenflow.history"


@dataclass
class HistoryResult:
    table: str
    written: bool
    incoming_rows: int


# ------------------------------------------------------------------- overwrite
def overwrite_from_self(spark: SparkSession, table: str, transform, path: str | None = None) -> DataFrame:
    """Replace ``table`` with ``transform(table)`` (V3).

    Reading and overwriting the same table in one plan is rejected by Spark;
    ``checkpoint()`` writes the current contents to the shared checkpoint
    folder and cuts the lineage, so the overwrite reads the copy.
    """
    current = spark.table(table).checkpoint(eager=True)
    w = transform(current).write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return spark.table(table)


# ---------------------------------------------------------------- the catalog
def state(spark: SparkSession, table: str) -> dict | None:
    """What the view's properties say about a history table; None if there's no such table."""
    if not spark.catalog.tableExists(table):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return json.loads(found[STATE]) if STATE in found else {"kind": 0}


def _point(spark: SparkSession, table: str, storage: str, columns: list[str], now: dict) -> None:
    """The one step that makes a run's result visible."""
    names = ", ".join(f"`{c}`" for c in columns)
    text = json.dumps(now).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{STATE}' = '{text}') AS SELECT {names} FROM {storage}")


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _add(spark: SparkSession, storage: str, partitions: list[tuple[str, str]], step: int = 200) -> None:
    """Partitions (spec, folder) of a storage table, by statements of a bounded length."""
    for i in range(0, len(partitions), step):
        listed = " ".join(f"PARTITION ({spec}) LOCATION '{path}'" for spec, path in partitions[i : i + step])
        spark.sql(f"ALTER TABLE {storage} ADD IF NOT EXISTS {listed}")


def _root(spark: SparkSession, table: str, location_root: str | None) -> str:
    base = location_root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{table.replace('.', '_').replace('`', '')}"


# ------------------------------------------------------------ type 2: append
def _write_load(spark: SparkSession, rows: DataFrame, table: str, root: str, storage: str | None) -> None:
    """``rows`` as one more load, or as the first of a new storage table (``storage`` None)."""
    load = uuid.uuid4().hex[:12]
    path = f"{root}/load={load}"
    rows.write.parquet(path)
    if storage:
        _add(spark, storage, [(f"`{LOAD}` = '{load}'", path)])
        spark.catalog.refreshTable(table)
        return
    storage = f"{table}__rows_{load}"
    spark.sql(f"CREATE TABLE {storage} ({_columns(rows)}, `{LOAD}` STRING) USING parquet PARTITIONED BY (`{LOAD}`) LOCATION '{root}/empty'")
    _add(spark, storage, [(f"`{LOAD}` = '{load}'", path)])
    _point(spark, table, storage, rows.columns, {"kind": 2, "storage": storage, "root": root})


# ------------------------------------------------------------ type 1: buckets
def _bucket_of(buckets: int):
    """Spark's own bucket number of the key text, so that folder and bucket agree."""
    return F.pmod(F.hash(KEY), F.lit(buckets)).cast("int")


def _write_buckets(spark: SparkSession, rows: DataFrame, table: str, root: str, buckets: int, kept: dict[int, str], old: dict | None) -> None:
    """``rows`` (of some buckets) as new folders; a new storage table of these and the ``kept`` ones."""
    mark = uuid.uuid4().hex[:12]
    path, writing, storage = f"{root}/w={mark}", f"{table}__w_{mark}", f"{table}__buckets_{mark}"
    made = rows.withColumn(KEY, key_text(old["keys"])) if KEY not in rows.columns else rows
    made = made.withColumn(BUCKET, _bucket_of(buckets))
    made.write.format("parquet").partitionBy(BUCKET).bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(writing)
    spark.sql(f"DROP TABLE {writing}")  # the files stay; they are listed below
    new = {int(p.rsplit("=", 1)[1]): p for p in folders(spark, path) if f"{BUCKET}=" in p}
    lies = {**kept, **new}
    plain = [c for c in made.columns if c not in (KEY, BUCKET)]
    spark.sql(
        f"CREATE TABLE {storage} ({_columns(made.select(*plain, KEY, BUCKET))}) USING parquet PARTITIONED BY (`{BUCKET}`) "
        f"CLUSTERED BY (`{KEY}`) SORTED BY (`{KEY}`) INTO {buckets} BUCKETS LOCATION '{root}/empty'"
    )
    _add(spark, storage, [(f"`{BUCKET}` = {b}", p) for b, p in sorted(lies.items())])
    manifest = f"{root}/manifest={mark}"
    spark.createDataFrame(sorted(lies.items()), "bucket int, path string").coalesce(1).write.json(manifest)
    now = {"kind": 1, "storage": storage, "root": root, "buckets": buckets, "manifest": manifest, "keys": old["keys"], "before": old.get("storage")}
    _point(spark, table, storage, plain, now)
    if old.get("before"):  # readers of the last version may still be planning; the one before it goes
        spark.sql(f"DROP TABLE IF EXISTS {old['before']}")


def _manifest(spark: SparkSession, now: dict) -> dict[int, str]:
    return {r["bucket"]: r["path"] for r in spark.read.schema("bucket int, path string").json(now["manifest"]).collect()}


def _merge_buckets(spark: SparkSession, table: str, now: dict, incoming: DataFrame, keys: list[str], change_key: str, tiebreak: list[str] | None) -> None:
    buckets = now["buckets"]
    storage = spark.table(now["storage"])
    plain = [c for c in storage.columns if c not in (KEY, BUCKET)]
    marked = incoming.select(*plain).withColumn(KEY, key_text(keys))
    touched = [r[0] for r in marked.select(_bucket_of(buckets).alias("b")).distinct().collect()]  # at most one per bucket
    newest = scd.latest_per_key(marked, [KEY], change_key, tiebreak).repartition(buckets, KEY)
    current = storage.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = current.join(newest.select(KEY), KEY, "left_anti").unionByName(newest)
    lies = _manifest(spark, now)
    _write_buckets(spark, merged, table, now["root"], buckets, {b: p for b, p in lies.items() if b not in set(touched)}, now)


def _not_older(current: DataFrame, incoming: DataFrame, keys: list[str], change_key: str, tiebreak: list[str] | None) -> DataFrame:
    """The newest incoming row of each key, unless the table's row for the key comes after it."""
    touched = current.select("*", key_text(keys).alias(KEY)).join(incoming.select(key_text(keys).alias(KEY)).distinct(), KEY, "left_semi")
    both = touched.drop(KEY).withColumn("__new", F.lit(False)).unionByName(incoming.withColumn("__new", F.lit(True)))
    order = tiebreak if tiebreak is not None else [c for c in incoming.columns if c != change_key]
    return scd.latest_per_key(both, keys, change_key, [*order, "__new"]).where("__new").drop("__new")


def vacuum(spark: SparkSession, table: str) -> list[str]:
    """Remove the bucket folders of a type 1 table that its present version doesn't use; returns them.

    Run it when no reader or job of an older version is left.
    """
    now = state(spark, table)
    if not now or now["kind"] != 1:
        return []
    used = set(_manifest(spark, now).values())
    gone = [f for w in folders(spark, now["root"]) if "/w=" in w for f in folders(spark, w) if f not in used]
    gone += [m for m in folders(spark, now["root"]) if "/manifest=" in m and m.rsplit("=", 1)[1] != now["manifest"].rsplit("=", 1)[1]]
    for path in gone:
        discard(spark, path)
    return gone


# --------------------------------------------------------------------- the job
def _replace(spark: SparkSession, kind: int, table: str, rows: DataFrame, root: str, keys: list[str], buckets: int | None, old: dict | None = None) -> None:
    """``rows`` as the whole table."""
    if kind == 2:
        _write_load(spark, rows, table, root, None)
        return
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rebalanced, not repartitioned: a key that repeats in the first load is spread over tasks
    dealt = rows.withColumn(KEY, key_text(keys)).hint("rebalance", KEY)
    _write_buckets(spark, dealt, table, root, buckets, {}, {"keys": keys, **({"before": old["storage"]} if old else {})})


def _adopt(spark: SparkSession, kind: int, table: str, root: str, keys: list[str], buckets: int | None) -> None:
    """A plain table under the name becomes the first load; it stays as ``<table>__before``."""
    before = f"{table}__before"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    rows = spark.table(before)
    _replace(spark, kind, table, distinct_rows(rows, rows.count()) if kind == 2 else rows, root, keys, buckets)


def run_scd(
    spark: SparkSession,
    kind: int,
    table: str,
    source: DataFrame,
    keys: list[str],
    change_key: str,
    tiebreak: list[str] | None = None,
    strategy: str = "auto",
    location_root: str | None = None,
    buckets: int | None = None,
    merge_sql: str | None = None,
    lookback: str | int | None = None,
    row_key: list[str] | None = None,
) -> HistoryResult:
    """C4: create or advance a history table of ``kind`` 1 or 2 from ``source``.

    The increment begins behind the newest change in the table (strict mark). With ``lookback`` (an interval such as
    ``"INTERVAL 2 DAYS"``, or a number) it begins that far before it, and rows that the table holds already, told apart by ``row_key``
    (default: all columns), are left out: late rows and ties at the mark are loaded exactly once. In a type 2 history they get the next
    versions of their key; in type 1 a row that is older than the table's row for its key changes nothing.

    Files go below ``location_root`` (default: the warehouse). ``buckets`` (type 1, fixed by the first
    run) defaults to the session's shuffle partitions, which a deployment sizes for its data.
    """
    if kind not in (1, 2):
        raise ValueError("SCD kind must be 1 or 2")
    root = _root(spark, table, location_root)
    now = state(spark, table)
    if now and now["kind"] not in (0, kind):
        raise ValueError(f"{table} is a history of type {now['kind']}")
    if (now and now["kind"] == 0) or (now is None and spark.catalog.tableExists(f"{table}__before")):
        _adopt(spark, kind, table, root, keys, buckets)
        now = state(spark, table)
    if now is None:
        _replace(spark, kind, table, scd.apply_scd(kind, None, source, keys, change_key, tiebreak, strategy), root, keys, buckets)
        return HistoryResult(table, True, -1)

    current = spark.table(table)
    # The mark is fetched as one scalar and applied as a literal, so the
    # filter is pushed into the source: JDBC query text or parquet row-group
    # statistics (a scalar-subquery filter would be applied after a full read).
    mark = scd.high_water_mark(current, change_key)
    incoming, path = staged(scd.incremental_rows(source, change_key, mark, lookback=lookback), "increment")
    paths = [path]
    try:
        if lookback is not None:
            held = scd.incremental_rows(current, change_key, mark, lookback=lookback)
            incoming, path = staged(rows_not_held(incoming, held, row_key), "increment")
            paths.append(path)
        n = incoming.count()
        if n == 0:
            return HistoryResult(table, False, 0)
        if merge_sql:
            merged = run_sql_file(spark, merge_sql, {"history": current, "increment": incoming})
            _replace(spark, kind, table, merged.select(*current.columns), now["root"], keys, now.get("buckets"), now)
        elif kind == 1:
            if lookback is not None:
                incoming, path = staged(_not_older(current, incoming, keys, change_key, tiebreak), "increment")
                paths.append(path)
            if incoming.isEmpty():
                return HistoryResult(table, False, n)
            _merge_buckets(spark, table, now, incoming, keys, change_key, tiebreak)
        else:
            rows = scd.scd2_new_versions(current, incoming, keys, change_key, tiebreak, strategy)
            _write_load(spark, rows, table, now["root"], now["storage"])
        return HistoryResult(table, True, n)
    finally:
        for path in paths:
            discard(spark, path)
