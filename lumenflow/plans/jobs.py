"""Job shells for the reference's programs, bound to real sources and sinks.

* :func:`enrichment_stream_job` - documents from a stream (Kafka or a file
  folder) enriched per micro-batch and upserted into a keyed sink; the
  profile comes from JDBC and is refreshed on a timer.
* :func:`enrichment_counts_job` - the continuous counts.
* :func:`user_projection_job` - the minimal user projection to a keyed sink.
* :func:`scd_job` - SCD type 1/2 from a JDBC table into a catalog table.
* :func:`ingest_csv` - headerless CSV into a catalog table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumenflow.operators import enrich as E
from lumenflow.plans.history import HistoryResult, run_scd
from lumenflow.sinks import tables
from lumenflow.sinks.keyed import KeyedUpsertSink
from lumenflow.sources import files, jdbc
from lumenflow.streaming import enrich_stream, runner
from lumenflow.streaming.dimensions import DimensionHolder
from lumenflow.streaming.schema_sampling import SchemaStore


class StaticDimensions:
    """Profile (JDBC, refreshed every ``refresh_seconds``), web log (text
    file, bad lines to ``log_quarantine``) and HTTP status (XML)."""

    def __init__(self, spark: SparkSession, profile: jdbc.JdbcSource, profile_table: str, weblog_path: str,
                 status_xml_path: str, status_row_tag: str = "httpstatus", refresh_seconds: float = 60.0,
                 log_quarantine: str | None = None):
        weblog, bad = files.read_weblog(spark, weblog_path)
        if log_quarantine:
            bad.write.mode("overwrite").parquet(log_quarantine)
        self.profile = DimensionHolder(lambda: jdbc.read_table(spark, profile, profile_table), refresh_seconds)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.weblog = DimensionHolder(lambda: weblog, float("inf"), bucket_by=(buckets, ["username"]))
        self.status = files.read_xml(spark, status_xml_path, status_row_tag)

    def __call__(self):
        return self.profile.current(), self.weblog.current(), self.status

    def close(self) -> None:
        self.profile.close()
        self.weblog.close()


def enrichment_stream_job(values: DataFrame, dims: StaticDimensions, sink_root: str, checkpoint: str,
                          trigger: dict | None = None, quarantine_path: str | None = None,
                          on_error: str = "raise", errors: list | None = None,
                          dead_letter_root: str | None = None, counter_root: str | None = None) -> StreamingQuery:
    """C1 continuously: every micro-batch is parsed, enriched and upserted by
    ``custid`` (default trigger: every 30 seconds). ``counter_root``: versions go on over batches;
    ``dead_letter_root`` (with ``on_error='dead_letter'``): where failed batches wait for a replay."""
    sink = KeyedUpsertSink(sink_root, key="custid", order=["version"])
    return enrich_stream.start_enrich_to_index(
        values, dims, sink, checkpoint, trigger or {"processingTime": "30 seconds"},
        quarantine_path=quarantine_path, on_error=on_error, errors=errors,
        counters=enrich_stream.version_counters(counter_root) if counter_root else None,
        dead_letters=runner.DeadLetters(dead_letter_root) if dead_letter_root else None,
    )


def enrichment_counts_job(values: DataFrame, dims: StaticDimensions, out_path: str, checkpoint: str,
                          trigger: dict | None = None) -> StreamingQuery:
    """C2 continuously: the groups that a trigger changed are merged into the counts (``enrich_stream.read_counts``)."""
    return enrich_stream.start_enrich_counts(values, dims, out_path, checkpoint, trigger)


def user_projection_job(values: DataFrame, sink_root: str, checkpoint: str, trigger: dict | None = None,
                        store: SchemaStore | None = None, carry: dict[str, str] | None = None) -> StreamingQuery:
    """``custid = username + current time`` with location columns, to a
    keyed sink (last write wins when a user repeats within a batch).

    With a ``store``, every batch's documents extend the stream's schema, and ``carry`` (column -> path below a
    result) adds fields that the expected schema doesn't know; they are null where no batch had them yet."""
    sink = KeyedUpsertSink(sink_root, key="custid", order=["uscity"])

    def run(batch: DataFrame, batch_id: int) -> None:
        schema, known = None, carry or {}
        if store is not None:
            schema, _ = store.extend(batch.sparkSession, files.infer_json_schema(batch))
            element = schema["results"].dataType.elementType
            known = {name: path for name, path in known.items() if files.has_path(element, path)}
        users = enrich_stream.users_from_stream(batch, schema=schema, carry=known)
        for name in (carry or {}).keys() - known.keys():
            users = users.withColumn(name, F.lit(None).cast("string"))
        name, replay = runner.current_run(batch)
        sink.upsert(E.project_users(users, carry=list(carry or {})), batch_id, name, replay)

    return runner.start_foreach_batch(values, runner.guarded(run), checkpoint,
                                      trigger or {"processingTime": "5 seconds"})


def scd_job(spark: SparkSession, kind: int, table: str, source: jdbc.JdbcSource, source_table: str,
            keys: list[str], change_key: str, tiebreak: list[str] | None = None,
            location_root: str | None = None, partitioning: jdbc.Partitioning | None = None,
            split_by: str | None = None, **how) -> HistoryResult:
    """C4 over JDBC: the increment filter (``change_key > mark``) is pushed
    into the database query; ``partitioning`` splits the read, or ``split_by`` names a whole-number column to
    split by, in as many parts as the table's rows need. ``how`` goes to :func:`run_scd`."""
    if partitioning is None and split_by is not None:
        partitioning = jdbc.partitioning_of(spark, source, source_table, split_by)
    src = jdbc.read_table(spark, source, source_table, partitioning)
    return run_scd(spark, kind, table, src, keys, change_key, tiebreak, location_root=location_root, **how)


def ingest_csv(spark: SparkSession, path: str, table: str, location: str | None = None) -> DataFrame:
    """C11: headerless CSV (all strings) -> catalog table -> ``select *``."""
    tables.save_table(files.read_csv_strings(spark, path), table, path=location)
    return tables.read_table(spark, table)

