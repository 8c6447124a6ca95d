"""End-to-end job shells over real file formats and an in-process database."""

import datetime as dt

from pyspark.sql import functions as F

from lumenflow import schemas
from lumenflow.plans import jobs
from lumenflow.sinks.keyed import KeyedUpsertSink
from lumenflow.sources import jdbc
from lumenflow.sources.streams import read_text_stream
from lumenflow.streaming.enrich_stream import read_counts

from fixtures import DOCS, LOG_LINES, PROFILE

STATUS_XML = """<statuses>
  <httpstatus><cd>100</cd><category>Informational</category><desc>Continue</desc></httpstatus>
  <httpstatus><cd>404</cd><category>Client error</category><desc>Not found</desc></httpstatus>
</statuses>"""


def _files(spark, tmp_dir):
    with open(f"{tmp_dir}/http_status.xml", "w") as fh:
        fh.write(STATUS_XML)
    with open(f"{tmp_dir}/WebLog", "w") as fh:
        fh.write("\n".join(LOG_LINES + ["short,line"]) + "\n")
    src = jdbc.derby_memory("lfjobs")
    jdbc.write_table(spark.createDataFrame(PROFILE, schemas.CUSTPROF), src, "CUSTPROF")
    return src


def test_enrichment_stream_job_end_to_end(spark, tmp_dir):
    src = _files(spark, tmp_dir)
    dims = jobs.StaticDimensions(spark, src, "CUSTPROF", f"{tmp_dir}/WebLog", f"{tmp_dir}/http_status.xml",
                                 log_quarantine=f"{tmp_dir}/log_bad")
    folder = f"{tmp_dir}/topic"
    spark.createDataFrame([(d.replace("\n", " "),) for d in DOCS], "value string").write.text(folder)
    try:
        q = jobs.enrichment_stream_job(read_text_stream(spark, folder, None), dims, f"{tmp_dir}/index",
                                       f"{tmp_dir}/ckpt", trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
    finally:
        dims.close()
    index = KeyedUpsertSink(f"{tmp_dir}/index", "custid").read(spark)
    got = {r.custid: r for r in index.collect()}
    r = got["0471523Nov2011174105"]
    assert (r.profession, r.category, r.custtype) == ("engineer", "Informational", "existing customer")
    assert got["0200001Jan2012000000"].category is None  # status n/a: no match, no failure
    assert spark.read.parquet(f"{tmp_dir}/log_bad").count() == 1


def test_user_projection_and_counts_jobs(spark, tmp_dir):
    src = _files(spark, tmp_dir)
    dims = jobs.StaticDimensions(spark, src, "CUSTPROF", f"{tmp_dir}/WebLog", f"{tmp_dir}/http_status.xml")
    folder = f"{tmp_dir}/topic"
    spark.createDataFrame([(d.replace("\n", " "),) for d in DOCS], "value string").write.text(folder)
    try:
        q = jobs.user_projection_job(read_text_stream(spark, folder, None), f"{tmp_dir}/users", f"{tmp_dir}/c1",
                                     trigger={"availableNow": True})
        q.awaitTermination()
        c = jobs.enrichment_counts_job(read_text_stream(spark, folder, None), dims, f"{tmp_dir}/counts",
                                       f"{tmp_dir}/c2", trigger={"availableNow": True})
        c.awaitTermination()
        assert q.exception() is None and c.exception() is None
    finally:
        dims.close()
    users = KeyedUpsertSink(f"{tmp_dir}/users", "custid").read(spark)
    assert {r.username for r in users.collect()} == {"04715", "02000", "03000"}
    counts = read_counts(spark, f"{tmp_dir}/counts")
    # 04715: 2 docs x 2 log lines, 02000: 1 doc x 1 line, 03000: no line (counted once)
    assert counts.agg(F.sum("cnt")).first()[0] == 6


def test_scd_job_over_jdbc(spark, tmp_dir):
    src = jdbc.derby_memory("lfscdjob")
    rows = [(dt.datetime(2020, 1, d), k, f"s{d}") for d, k in ((1, 1), (2, 1), (1, 2))]
    schema = "order_ts timestamp_ntz, orderNumber int, status string"
    jdbc.write_table(spark.createDataFrame(rows, schema), src, "ORDER_SCD2")
    spark.sql("DROP TABLE IF EXISTS scd_order_scd2")
    r1 = jobs.scd_job(spark, 2, "scd_order_scd2", src, "ORDER_SCD2", ["orderNumber"], "order_ts",
                      location_root=f"{tmp_dir}/hist")
    more = spark.createDataFrame([(dt.datetime(2020, 1, 5), 1, "s5")], schema)
    jdbc.write_table(more, src, "ORDER_SCD2", mode="append")
    r2 = jobs.scd_job(spark, 2, "scd_order_scd2", src, "ORDER_SCD2", ["orderNumber"], "order_ts",
                      location_root=f"{tmp_dir}/hist", split_by="orderNumber")
    assert jdbc.partitioning_of(spark, src, "ORDER_SCD2", "orderNumber", rows_per_partition=2).num_partitions == 2
    assert r1.written and r2.incoming_rows == 1
    got = {(r.orderNumber, r.status): r.version for r in spark.table("scd_order_scd2").collect()}
    assert got == {(1, "s1"): 1, (1, "s2"): 2, (2, "s1"): 1, (1, "s5"): 3}


def test_ingest_csv(spark, tmp_dir):
    with open(f"{tmp_dir}/people.csv", "w") as fh:
        fh.write("a,1\nb,2\n")
    out = jobs.ingest_csv(spark, f"{tmp_dir}/people.csv", "people_job", location=f"{tmp_dir}/t")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "1"), ("b", "2")]
