import pytest
from pyspark.sql import functions as F

from lumenflow import schemas
from lumenflow.operators import enrich as E
from lumenflow.sources import files

from helpers import rows
from fixtures import DOCS, LOG_LINES, PROFILE, STATUS


@pytest.fixture()
def inputs(spark):
    docs = spark.createDataFrame([(d,) for d in DOCS], "value string")
    good, _ = files.split_corrupt(files.parse_json_column(docs, schemas.USER_DOC))
    users = E.flatten_users(good)
    log, _ = files.split_quarantine(files.parse_weblog(spark.createDataFrame([(x,) for x in LOG_LINES], "value string")))
    prof = spark.createDataFrame(PROFILE, schemas.CUSTPROF)
    status = spark.createDataFrame(STATUS, schemas.HTTP_STATUS)
    return users, prof, log, status


def test_enrich_columns_and_labels(inputs):
    out = E.enrich(*inputs)
    assert out.columns == E.ENRICH_COLUMNS
    got = {(r.username, r.page, r.statuscd): r for r in out.collect()}
    # 04715 appears in p1 and p5, fans out over its two log lines
    assert len([k for k in got if k[0] == "04715"]) == 4
    r = got[("04715", "p1", "100")]
    assert r.custid == "0471523Nov2011174105" and r.category == "Informational"
    assert r.profile_age == 33 and r.profession == "engineer" and r.custtype == "existing customer"
    assert r.fulldt == "2011-11-23" and r.log_page == "/start" and r.coordinates == "30.2-97.7"
    # status 404 present, n/a is non-numeric: no match, no failure
    assert got[("04715", "p1", "404")].category == "Client error"
    assert got[("02000", "p1", "n/a")].category is None
    # missing profile and no log line: new customer, null custid
    r = got[("03000", "p4", None)]
    assert r.custtype == "new customer" and r.custid is None and r.profile_age is None


def test_version_counts_per_user(inputs):
    full = E.enrich(*inputs).where(F.col("username") == "04715").collect()
    assert sorted(r.version for r in full) == [1, 2, 3, 4]
    # yr first: both 2011 rows precede both 2012 rows
    assert {r.version for r in full if "2011" in r.dt} == {1, 2}


def _two_lines(spark):
    lines = [
        "04715,1.1.1.1,05/Dec/2011:10:00:00 -0500,05,Dec,12,2011,10,00,00,-0500,GET,/a,0,/a,agent,100",
        "04715,1.1.1.2,05/Feb/2011:10:00:00 -0500,05,Feb,02,2011,10,00,00,-0500,GET,/b,0,/b,agent,100",
    ]
    log, _ = files.split_quarantine(files.parse_weblog(spark.createDataFrame([(x,) for x in lines], "value string")))
    return log


def test_version_order_legacy_text_vs_event_time(spark, inputs):
    users, prof, _, status = inputs
    log = _two_lines(spark)
    one_doc = users.where("page = 'p5'")
    legacy = {r.version: r.dt[3:6] for r in E.enrich(one_doc, prof, log, status).collect()}
    timely = {r.version: r.dt[3:6] for r in E.enrich(one_doc, prof, log, status, legacy_order=False).collect()}
    assert legacy == {1: "Dec", 2: "Feb"}  # trap 4: month names sort as text
    assert timely == {1: "Feb", 2: "Dec"}


def test_range_strategy_equals_window(inputs):
    a = E.enrich(*inputs)
    b = E.enrich(*inputs, version_strategy="range")
    assert rows(a) == rows(b)


def test_counts_pre_aggregated_equals_plain(inputs):
    a = E.enrich_counts(*inputs, pre_aggregate=True, sort=False)
    b = E.enrich_counts(*inputs, pre_aggregate=False, sort=False)
    assert a.columns == E.COUNT_COLUMNS
    assert rows(a) == rows(b)
    total = a.agg(F.sum("cnt")).first()[0]
    assert total == E.enrich(*inputs).count()


def test_integer_profile_id_joins_by_number(spark, inputs):
    users, _, log, status = inputs
    prof_int = spark.createDataFrame([(4715, 33, "engineer")], "id int, age int, profession string")
    out = E.enrich(users, prof_int, log, status).where("username = '04715'")
    assert {r.profession for r in out.collect()} == {"engineer"}


def test_project_users_same_id_within_query(inputs):
    users = inputs[0]
    out = E.project_users(users).where("username = '04715'").select("custid").distinct()
    assert out.count() == 1  # current_timestamp is constant per query (trap 16)


def test_auto_strategy_with_hot_user_matches_window(inputs):
    # 04715 has 4 output rows: with a threshold of 2 it counts as hot -> range path
    a = E.enrich(*inputs, version_strategy="auto", hot_key_rows=2)
    b = E.enrich(*inputs, version_strategy="window")
    assert rows(a) == rows(b)


def _skewed(spark):
    """Users and log lines of which one key holds a third on both sides, copies and null keys among them."""
    docs = [("p", "04715-1", "Ann", i % 3, f"m{i % 20}", "c", "1", "2", "US", "s", None, "u1" if i % 2 else "u2") for i in range(60)]
    docs += [("p", None if i % 4 == 0 else f"{i % 9:05d}", "Bob", i, "m", "c", "1", "2", "US", "s", None, f"v{i % 5}") for i in range(120)]
    users = spark.createDataFrame(docs, "page string, cell string, first string, age long, email string, uscity string, latitude string, longitude string, country string, state string, timezone string, username string")
    line = lambda key, i: f"{key},1.1.1.{i % 7},{i % 28 + 1:02d}/Dec/2011,{i % 28 + 1:02d},Dec,12,2011,10,{i % 4:02d},00,-0500,GET,/a,0,/a,agent,{(100, 404, 999)[i % 3]}"
    text = [line("04715", i) for i in range(50)] + [line(f"{i % 12:05d}", i) for i in range(80)] + [line("04715", 3)] * 5
    log, _ = files.split_quarantine(files.parse_weblog(spark.createDataFrame([(t,) for t in text], "value string")))
    profile = spark.createDataFrame([("04715", 33, "engineer"), ("00001", 4, "cook")], schemas.CUSTPROF)
    return users, profile, log, spark.createDataFrame(STATUS, schemas.HTTP_STATUS)


@pytest.mark.parametrize("kind", ["text", "number"])
def test_hot_keys_joined_in_cells_give_the_same_rows(spark, kind):
    users, profile, log, status = _skewed(spark)
    if kind == "number":  # two texts of one number, one of them hot
        profile = profile.select(F.col("id").cast("int").alias("id"), "age", "profession")
        users = users.union(users.where("cell = '04715-1'").withColumn("cell", F.lit("4715-")).limit(3))
    plain = rows(E.enrich(users, profile, log, status, find_hot=False))
    assert rows(E.enrich(users, profile, log, status, cell_rows=40, hot_key_rows=100)) == plain
    want = rows(E.enrich_counts(users, profile, log, status, find_hot=False))
    for before in (True, False):
        assert rows(E.enrich_counts(users, profile, log, status, cell_rows=20, pre_aggregate=before)) == want


def test_no_task_gets_more_than_a_few_cells(spark, tmp_dir):
    """A user with a third of all documents and lines, a large profile, no broadcast joins but those of the hot keys."""
    users, _, log, status = _skewed(spark)
    users = users.crossJoin(spark.range(10)).drop("id")  # test data: 60 copies of each document
    profile = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("id"), F.lit(1).alias("age"), F.lit("x").alias("profession"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        largest, n = [], None
        for cell_rows in (2_000, 10**9):
            joined = E.enrich(users, profile, log, status, with_version=False, cell_rows=cell_rows)
            counted = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
            largest.append(counted[0])
            assert n in (None, counted[1])
            n = counted[1]
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert n > 35_000 and largest[1] >= 33_000 and largest[0] <= 5 * 2_000


def test_grids_hold_their_bound():
    from lumenflow.operators import skew

    for docs, lines in ((10**9, 1), (1, 10**9), (3 * 10**5, 3 * 10**5), (10**7, 50), (2, 10**7), (10**6, 0)):
        height, width = skew.plan_cells({"k": (docs, lines)}).get("k", (1, 1))
        assert docs / height * max(lines / width, 1) <= 1.01 * skew.CELL_ROWS and lines / width <= skew.CELL_ROWS
        assert width <= max(lines, 1) and height <= docs
    assert skew.plan_cells({"k": (1000, 1000), "none": (0, 10**9)}) == {}


def test_profile_keys_stay_distinct_beyond_five_digits(spark):
    from lumenflow.functions import columns as C
    from lumenflow.sources import derived as D

    ids = [10_000, 100_000, 100_001, 1_000_007]
    customers = spark.createDataFrame([(i, "X") for i in ids], "c_custkey long, c_mktsegment string")
    events = spark.createDataFrame([("purchase", i) for i in ids], "event_type string, user_id long")
    profiles = D.custprof_from_customer(customers)
    assert profiles.select("id").distinct().count() == 4
    cells = D.documents_from_events(events).selectExpr(
        "explode(from_json(value, 'results array<struct<cell: string>>').results.cell) AS cell"
    )
    keyed = cells.select(C.cell_key("cell", D.KEY_WIDTH).alias("id"))
    assert keyed.count() == 8 and keyed.distinct().count() == 8  # a referred user is none of the customers
    assert keyed.join(profiles, "id").count() == 4


@pytest.mark.parametrize("strategy", ["window", "range"])
def test_tasks_grow_with_the_rows_not_their_memory(spark, monkeypatch, strategy):
    """Large sides are joined and numbered by as many tasks as their rows need, few keys or many, null keys among them."""
    from lumenflow import session
    from lumenflow.operators import ranking

    users, profile, log, status = _skewed(spark)
    users = users.withColumn("username", F.when(F.col("age") % 11 > 0, F.concat("username", (F.col("age") % 40).cast("string"))))
    want = rows(E.enrich(users, profile, log, status, find_hot=False))
    for module in (session, ranking, E):
        monkeypatch.setattr(module, "ROWS_PER_TASK", 25, raising=False)
    found = E.enrich(users, profile, log, status, version_strategy=strategy, cell_rows=100)
    assert rows(found) == want
    assert found.rdd.getNumPartitions() >= len(want) // 25  # not the 4 of spark.sql.shuffle.partitions
    assert rows(E.enrich(users, profile, log, status, version_strategy=strategy)) == want  # no grid
    numbered = profile.select(F.col("age").cast("string").alias("id"), "profession").union(profile.selectExpr("'x'", "'y'"))
    for p in (profile.selectExpr("CAST(id AS INT) AS id", "age", "profession"), numbered.selectExpr("id", "1 AS age", "profession")):
        assert rows(E.enrich(users, p, log, status, version_strategy=strategy, cell_rows=100)) == rows(E.enrich(users, p, log, status, find_hot=False))


def test_joined_rows_are_counted_where_the_sketches_cant_tell(spark):
    from lumenflow.operators import skew

    left = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 4, "k string")
    right = spark.createDataFrame([("a",)] * 5 + [("c",)] * 7 + [(None,)], "k string")
    (left, of_left), (right, of_right) = skew.staged_together(spark, (left, "l", {"key": F.col("k")}), (right, "r", {"key": F.col("k")}))
    assert of_left.nulls == {"key": 4} and of_right.nulls == {"key": 1}
    key = F.col("k")
    assert skew.joined_rows(left, key, of_left, right, key, of_right, 10) == 3 * 5 + 2 + 4
    assert skew.joined_rows(left, key, of_left, right, key, of_right, 1000) == 9 * 7
