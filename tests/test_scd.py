import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lumenflow.operators import scd
from lumenflow.plans import history

from helpers import rows

SCHEMA = "order_ts timestamp_ntz, orderNumber int, status string"
H2 = SCHEMA + ", version int"


def t(n):
    return dt.datetime(2020, 1, n)


@pytest.fixture()
def history_df(spark):
    # FIXTURES type-2 example: (t1,1,new,v1) (t2,1,paid,v2) (t1,2,new,v1)
    return spark.createDataFrame([(t(1), 1, "new", 1), (t(2), 1, "paid", 2), (t(1), 2, "new", 1)], H2)


@pytest.fixture()
def increment_df(spark):
    return spark.createDataFrame([(t(3), 1, "ship"), (t(4), 1, "done"), (t(3), 9, "new")], SCHEMA)


def test_scd2_increment_fixture(history_df, increment_df):
    out = scd.scd2_merge(history_df, increment_df, ["orderNumber"], "order_ts")
    got = {(r.orderNumber, r.status): r.version for r in out.collect()}
    assert got == {(1, "new"): 1, (1, "paid"): 2, (2, "new"): 1, (1, "ship"): 3, (1, "done"): 4, (9, "new"): 1}


def test_scd2_range_strategy_same(history_df, increment_df):
    a = scd.scd2_merge(history_df, increment_df, ["orderNumber"], "order_ts")
    b = scd.scd2_merge(history_df, increment_df, ["orderNumber"], "order_ts", strategy="range")
    assert rows(a) == rows(b)


def test_union_removes_duplicate_history_rows(spark, history_df, increment_df):
    dup = history_df.unionByName(history_df.limit(1))
    out = scd.scd2_merge(dup, increment_df, ["orderNumber"], "order_ts")
    assert out.count() == 6  # trap 12: union is distinct
    fast = scd.scd2_merge(history_df, increment_df, ["orderNumber"], "order_ts", history_is_distinct=True)
    assert rows(fast) == rows(out)


def test_high_water_mark_and_strict_filter(spark, history_df):
    assert scd.high_water_mark(history_df, "order_ts") == "2020-01-02 00:00:00"
    empty = history_df.where(F.lit(False))
    assert scd.high_water_mark(empty, "order_ts") == "0001-01-01 00:00:00"
    src = spark.createDataFrame([(t(2), 1, "same"), (t(5), 1, "later")], SCHEMA)
    # trap 8: equal to the mark is not taken
    assert [r.status for r in scd.incremental_rows(src, "order_ts", "2020-01-02 00:00:00").collect()] == ["later"]
    assert [r.status for r in scd.incremental_after(src, history_df, "order_ts").collect()] == ["later"]
    inclusive = scd.incremental_rows(src, "order_ts", "2020-01-02 00:00:00", inclusive=True)
    assert inclusive.count() == 2


def test_scd2_k_increments_equal_one_full_load(spark):
    src = spark.createDataFrame(
        [(t(d), k, f"s{d}") for d in range(1, 13) for k in (1, 2, 3) if (d + k) % 2 == 0], SCHEMA)
    full = scd.scd2_initial(src, ["orderNumber"], "order_ts")
    hist = scd.scd2_initial(src.where(F.col("order_ts") < t(4)), ["orderNumber"], "order_ts")
    for cut in (t(7), t(10), t(13)):
        inc = scd.incremental_after(src.where(F.col("order_ts") < cut), hist, "order_ts")
        hist = scd.scd2_merge(hist, inc, ["orderNumber"], "order_ts")
    assert rows(hist) == rows(full)


def test_scd1_merge_latest_wins_and_untouched_kept(spark):
    cur = spark.createDataFrame([(t(1), 1, "new"), (t(1), 2, "new")], SCHEMA)
    inc = spark.createDataFrame([(t(2), 1, "paid"), (t(3), 1, "ship"), (t(2), 9, "new")], SCHEMA)
    out = {r.orderNumber: r.status for r in scd.scd1_merge(cur, inc, ["orderNumber"], "order_ts").collect()}
    assert out == {1: "ship", 2: "new", 9: "new"}


def test_latest_per_key_tiebreak(spark):
    df = spark.createDataFrame([(t(1), 1, "a"), (t(1), 1, "b")], SCHEMA)
    out = scd.latest_per_key(df, ["orderNumber"], "order_ts", ["status"])
    assert [r.status for r in out.collect()] == ["b"]


def test_scd1_initial_keeps_duplicates_unless_asked(spark):
    df = spark.createDataFrame([(t(1), 1, "a"), (t(2), 1, "b")], SCHEMA)
    assert scd.scd1_initial(df).count() == 2  # trap 10
    assert scd.scd1_initial(df, ["orderNumber"], "order_ts", dedupe=True).count() == 1


def test_apply_scd_dispatch(spark, history_df, increment_df):
    with pytest.raises(ValueError):
        scd.apply_scd(3, None, increment_df, ["orderNumber"], "order_ts")
    first = scd.apply_scd(2, None, increment_df, ["orderNumber"], "order_ts")
    assert sorted(r.version for r in first.collect()) == [1, 1, 2]
    assert scd.apply_scd(2, history_df, history_df.drop("version"), ["orderNumber"], "order_ts") is None


def _table(spark, name):
    """A fresh name: the catalog outlives a test."""
    import uuid

    return f"{name}_{uuid.uuid4().hex[:8]}"


def _files(spark, table):
    storage = spark.table(history.state(spark, table)["storage"])
    return {r[0] for r in storage.select(F.col("_metadata.file_path")).distinct().collect()}


def _orders(spark, *rows):
    return spark.createDataFrame([(t(d), k, s) for d, k, s in rows], SCHEMA)


def test_run_scd_job_shell(spark, tmp_dir):
    src = _orders(spark, (1, 1, "new"), (1, 2, "new"))
    table = _table(spark, "scd2_orders_test")
    run = lambda df: history.run_scd(spark, 2, table, df, ["orderNumber"], "order_ts", location_root=tmp_dir)
    assert run(src).written and spark.table(table).count() == 2
    before = _files(spark, table)
    more = src.unionByName(_orders(spark, (5, 1, "paid")))
    assert run(more).incoming_rows == 1
    got = {(r.orderNumber, r.status): r.version for r in spark.table(table).collect()}
    assert got == {(1, "new"): 1, (2, "new"): 1, (1, "paid"): 2}
    # the second run wrote its new row and nothing else
    added = _files(spark, table) - before
    assert before < _files(spark, table) and spark.read.parquet(*added).count() == 1
    # re-run of the same increment is a no-op
    assert not run(more).written and _files(spark, table) == before | added


def test_a_run_killed_in_mid_write_leaves_the_table(spark, tmp_dir, monkeypatch):
    for kind in (1, 2):
        table = _table(spark, f"scd{kind}_killed")
        run = lambda df: history.run_scd(spark, kind, table, df, ["orderNumber"], "order_ts", location_root=tmp_dir, buckets=4)  # noqa: B023, E731
        run(_orders(spark, (1, 1, "new"), (1, 2, "new")))
        before, files_before = rows(spark.table(table)), _files(spark, table)
        with monkeypatch.context() as m:

            def dies(*args, **kw):
                raise RuntimeError("killed")

            m.setattr(history, "_add", dies)  # after the files are written, before they are listed
            with pytest.raises(RuntimeError):
                run(_orders(spark, (5, 1, "paid")))
        assert rows(spark.table(table)) == before and _files(spark, table) == files_before
        assert run(_orders(spark, (5, 1, "paid"))).written
        assert {r.status for r in spark.table(table).where("orderNumber = 1").collect()} == ({"paid"} if kind == 1 else {"new", "paid"})


def test_run_scd1_replaces_touched_buckets_only(spark, tmp_dir):
    table = _table(spark, "scd1_orders_test")
    run = lambda df: history.run_scd(spark, 1, table, df, ["orderNumber"], "order_ts", location_root=tmp_dir, buckets=8)
    src = _orders(spark, *[(1, k, "new") for k in range(40)], (1, None, "none"))
    run(src)
    before = _files(spark, table)
    assert run(src.unionByName(_orders(spark, (5, 7, "paid"), (4, 7, "packed"), (5, None, "nowhere")))).incoming_rows == 3
    after = _files(spark, table)
    assert {r.orderNumber: r.status for r in spark.table(table).collect()} == {**{k: "new" for k in range(40)}, 7: "paid", None: "nowhere"}
    touched = before - after
    assert 1 <= len(touched) <= 2 and len(before & after) == len(before) - len(touched)  # untouched files keep their names
    assert history.vacuum(spark, table) and rows(spark.table(table)) and not history.vacuum(spark, table)
    with pytest.raises(ValueError):
        history.run_scd(spark, 2, table, src, ["orderNumber"], "order_ts", location_root=tmp_dir)


def test_merge_reads_touched_buckets_without_a_shuffle(spark, tmp_dir, monkeypatch):
    table, plans = _table(spark, "scd1_plan"), []
    real = history._write_buckets
    monkeypatch.setattr(history, "_write_buckets", lambda spark, rows, *rest: (plans.append(rows._jdf.queryExecution().toString()), real(spark, rows, *rest)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for day, n in ((1, 40), (2, 3)):
            history.run_scd(spark, 1, table, _orders(spark, *[(day, k, "x") for k in range(n)]), ["orderNumber"], "order_ts", location_root=tmp_dir, buckets=4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plans[1][plans[1].index("== Physical Plan =="):]
    join = physical[physical.index("SortMergeJoin"):]
    scan = join.index("Bucketed: true")
    assert "Exchange" not in join[:scan] and "PartitionFilters: [__bucket" in physical


def test_run_scd_adopts_a_plain_table(spark, tmp_dir):
    table = _table(spark, "scd2_foreign")
    made = _orders(spark, (1, 1, "new"), (1, 1, "new"), (1, 2, "new")).withColumn("version", F.lit(1))
    made.write.option("path", f"{tmp_dir}/plain").saveAsTable(table)
    r = history.run_scd(spark, 2, table, _orders(spark, (5, 1, "paid"), (1, 2, "new")), ["orderNumber"], "order_ts", location_root=tmp_dir)
    assert r.incoming_rows == 1
    assert rows(spark.table(table).select("orderNumber", "status", "version")) == [(1, "new", 1), (1, "paid", 2), (2, "new", 1)]


def test_run_scd_with_merge_sql(spark, tmp_dir):
    table = _table(spark, "scd2_sql")
    run = lambda df: history.run_scd(spark, 2, table, df, ["orderNumber"], "order_ts", location_root=tmp_dir, merge_sql=f"{tmp_dir}/merge")
    text = """SELECT order_ts, orderNumber, upper(status) AS status, 7 AS version FROM increment
    UNION ALL SELECT * FROM history"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{tmp_dir}/merge")
    run(_orders(spark, (1, 1, "new")))
    run(_orders(spark, (2, 1, "paid")))
    assert rows(spark.table(table).select("status", "version")) == [("PAID", 7), ("new", 1)]


def test_ties_at_the_mark_and_late_rows_are_loaded_once(spark, tmp_dir):
    first = [(1, 1, "a"), (3, 1, "b"), (3, 2, "b")]
    more = [*first, (3, 3, "tie"), (2, 1, "late"), (3, 1, "tie"), (4, None, "new"), (1, 9, "too late"), (2, 1, "late")]
    for kind in (1, 2):
        table = _table(spark, f"scd{kind}_late")
        run = lambda given: history.run_scd(spark, kind, table, _orders(spark, *given), ["orderNumber"], "order_ts", ["status"], location_root=tmp_dir, buckets=4, lookback="INTERVAL 1 DAY")  # noqa: B023, E731
        run(first)
        assert run(more).written and not run(more).written
        got = rows(spark.table(table).select("orderNumber", "status"))
        if kind == 1:  # (2, 1, late) is older than the row of key 1; the first load keeps rows that repeat a key until then
            assert got == [(None, "new"), (1, "tie"), (2, "b"), (3, "tie")]
        else:
            assert got == [(None, "new"), (1, "a"), (1, "b"), (1, "late"), (1, "tie"), (2, "b"), (3, "tie")]


def test_rows_not_held_equals_an_anti_join(spark):
    from lumenflow.operators import late

    held = spark.range(0, 5000).selectExpr("id AS k", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('x', id) END AS t", "map('a', id, 'b', 1) AS m")
    new = spark.range(4000, 9000).selectExpr("id AS k", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('x', id) END AS t", "map('b', 1, 'a', id) AS m")
    got = late.rows_not_held(new.union(new), held)
    assert sorted(r.k for r in got.collect()) == list(range(5000, 9000))
    marked = new.withColumn("__id", F.struct("k"))
    passed = late._maybe_held(marked, "__id", late.bloom_filter(held.withColumn("__id", F.struct("k")), "__id")).where("__maybe")
    assert {r.k for r in passed.select("k").collect()} >= set(range(4000, 5000)) and passed.count() < 1050
    assert late.rows_not_held(new, held.where("false")).count() == 5000 and late.rows_not_held(new.where("false"), held).count() == 0


def test_history_command(spark, tmp_dir, capsys):
    from lumenflow.plans import history_job

    table = _table(spark, "scd2_command")
    _orders(spark, (1, 1, "new"), (1, 2, "new")).write.parquet(f"{tmp_dir}/source")
    with open(f"{tmp_dir}/options.json", "w") as fh:
        fh.write('{"mergeSchema": "true"}')
    argv = ["2", "--table", table, "--keys", "orderNumber", "--change-key", "order_ts", "--format", "parquet",
            "--option", f"path={tmp_dir}/source", "--options-file", f"{tmp_dir}/options.json", "--location-root", f"{tmp_dir}/h"]
    history_job.main(argv)
    history_job.main(argv)
    out = capsys.readouterr().out.strip().splitlines()
    assert [json.loads(line)["written"] for line in out] == [True, False]
    assert spark.table(table).count() == 2
    with pytest.raises(SystemExit):
        history_job.arguments(["3", *argv[1:]])


def test_versions_of_null_keys_go_on(spark):
    hist = _orders(spark, (1, None, "a"), (1, 3, "a")).withColumn("version", F.lit(1).cast("int"))
    out = scd.scd2_merge(hist, _orders(spark, (2, None, "b"), (3, None, "c"), (2, 3, "b")), ["orderNumber"], "order_ts")
    assert rows(out.select("orderNumber", "status", "version")) == [(None, "a", 1), (None, "b", 2), (None, "c", 3), (3, "a", 1), (3, "b", 2)]
    one = scd.scd1_merge(hist.drop("version"), _orders(spark, (2, None, "b")), ["orderNumber"], "order_ts")
    assert rows(one.select("orderNumber", "status")) == [(None, "b"), (3, "a")]


def test_order_without_a_tiebreak_is_total(spark):
    same = _orders(spark, (1, 1, "b"), (1, 1, "a"), (1, 1, "c"))
    got = {r.status: r.version for r in scd.scd2_initial(same, ["orderNumber"], "order_ts").collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    assert [r.status for r in scd.latest_per_key(same, ["orderNumber"], "order_ts").collect()] == ["c"]


def test_union_of_rows_with_maps(spark):
    old = spark.sql("SELECT 1 k, 1 at, map('a', named_struct('m', map(1, 'x', 2, 'y')), 'b', null) tags, array(map('p', 1, 'q', 2)) list")
    again = spark.sql("SELECT 1 k, 1 at, map('b', null, 'a', named_struct('m', map(2, 'y', 1, 'x'))) tags, array(map('q', 2, 'p', 1)) list")
    other = spark.sql("SELECT 1 k, 1 at, map('b', null, 'a', named_struct('m', map(2, 'y', 1, 'z'))) tags, array(map('q', 2, 'p', 1)) list")
    nothing = old.select(F.lit(2).alias("k"), "at", *[F.when(F.lit(False), F.col(c)).alias(c) for c in ("tags", "list")])
    hist = old.union(again).union(other).union(nothing).union(nothing).withColumn("version", F.lit(1))
    out = scd.scd2_merge(hist, again.withColumn("at", F.lit(5)), ["k"], "at")
    assert sorted((r.k, r.at, r.version) for r in out.collect()) == [(1, 1, 1), (1, 1, 1), (1, 5, 2), (2, 1, 1)]
    assert out.schema["tags"].dataType == old.schema["tags"].dataType


def test_auto_strategy_picks_range_for_hot_key(spark):
    from lumenflow.operators import ranking

    df = spark.createDataFrame([(1 if i < 30 else i, i) for i in range(40)], "k int, o int")
    assert ranking.hottest_key_rows(df, ["k"]) == 30
    a = ranking.sequence_within_key(df, ["k"], ["o"], strategy="auto", hot_key_rows=10)
    b = ranking.sequence_within_key(df, ["k"], ["o"], strategy="window")
    assert rows(a) == rows(b)
    assert sorted(r.version for r in a.where("k = 1").collect()) == list(range(1, 31))


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,2)", "date"])
def test_increments_by_numbers_and_dates(spark, kind):
    value = "date_add(DATE'2020-01-01', CAST(id AS int))" if kind == "date" else f"CAST(id AS {kind})"
    source = spark.range(5).selectExpr("id", f"{value} AS changed")
    for known, expected in ((0, [0, 1, 2, 3, 4]), (3, [3, 4])):
        current = source.where(F.col("id") < known)
        rows = scd.incremental_rows(source, "changed", scd.high_water_mark(current, "changed"))
        assert sorted(r.id for r in rows.collect()) == expected
        assert sorted(r.id for r in scd.incremental_after(source, current, "changed").collect()) == expected


@pytest.mark.parametrize("strategy", ["auto", "range"])
@pytest.mark.parametrize("mapped", [False, True])
def test_merge_of_many_rows_uses_tasks_by_their_number(spark, monkeypatch, strategy, mapped):
    from lumenflow import session
    from lumenflow.operators import ranking

    made = spark.range(600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("k"), (F.col("id") % 50).alias("at"), F.col("id"),
        (F.create_map(F.lit("a"), F.col("id"), F.lit("b"), F.lit(1)) if mapped else F.col("id") * 2).alias("x"))
    history = scd.scd2_initial(made.where("at < 30"), ["k"], "at", ["id"])
    other = history.withColumn("x", F.create_map(F.lit("b"), F.lit(1).cast("long"), F.lit("a"), F.col("id"))) if mapped else history
    merged = lambda: scd.scd2_merge(history.unionByName(other), made.where("at >= 30"), ["k"], "at", ["id"], strategy=strategy)
    picked = lambda df: sorted((r.k is None, r.k, r.version, r.at, r.id, r.x["a"] if mapped else r.x) for r in df.collect())
    plain = merged()
    assert "LeftSemi" in plain._jdf.queryExecution().optimizedPlan().toString()
    want = picked(plain)
    assert len(want) == 600 and len({(w[1], w[2]) for w in want}) == 600
    for module in (session, ranking, scd):
        monkeypatch.setattr(module, "ROWS_PER_TASK", 40)
    found = merged()
    assert picked(found) == want
    assert found.rdd.getNumPartitions() == 24  # 2 * 360 + 240 rows; 4 by spark.sql.shuffle.partitions
    assert "LeftSemi" not in found._jdf.queryExecution().optimizedPlan().toString()
