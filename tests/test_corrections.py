"""Cases that earlier versions got wrong or left undefined."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import StructField, StructType

from conftest import rows
from tidemark.operators.clean import drop_all_null_columns
from tidemark.operators.history import scd2_apply
from tidemark.operators.incremental import apply_plan, files_matching, plan_loads
from tidemark.operators.merge import merge_all, upsert
from tidemark.operators.quality import Rule, dq_rejects, dq_summary
from tidemark.operators.security import secured_view
from tidemark.session import shared_dir
from tidemark.sinks.writers import replace_load, replace_path, write_silver
from tidemark.streaming.intake import SnapshotUpsert


def test_two_patterns_of_one_feed_each_file_once(spark):
    listing = spark.createDataFrame([("a", "a_1.json"), ("a", "b_1.json"), ("a", "c_1.json"), ("b", "a_1.json")],
                                    "source_name string, file_name string")
    config = spark.createDataFrame([("a", "a_*.json"), ("a", "b_*.json"), ("a", "*_1.jso?"), (None, "*")],
                                   "source_name string, file_pattern string")
    assert rows(files_matching(listing, config)) == [("a", "a_1.json"), ("a", "b_1.json"), ("a", "c_1.json")]


def test_null_load_type_loads_after_the_bookmark(spark):
    cfg = spark.createDataFrame([("t", None, "ts", None)], "table_name string, load_type string, watermark_column string, backfill_days int")
    wm = spark.createDataFrame([("t", dt.datetime(2024, 1, 1))], "table_name string, value timestamp_ntz")
    data = spark.createDataFrame([("t", dt.datetime(2024, 1, 1)), ("t", dt.datetime(2024, 1, 2))], "name string, ts timestamp_ntz")
    assert apply_plan(data, plan_loads(cfg, wm, "2024-01-31"), "name", "ts").count() == 1


def test_silver_replaces_only_delivered_partitions_in_any_session(spark):
    path = shared_dir(spark, "silver-test")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        write_silver(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
        write_silver(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_retried_load_replaces_itself(spark):
    path = shared_dir(spark, "bronze-test")
    for load, v in (("l1", 1), ("l2", 2), ("l2", 3)):
        replace_load(spark.createDataFrame([(v,)], "v int"), path, load)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]


def test_unknown_check_and_repeated_rule_id_are_refused(spark):
    df = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(ValueError, match="unknown check"):
        dq_rejects(df, [Rule("r1", "a", "notnull")])
    with pytest.raises(ValueError, match="twice"):
        dq_summary(df, [Rule("r1", "a", "not_null"), Rule("r1", "a", "unique")])


def test_summary_of_an_empty_table_is_zero(spark):
    df = spark.createDataFrame([], "a int, b int")
    parent = spark.createDataFrame([(1,)], "a int")
    got = dq_summary(df, [Rule("n", "a", "not_null"), Rule("u", "b", "unique"), Rule("r", "a", "referential", ("p", "a"))],
                     {"p": parent})
    assert {tuple(r)[3:] for r in got.collect()} == {(0, 0)} and got.count() == 3


def test_referential_rule_on_a_hot_value_is_split(spark):
    from test_skew import hot_lines, n_skew_joins, skew_session

    from tidemark.operators.quality import validate

    with skew_session(spark):
        parent = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey").where("o_orderkey > 0")
        checked = validate(hot_lines(spark), [Rule("r", "k", "referential", ("o", "o_orderkey"))], {"o": parent})
        assert n_skew_joins(checked) >= 1
        hot = checked.filter("k = 0")
        assert hot.filter("failed_rules = 'r'").count() == hot.count() > 0


def test_stated_unique_keys_are_checked(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "c")], "k int, v string")
    with pytest.raises(PySparkException, match="repeats"):
        upsert(t, s, ["k"], unique_keys=True).collect()
    with pytest.raises(PySparkException, match="repeats"):
        merge_all(s, [(t, ["k"])]).collect()


def test_null_keys_can_stay_apart(spark):
    t = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    s = spark.createDataFrame([(None, "x"), (None, ""), (1, "y")], "k int, v string")
    assert upsert(t, s, ["k"]).count() == 5
    for unique in (False, True):
        got = rows(upsert(t, s, ["k"], null_keys="append", unique_keys=unique))
        assert got == [(None, None), (None, "a"), (None, "b"), (None, "x"), (1, "y")]


def test_column_names_match_without_case(spark):
    t = spark.createDataFrame([(1, "a")], "Id int, Name string")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "id int, name string")
    for unique in (False, True):
        got = upsert(t, s, [("Id", "id")], unique_keys=unique)
        assert got.columns == ["Id", "Name"] and rows(got) == [(1, "b"), (2, "c")]


def test_scd2_not_null_columns_and_conflicting_rows(spark):
    schema = StructType([StructField(f.name, f.dataType, False) if f.name != "end_date" else f for f in spark.createDataFrame(
        [], "id int, city string, start_date date, end_date date, is_current boolean").schema])
    d0 = dt.date(2024, 1, 1)
    dim = spark.createDataFrame([(1, "x", d0, None, True)], schema)
    src = spark.createDataFrame([(1, "y"), (1, "y"), (2, "z")], "id int, city string")
    assert scd2_apply(dim, src, ["id"], ["city"], "2024-06-01").count() == 3
    with pytest.raises(PySparkException, match="differ"):
        scd2_apply(dim, src.union(spark.createDataFrame([(1, "w")], src.schema)), ["id"], ["city"], "2024-06-01").collect()
    twice = dim.union(spark.createDataFrame([(1, "q", d0, None, True)], dim.schema))
    with pytest.raises(PySparkException, match="two current rows"):
        scd2_apply(twice, src, ["id"], ["city"], "2024-06-01").collect()


def test_empty_frame_keeps_its_columns(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert drop_all_null_columns(df).columns == ["a", "b"]
    path = shared_dir(spark, "empty-target")
    assert replace_path(df, path, drop_null_columns=True) == 0
    assert spark.read.parquet(path).columns == ["a", "b"]


def test_replace_path_drops_null_columns_and_its_staged_copy(spark):
    import glob
    import os

    path = shared_dir(spark, "target")
    replace_path(spark.createDataFrame([(1, None, "x")], "a int, b string, c string"), path, drop_null_columns=True)
    assert spark.read.parquet(path).columns == ["a", "c"]
    base = os.path.dirname(path.replace("file:", ""))
    assert not glob.glob(f"{base}/staged-*/part-*")


def test_latest_snapshot_after_a_restart(spark):
    root = shared_dir(spark, "snaps")
    first = SnapshotUpsert(root, ["k"])
    first.init(spark.createDataFrame([(1, "a")], "k int, v string"))
    first(spark.createDataFrame([(2, "b")], "k int, v string"), 0)
    assert SnapshotUpsert(root, ["k"]).latest(spark).count() == 2


def test_revoke_takes_effect_on_a_live_view(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "dept string, pay double")
    policy = spark.createDataFrame([("g", "x")], "`group` string, value string")
    spark.sql("DROP TABLE IF EXISTS tm_members")
    spark.createDataFrame([("ann", "g")], "user string, `group` string").write.saveAsTable("tm_members")
    try:
        secured_view(df, "tm_secured", row_column="dept", group_policy=policy, membership=spark.table("tm_members"),
                     masks={"pay": ["g"]}, user="ann")
        assert rows(spark.table("tm_secured")) == [("x", 1.0)]
        spark.sql("INSERT OVERWRITE tm_members SELECT 'bob', 'g'")
        assert spark.table("tm_secured").count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS tm_members")


def test_group_policy_without_membership_denies(spark):
    df = spark.createDataFrame([("x", 1.0)], "dept string, pay double")
    policy = spark.createDataFrame([("g", "x")], "`group` string, value string")
    assert secured_view(df, "tm_denied", row_column="dept", group_policy=policy, user="ann").count() == 0
    seen = secured_view(df, "tm_masked", masks={"pay": ["g"]}, user="ann")
    assert [r.pay for r in seen.collect()] == [None]


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    from tidemark import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_no_jobs_while_plain_queries_are_built(spark):
    """Reading a parquet schema runs a job; nothing else may, but for queries that write."""
    from conftest import SF001
    from tidemark.plans import registry

    registry.load_all()
    tracker = spark.sparkContext.statusTracker()
    for name in ("coalesce_upsert", "multi_source_fold", "scd2_full", "load_plan", "rls_group", "secured_view",
                 "per_source_upsert", "feed_file_match", "dq_rejects", "mask_group"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        registry.QUERIES[name](spark, SF001)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
        assert len(stages) == len(jobs) and len(jobs) <= 8, (name, jobs)  # single-stage schema reads
    spark.sparkContext.setJobGroup("tests", "tests")


def test_profitability_splits_a_hot_item(spark):
    from pyspark.sql import functions as F
    from test_skew import hot_lines, n_skew_joins, skew_session

    from tidemark.operators.gold import profitability

    with skew_session(spark):
        revenue = hot_lines(spark).select(F.col("l_partkey").alias("contract"), "k", F.lit(1.0).alias("r"))
        cost = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", F.lit(0.5).alias("c"))
        out = profitability(revenue, "contract", "k", "r", cost, "o_orderkey", "c")
        assert n_skew_joins(out) >= 1
        assert out.agg(F.sum("revenue")).first()[0] == revenue.count()
