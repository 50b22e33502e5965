"""Golden cases G1-G7 (FIXTURES.md) on literal frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType

from conftest import rows
from tidemark.operators.history import current_rows_per_key, scd2_apply
from tidemark.operators.incremental import late_files, missing_file_alerts, unprocessed_files
from tidemark.operators.mapping import map_to_contract
from tidemark.operators.merge import upsert
from tidemark.operators.security import mask_group, membership_frame, policy_frame, rls_group
from tidemark.operators.standardize import standardize
from tidemark.sources.spec import collect_mappings, spec_from_dict

D = dt.date

SOURCE_SCHEMA = StructType([
    StructField("policy_id", StringType()), StructField("policy_number", StringType()),
    StructField("issue_date", DateType()), StructField("client_id", StringType()),
    StructField("premium_amount", DecimalType(10, 2))])
TARGET_SCHEMA = StructType([
    StructField("PolicyId", StringType()), StructField("PolicyNumber", StringType()),
    StructField("IssueDate", DateType()), StructField("ClientId", StringType())])


def _m(src, tgt):
    return {"source_column": src, "target_column": f"policy.{tgt}", "source_key": "policy_id",
            "target_key": "PolicyId"}


def spec(cols):
    return {"src_test_ident": {"type": "policy", "schema": "rake_schem_test", "tablename": "table_rak",
                               "relational": "True", "mapping": [_m(s, t) for s, t in cols]}}


FOUR = [("policy_id", "PolicyId"), ("policy_number", "PolicyNumber"), ("issue_date", "IssueDate"),
        ("client_id", "ClientId")]


def _inputs(spark):
    src = spark.createDataFrame([("P1001", "POL-001", D(2023, 1, 1), "C001", 1000),
                                 ("P1002", "POL-002", D(2023, 2, 15), "C002", 2000)],
                                "policy_id string, policy_number string, issue_date date, client_id string, "
                                "premium_amount int").select(
        *[F.col(c) for c in ["policy_id", "policy_number", "issue_date", "client_id"]],
        F.col("premium_amount").cast(DecimalType(10, 2)))
    tgt = spark.createDataFrame([("P1001", "OLD-POL-001", D(2022, 1, 1), "OLD_C001")], TARGET_SCHEMA)
    return src, tgt


def _run(spark, cols):
    src, tgt = _inputs(spark)
    maps = collect_mappings(spec_from_dict(spark, spec(cols)))
    return standardize(spark, tgt, TARGET_SCHEMA, maps, lambda name: src)


def test_g1_four_column_spec(spark):
    out = _run(spark, FOUR)
    assert out.columns == ["PolicyId", "PolicyNumber", "IssueDate", "ClientId"]  # premium never appears
    assert rows(out) == [("P1001", "POL-001", D(2023, 1, 1), "C001"), ("P1002", "POL-002", D(2023, 2, 15), "C002")]


def test_g2_two_column_spec_keeps_unmapped(spark):
    out = _run(spark, FOUR[:2])
    assert rows(out) == [("P1001", "POL-001", D(2022, 1, 1), "OLD_C001"), ("P1002", "POL-002", None, None)]


def test_g2_variants_blank_null_and_null_keys(spark):
    t = spark.createDataFrame([("K1", "old", "x"), (None, "nk", "y"), ("K3", "keep", "z")], "k string, a string, b string")
    s = spark.createDataFrame([("K1", "", None), (None, "nk2", None), ("K9", "", "w")], "k string, a string, b string")
    out = upsert(t, s, ["k"])
    assert rows(out) == [(None, "nk2", "y"), ("K1", "old", "x"), ("K3", "keep", "z"), ("K9", None, "w")]


def test_g3_scd2_and_rerun(spark):
    dim = spark.createDataFrame(
        [(1, "A", D(2024, 1, 1), None, True), (2, "B", D(2024, 1, 1), None, True),
         (4, "D", D(2024, 1, 1), None, True), (5, None, D(2024, 1, 1), None, True)],
        "customer_id int, city string, start_date date, end_date date, is_current boolean")
    src = spark.createDataFrame([(1, "A"), (2, "C"), (3, "E"), (5, "F")], "customer_id int, city string")
    out = scd2_apply(dim, src, ["customer_id"], ["city"], "2024-06-01")
    expected = [
        (1, "A", D(2024, 1, 1), None, True),
        (2, "B", D(2024, 1, 1), D(2024, 6, 1), False),
        (2, "C", D(2024, 6, 1), None, True),
        (3, "E", D(2024, 6, 1), None, True),
        (4, "D", D(2024, 1, 1), None, True),
        (5, None, D(2024, 1, 1), D(2024, 6, 1), False),
        (5, "F", D(2024, 6, 1), None, True),
    ]
    assert rows(out) == sorted(expected, key=lambda t: tuple((x is not None, str(x)) for x in t))
    again = scd2_apply(out, src, ["customer_id"], ["city"], "2024-07-01")
    assert rows(again) == rows(out)
    assert current_rows_per_key(again, ["customer_id"]).count() == 0


def test_g4_security(spark):
    emp = spark.createDataFrame([(1, "HR", 100), (2, "Finance", 200), (3, "IT", 300)],
                                "emp_id int, dept string, salary int")
    pol = policy_frame(spark, [("hr_team", "HR"), ("finance_team", "Finance")])
    mem = membership_frame(spark, [("h@x", "hr_team"), ("f@x", "finance_team")])
    assert rows(rls_group(emp, "dept", pol, mem, user="h@x")) == [(1, "HR", 100)]
    fin = mask_group(rls_group(emp, "dept", pol, mem, user="f@x"), ["salary"], ["finance_team"], mem, user="f@x")
    assert rows(fin) == [(2, "Finance", 200)]
    assert rls_group(emp, "dept", pol, mem, user="nobody@x").count() == 0
    masked = mask_group(emp, ["salary"], ["finance_team"], mem, user="nobody@x")
    assert {r.salary for r in masked.collect()} == {None}


def _listing(spark):
    rows_ = []
    for feed, ext in [("vehicle_cost", "csv"), ("fuel_txn", "json"), ("maint_inv", "parquet")]:
        for day in (28, 29):
            arrival = D(2026, 1, 30) if (feed, day) == ("vehicle_cost", 29) else D(2026, 1, day)
            rows_.append((feed, f"{feed}_202601{day}.{ext}", D(2026, 1, day), arrival))
    return spark.createDataFrame(rows_, "source_name string, file_name string, business_date date, arrival_date date")


def test_g5_unprocessed_files(spark):
    log = spark.createDataFrame(
        [("vehicle_cost", "vehicle_cost_20260128.csv", D(2026, 1, 28), "SUCCESS"),
         ("fuel_txn", "fuel_txn_20260128.json", D(2026, 1, 28), "SUCCESS")],
        "source_name string, file_name string, processed_date date, status string")
    out = unprocessed_files(_listing(spark), log)
    assert sorted(r.file_name for r in out.collect()) == [
        "fuel_txn_20260129.json", "maint_inv_20260128.parquet", "maint_inv_20260129.parquet",
        "vehicle_cost_20260129.csv"]


def test_g6_late_file_and_missing_alert(spark):
    listing = _listing(spark)
    log = spark.createDataFrame([], "source_name string, file_name string, processed_date date, status string")
    late = late_files(unprocessed_files(listing, log))
    assert [(r.file_name, r.days_late) for r in late.collect()] == [("vehicle_cost_20260129.csv", 1)]
    # on the 29th the vehicle file has not arrived yet: it is missing then
    arrived_by_29 = listing.filter(F.col("arrival_date") <= F.lit("2026-01-29").cast("date"))
    cfg = spark.createDataFrame([("vehicle_cost", True), ("fuel_txn", True), ("maint_inv", False)],
                                "source_name string, expected_daily boolean")
    alerts = missing_file_alerts(cfg, arrived_by_29, "2026-01-29", "2026-01-29")
    assert [(r.source_name, r.business_date) for r in alerts.collect()] == [("vehicle_cost", D(2026, 1, 29))]


def test_g7_repeated_target_adds_rows(spark):
    df = spark.createDataFrame([("a1", "x1", "y1"), ("a2", "x2", "y2")], "id string, c1 string, c2 string")
    contract = StructType([StructField("Id", StringType()), StructField("Code", StringType()),
                           StructField("Other", StringType())])
    sp = {"s.csv": {"type": "t", "schema": "sdm", "tablename": "x", "relational": "False", "mapping": [
        {"source_column": "id", "target_column": "e.Id", "source_key": "id", "target_key": "Id"},
        {"source_column": "c1", "target_column": "e.Code", "source_key": "id", "target_key": "Id"},
        {"source_column": "c2", "target_column": "e.Code", "source_key": "id", "target_key": "Id"}]}}
    out = map_to_contract(df, contract, collect_mappings(spec_from_dict(spark, sp))["s"])
    assert out.columns == ["Id", "Code", "Other", "rec_type", "filename"]
    assert rows(out) == [(None, "y1", None, "t", "s"), (None, "y2", None, "t", "s"),
                         ("a1", "x1", None, "t", "s"), ("a2", "x2", None, "t", "s")]


def test_spec_feeding_two_tables_runs_once_per_target(spark):
    from tidemark.operators.standardize import mappings_by_target, run_all_targets
    from tidemark.session import shared_dir

    def m(src, tgt):
        return {"source_column": src, "target_column": tgt, "source_key": "id", "target_key": "Id"}

    sp = {"a.csv": {"type": "x", "schema": "s1", "tablename": "t1", "relational": "True",
                    "mapping": [m("id", "Id"), m("v", "V")]},
          "b.csv": {"type": "y", "schema": "s2", "tablename": "t2", "relational": "False",
                    "mapping": [m("id", "Id"), m("v", "V")]}}
    maps = collect_mappings(spec_from_dict(spark, sp))
    assert list(mappings_by_target(maps)) == [("s1", "t1"), ("s2", "t2")]
    frames = {"a": spark.createDataFrame([(1, "p")], "id int, v string"),
              "b": spark.createDataFrame([(2, "q"), (3, "r")], "id int, v string")}
    root = shared_dir(spark, "multi")
    contract = StructType([StructField("Id", StringType()), StructField("V", StringType())])
    reports = run_all_targets(spark, maps, lambda s, t: f"{root}/{s}/{t}", lambda s, t: contract,
                              frames.__getitem__)
    assert [(r["schema"], r["target_table"], r["rows_loaded"]) for r in reports] == [("s1", "t1", 1), ("s2", "t2", 2)]


def test_snapshot_upsert_replay(spark):
    from tidemark.session import shared_dir
    from tidemark.streaming.intake import SnapshotUpsert

    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    h = SnapshotUpsert(shared_dir(spark, "snap"), ["k"])
    h.init(target)
    h(batch, 0)
    first = rows(h.latest(spark))
    h(batch, 0)
    assert rows(h.latest(spark)) == first == [(1, "a"), (2, "B"), (3, "c")]


def test_g1_g2_with_single_aggregation_merge(spark):
    src, tgt = _inputs(spark)
    for cols in (FOUR, FOUR[:2]):
        maps = collect_mappings(spec_from_dict(spark, spec(cols)))
        by_join = standardize(spark, tgt, TARGET_SCHEMA, maps, lambda name: src)
        by_agg = standardize(spark, tgt, TARGET_SCHEMA, maps, lambda name: src, unique_keys=True)
        assert by_agg.columns == by_join.columns and rows(by_agg) == rows(by_join)


def test_run_all_targets_unique_keys_path(spark):
    from tidemark.operators.standardize import run_all_targets
    from tidemark.session import shared_dir

    src, tgt = _inputs(spark)
    root = shared_dir(spark, "ukrun")
    tgt.write.parquet(f"{root}/rake_schem_test/table_rak")
    maps = collect_mappings(spec_from_dict(spark, spec(FOUR)))
    reports = run_all_targets(spark, maps, lambda s, t: f"{root}/{s}/{t}", lambda s, t: TARGET_SCHEMA,
                              lambda name: src, unique_keys=True)
    assert [(r["schema"], r["target_table"], r["rows_loaded"]) for r in reports] == [
        ("rake_schem_test", "table_rak", 2)]
    stored = spark.read.parquet(f"{root}/rake_schem_test/table_rak")
    assert rows(stored) == [("P1001", "POL-001", D(2023, 1, 1), "C001"), ("P1002", "POL-002", D(2023, 2, 15), "C002")]
