"""Spec flattening, mapping audit, JDBC option building, file helpers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.mapping import (
    duplicate_columns,
    map_to_contract,
    mapping_audit,
    rename_by_mapping,
    schema_rows,
)
from tidemark.sources.files import dated_path, dated_paths_between, format_name
from tidemark.sources.jdbc import ConfigError, jdbc_options, jdbc_url, quoted_table
from tidemark.sources.spec import collect_mappings, load_spec, spec_from_dict

SPEC = {
    "orders.csv": {"type": "order", "schema": "sdm", "tablename": "t", "relational": "True", "mapping": [
        {"source_column": "id", "target_column": "order.OrderId", "source_key": "id", "target_key": "OrderId"},
        {"source_column": "amt ", "target_column": "order.Amount", "source_key": "id", "target_key": "OrderId"},
        {"source_column": "ghost", "target_column": "order.Ghost", "source_key": "id", "target_key": "OrderId"}]},
    "life.xlsx": {"type": "life", "schema": "sdm", "tablename": "t", "relational": True, "mapping": [
        {"source_column": "FirstName", "target_column": "FirstName", "source_key": "PolicyIdentifier",
         "target_key": "PolicyIdentifier"}]},
}


def test_flatten_keeps_order_and_coerces_flags(spark, tmp_path):
    p = tmp_path / "spec.json"
    p.write_text(json.dumps(SPEC, indent=2))
    flat = load_spec(spark, str(p))
    rs = flat.orderBy("src_ord", "ord").collect()
    assert [(r.source_table, r.ord, r.source_column, r.entity, r.target_column) for r in rs] == [
        ("orders", 0, "id", "order", "OrderId"), ("orders", 1, "amt", "order", "Amount"),
        ("orders", 2, "ghost", "order", "Ghost"), ("life", 0, "FirstName", None, "FirstName")]
    assert {r.source_table: r.relational for r in rs} == {"orders": True, "life": True}


def test_rename_carries_key_not_among_mapped_columns(spark):
    maps = collect_mappings(spec_from_dict(spark, SPEC))
    df = spark.createDataFrame([("P1", "Ann", "x")], "PolicyIdentifier string, FirstName string, other string")
    out = rename_by_mapping(df, maps["life"])
    assert out.columns == ["PolicyIdentifier", "FirstName"]


def test_rename_last_target_wins_and_skips_absent(spark):
    sp = {"s": {"type": "t", "schema": "x", "tablename": "y", "relational": "True", "mapping": [
        {"source_column": "a", "target_column": "A1", "source_key": "a", "target_key": "A1"},
        {"source_column": "b", "target_column": "B1", "source_key": "a", "target_key": "A1"},
        {"source_column": "b", "target_column": "B2", "source_key": "a", "target_key": "A1"},
        {"source_column": "zz", "target_column": "Z", "source_key": "a", "target_key": "A1"}]}}
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = rename_by_mapping(df, collect_mappings(spec_from_dict(spark, sp))["s"])
    assert out.columns == ["A1", "B2"]


def test_mapping_audit_and_duplicates(spark):
    flat = spec_from_dict(spark, SPEC)
    src = schema_rows(spark, {"orders": spark.createDataFrame([(1, 2.0)], "id int, amt double")})
    contract = StructType([StructField("OrderId", StringType()), StructField("Amount", StringType())])
    audit = {(r.source, r.kind, r.column) for r in mapping_audit(spark, flat.filter("source_table = 'orders'"),
                                                                   src, contract).collect()}
    assert audit == {("orders.csv", "missing_source", "ghost"), ("orders.csv", "missing_target", "Ghost")}
    cols = spark.createDataFrame([("t", "Id"), ("t", "ID"), ("t", "x")], "source_table string, column string")
    d = duplicate_columns(cols).collect()
    assert [(r.column_lc, r.n) for r in d] == [("id", 2)]


def test_contract_projection_entity_id_trigger(spark):
    sp = {"issuer.csv": {"type": "issuer", "schema": "esg", "tablename": "e", "relational": "False", "mapping": [
        {"source_column": "issuer_id ", "target_column": "esg.issuer_id", "source_key": "issuer_id",
         "target_key": "issuer_id"}]}}
    contract = StructType([StructField("issuer_id", StringType()), StructField("esg_entity_id", StringType())])
    df = spark.createDataFrame([("12",), ("7",)], "issuer_id string")
    out = map_to_contract(df, contract, collect_mappings(spec_from_dict(spark, sp))["issuer"])
    assert sorted(r.esg_entity_id for r in out.collect()) == ["I_12", "I_7"]


def test_jdbc_templates_and_options():
    assert jdbc_url("mysql", host="h", database="d") == "jdbc:mysql://h:3306/d"
    assert jdbc_url("sqlserver", host="h", database="d") == "jdbc:sqlserver://h:1433;databaseName=d"
    assert jdbc_url("snowflake", account="acc") == "jdbc:snowflake://acc.snowflakecomputing.com"
    with pytest.raises(ConfigError):
        jdbc_url("snowflake", host="h")  # account missing (D2)
    with pytest.raises(ConfigError):
        jdbc_url("oracle", host="h")  # unknown kind (D1)
    o = jdbc_options("postgres", "orders", host="h", database="d", user="u", password="p",
                     partition_column="id", lower_bound=0, upper_bound=1000, num_partitions=8)
    assert o["dbtable"] == "orders" and o["numPartitions"] == "8" and o["driver"] == "org.postgresql.Driver"
    with pytest.raises(ConfigError):
        jdbc_options("postgres", "orders", host="h", database="d", partition_column="id")
    assert quoted_table("s", 'we"ird') == '"s"."we""ird"'


def test_file_helpers():
    assert format_name("PARQUET") == "parquet" and format_name(" csv ") == "csv"
    assert dated_path("/ald/vehicle_cost/", "2026-01-29") == "/ald/vehicle_cost/2026/01/29/"
    assert dated_paths_between("/r", "2026-01-30", "2026-02-01") == ["/r/2026/01/30/", "/r/2026/01/31/",
                                                                     "/r/2026/02/01/"]


def test_value_filters_match_join_semantics(spark):
    from tidemark.operators.joins import semi_by_values

    big = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, v int")
    vals = spark.createDataFrame([("a",), (None,)], "s string")
    semi = {r.v for r in semi_by_values(big, "s", vals, "s").collect()}
    anti = {r.v for r in semi_by_values(big, "s", vals, "s", anti=True).collect()}
    assert semi == {r.v for r in big.join(vals, "s", "left_semi").collect()} == {1}
    assert anti == {r.v for r in big.join(vals, "s", "left_anti").collect()} == {2, 3}
    # beyond the bound the join path gives the same answer


def test_read_target_first_run_only_when_absent(spark, tmp_path):
    from tidemark.sources.target import read_target

    contract = StructType([StructField("Id", StringType())])
    empty = read_target(spark, str(tmp_path / "nothing-here"), contract)
    assert empty.count() == 0 and empty.columns == ["Id"]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_target(spark, str(tmp_path / "bad"), contract).count()


def test_gate_splits_bronze(spark):
    from tidemark.operators.quality import apply_gate

    gate = spark.createDataFrame([("a", "PASS"), ("b", "BLOCK")], "source_name string, status string")
    bronze = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "source_name string, v int")
    ok, held = apply_gate(bronze, gate)
    assert sorted(r.v for r in ok.collect()) == [1, 3] and [r.v for r in held.collect()] == [2]


def test_backfill_replace_is_idempotent(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.incremental import backfill_bound, load_backfill, replace_window

    src = spark.createDataFrame([(i, f"2024-01-{d:02d} 10:00:00") for i, d in enumerate(range(1, 31))],
                                "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    existing = src.filter("id < 25")
    lower = backfill_bound("2024-01-31", 7)
    once = replace_window(existing, load_backfill(src, "ts", "2024-01-31", 7), "ts", lower)
    twice = replace_window(once, load_backfill(src, "ts", "2024-01-31", 7), "ts", lower)
    assert sorted(r.id for r in once.collect()) == list(range(30)) == sorted(r.id for r in twice.collect())


def test_files_matching(spark):
    from tidemark.operators.incremental import files_matching

    cfg = spark.createDataFrame([("fuel", "fuel_*.json"), ("cost", "cost_????????.csv")],
                                "source_name string, file_pattern string")
    listing = spark.createDataFrame([("fuel", "fuel_20260129.json"), ("fuel", "fuel_20260129.json.tmp"),
                                     ("cost", "cost_20260129.csv"), ("cost", "cost_x.csv"), ("other", "a.json")],
                                    "source_name string, file_name string")
    fast = sorted(r.file_name for r in files_matching(listing, cfg).collect())
    assert fast == ["cost_20260129.csv", "fuel_20260129.json"]


def test_rules_validated_before_running(spark):
    from tidemark.operators.ingest import IngestionRule, RuleError, run_rules
    from tidemark.sources.jdbc import SOURCE_KINDS

    df = spark.createDataFrame([(1, "ACTIVE", 5.0), (2, "GONE", 2000.0)], "id int, status string, amount double")
    ok = IngestionRule.from_dict({"source": "sqlserver", "object": "t", "columns": ["id", "amount"],
                                  "target_table": "landing_t", "filter_condition": "status = 'ACTIVE'"})
    out = run_rules([ok], lambda r: df, known_kinds=list(SOURCE_KINDS))
    assert [tuple(r) for r in out["landing_t"].collect()] == [(1, 5.0)]
    bad = IngestionRule("mongodb", "customers", "landing_c", ("customer_id",))
    with pytest.raises(RuleError):
        run_rules([ok, bad], lambda r: df, known_kinds=list(SOURCE_KINDS))


def test_json_kinds_and_drift(spark):
    from tidemark.operators.quality import json_field_drift, observed_fields

    raw = spark.createDataFrame([
        ("f", '{"a": 1, "b": "x", "c": 2.5, "d": true, "e": null, "g": {"z": 1}, "h": [1]}'),
        ("f", '{"a": "1", "b": "y"}')], "src string, rec string")
    kinds = {(r.field, r.kind): r.n_records for r in observed_fields(raw, "rec", "src").collect()}
    assert kinds == {("a", "number"): 1, ("a", "string"): 1, ("b", "string"): 2, ("c", "number"): 1,
                     ("d", "boolean"): 1, ("e", "null"): 1, ("g", "object"): 1, ("h", "array"): 1}
    reg = spark.createDataFrame([("f", "a", "number"), ("f", "b", "string"), ("f", "q", "string")],
                                "source_name string, field string, type string")
    drift = {(r.field, r.kind, r.n_records) for r in json_field_drift(raw, "rec", "src", reg).collect()}
    assert ("a", "retyped", 1) in drift and ("q", "missing", 2) in drift and ("g", "new", 1) in drift
    assert ("b", "ok", 2) in drift


def test_drift_gate_names_every_field(spark):
    from tidemark.operators.quality import drift_gate

    names = [f"k{i:05d}" for i in range(2500)]
    drift = spark.createDataFrame([("feed", n, "new") for n in names] + [("feed", "a", "ok"), ("calm", "a", "ok")],
                                  "source_name string, field string, kind string")
    got = {r.source_name: r for r in drift_gate(drift).collect()}
    assert got["feed"].drift == ",".join(f"new:{n}" for n in names)
    assert (got["feed"].n_drift_fields, got["feed"].status) == (2500, "BLOCK")
    assert (got["calm"].n_drift_fields, got["calm"].drift, got["calm"].status) == (0, "", "PASS")


def test_sql_policy_functions_escape_values(spark):
    from tidemark.operators.security import register_mask_function, register_row_filter_function

    register_row_filter_function(spark, "tm_test_rls", [("o'neil@x", "R&D 'core'")])
    register_mask_function(spark, "tm_test_mask", ["o'neil@x"])
    r = spark.sql("SELECT tm_test_rls('R&D ''core''', 'o''neil@x') AS ok, tm_test_rls('x', 'o''neil@x') AS no, "
                  "tm_test_mask(CAST(5.0 AS DOUBLE), 'o''neil@x') AS shown, "
                  "tm_test_mask(CAST(5.0 AS DOUBLE), 'eve') AS hidden").first()
    assert (r.ok, r.no, r.shown, r.hidden) == (True, False, 5.0, None)


def test_unknown_load_type_takes_incremental_path(spark):
    from tidemark.operators.incremental import plan_loads

    cfg = spark.createDataFrame([("a", "FULL", "ts", None), ("b", "incremental", "ts", None),
                                 ("c", "BACKFILL", "ts", 3)],
                                "table_name string, load_type string, watermark_column string, backfill_days int")
    wm = spark.createDataFrame([("a", "2024-01-05 00:00:00"), ("b", "2024-01-05 00:00:00")],
                               "table_name string, value string")
    plan = {r.table_name: (r.lower_bound, r.inclusive) for r in plan_loads(cfg, wm, "2024-01-31").collect()}
    assert plan["a"] == (None, False)
    assert str(plan["b"][0]) == "2024-01-05 00:00:00" and plan["b"][1] is False
    assert str(plan["c"][0]) == "2024-01-28 00:00:00" and plan["c"][1] is True


def test_lineage_on_non_file_source(spark):
    from tidemark.sinks.writers import with_lineage

    out = with_lineage(spark.createDataFrame([(1,)], "v int"), source_name="s", ingest_date="2024-02-01")
    r = out.first()
    assert r._file_name is None and r.source_name == "s" and str(r._ingest_date) == "2024-02-01"
