"""Rules kept as a table: loading, one pass for all set rules, one evaluation for all zones (Q4, Q5)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows

from tidemark.operators.quality import Rule, dq_summary, validate
from tidemark.operators.rule_table import FAILED, RuleError, check_table, flag_rows, load_rules, rejected, summarize
from tidemark.plans.quality_queries import LINEITEM_RULES, rules_frame
from tidemark.plans.registry import table
from tidemark.session import shared_dir

SCHEMA = "rule_id string, column_name string, check string, argument string"
RULES = [Rule("a", "k", "unique"), Rule("b", "k", "unique", ("k", "v")), Rule("c", "k", "referential", ("p", "id")),
         Rule("d", "v", "referential", ("q", "name")), Rule("e", "v", "in_set", ("x", "y")), Rule("f", "K", "range", (0, None))]


def messy(spark):
    data = [(1, "x"), (1, "y"), (2, "x"), (2, "x"), (None, "x"), (None, None), (None, None), (-3, "z"), (9, ""), (7, "y")]
    return spark.createDataFrame(data, "k int, v string")


def parents(spark):
    return {"p": spark.createDataFrame([(1,), (2,), (2**40,), (None,), (-3,), (7,)], "id bigint"),
            "q": spark.createDataFrame([("x",), ("x",), ("z",), (None,)], "name string")}


def test_rules_are_loaded_and_refused(spark):
    assert load_rules(rules_frame(spark), "lineitem") == LINEITEM_RULES
    assert load_rules(rules_frame(spark), "nation") == []
    for row in [("r", "c", "in_set", '{"a": 1}'), ("r", "c", "range", "{}"), ("r", "c", "regex", "^a"), ("r", "c", "nope", None),
                (None, "c", "not_null", None), ("r,s", "c", "not_null", None), ("r", None, "not_null", None),
                ("r", "c", "referential", '{"table": "t"}')]:
        with pytest.raises(ValueError):
            load_rules(spark.createDataFrame([row], SCHEMA))
    with pytest.raises(ValueError, match="twice"):
        load_rules(spark.createDataFrame([("r", "c", "not_null", None)] * 2, SCHEMA))
    df = messy(spark)
    for rule in (Rule("r", "absent", "not_null"), Rule("r", "k", "unique", ("k", "absent")), Rule("r", "k", "referential", ("p", "id"))):
        with pytest.raises(RuleError):
            flag_rows(df, [rule])
    with pytest.raises(RuleError):
        flag_rows(df.withColumn(FAILED, F.lit(1)), [])


def test_flags_of_messy_rows(spark):
    got = rows(flag_rows(messy(spark), RULES, parents(spark)))
    want = [(1, "x", ["a"]), (1, "y", ["a", "d"]), (2, "x", ["a", "b"]), (2, "x", ["a", "b"]), (None, "x", ["a"]),
            (None, None, ["a", "b"]), (None, None, ["a", "b"]), (-3, "z", ["e", "f"]), (9, "", ["c", "d", "e"]), (7, "y", ["d"])]
    key = lambda t: (t[0] is not None, str(t[0]), t[1] is not None, str(t[1]))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_equals_the_rules_given_as_a_list(spark):
    df, refs = messy(spark), parents(spark)
    rules = [r for r in RULES if r.rule_id != "f"]
    assert rows(rejected(flag_rows(df, rules, refs))) == rows(validate(df, rules, refs).filter("failed_rules <> ''"))
    assert rows(summarize(flag_rows(df, rules, refs), rules)) == rows(dq_summary(df, rules, refs))


def test_parent_keys_of_another_type(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    refs = {"p": spark.createDataFrame([(1.0,), (2.5,), (1e300,)], "id double")}
    got = rows(flag_rows(df, [Rule("r", "k", "referential", ("p", "id"))], refs))
    assert got == [(1, []), (2, ["r"]), (3, ["r"])]


def scans(df, column):
    """Scans whose columns include ``column``."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(f"{column}#" in line for line in plan.splitlines() if "Relation [" in line)


def test_number_of_scans_does_not_grow_with_the_rules(spark):
    from tidemark.operators.rule_table import compile_rules, failing_keys

    li, refs = table(spark, SF001, "lineitem"), {"orders": table(spark, SF001, "orders")}
    more = LINEITEM_RULES + [Rule("s1", "l_partkey", "unique"), Rule("s2", "l_suppkey", "unique", ("l_suppkey", "l_partkey"))]
    for rules in (LINEITEM_RULES, more):
        assert scans(flag_rows(li, rules, refs), "l_shipdate") == 1
        keys = failing_keys(li, compile_rules(li.schema, rules, refs), refs)
        assert scans(keys, "l_orderkey") == 1
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "l_extendedprice" not in plan


def test_one_evaluation_for_all_zones(spark):
    src = shared_dir(spark, "src")
    messy(spark).write.parquet(src)
    text = [("a", "k", "unique", None), ("e", "v", "in_set", '["x", "y", null]')]
    checked = check_table(spark.read.parquet(src), spark.createDataFrame(text, SCHEMA))
    for part in (checked.silver, checked.quarantine, checked.summary):
        assert src not in part._jdf.queryExecution().executedPlan().toString() and part.inputFiles()
        assert not any(src in f for f in part.inputFiles())
    assert rows(checked.silver) == [(7, "y")]
    assert checked.quarantine.count() == 9
    assert rows(checked.summary) == [("a", "unique", "k", 7, 10), ("e", "in_set", "v", 2, 10)]
    off = check_table(spark.read.parquet(src), spark.createDataFrame(text, SCHEMA), required=False)
    assert off.silver.count() == 10 and off.quarantine.count() == 0 and off.summary.count() == 0


def test_empty_table_and_hot_key(spark):
    empty = messy(spark).limit(0)
    assert rows(summarize(flag_rows(empty, RULES, parents(spark)), RULES)) == [
        (r.rule_id, r.check, r.column, 0, 0) for r in RULES]
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("k"), F.lit("x").alias("v"))
    rules = [Rule("u", "k", "unique"), Rule("w", "v", "referential", ("q", "name"))]
    assert rows(summarize(flag_rows(hot, rules, parents(spark)), rules)) == [("u", "unique", "k", 10000, 30000), ("w", "referential", "v", 0, 30000)]


def test_strict_gate_raises_for_a_blocked_source(spark):
    from tidemark.operators.quality import DriftError, enforce_gate

    gate = spark.createDataFrame([("a", "PASS"), ("b", "BLOCK"), ("c", "BLOCK")], "source_name string, status string")
    assert rows(enforce_gate(gate)) == [("b",), ("c",)]
    with pytest.raises(DriftError, match="'b'"):
        enforce_gate(gate, strict=True)
    assert enforce_gate(gate.filter("source_name = 'a'"), strict=True).count() == 0
