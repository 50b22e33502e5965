"""Schema drift, rule-driven validation and load audit.

Validation: every row-level rule becomes one boolean expression and all of
them run in a single projection (one scan, one codegen span); the summary of
row rules is one global aggregation with map-side partial sums. Set-level
rules need a shuffle each: ``unique`` is a grouped count (partial aggregation
collapses a hot key before the shuffle) joined back on the key, and
``referential`` is a join against the distinct parent keys; both joins keep
the big side streamed so AQE can split a hot key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .keys import equal, with_join_keys

ROW_CHECKS = ("not_null", "in_set", "range", "regex")
SET_CHECKS = ("unique", "referential")


@dataclass(frozen=True)
class Rule:
    """One validation rule (F13): ``check`` in not_null, in_set, range, regex,
    unique, referential. ``argument``: the set, ``(min, max)``, the pattern,
    the key columns (unique) or ``(ref_name, ref_column)`` (referential)."""

    rule_id: str
    column: str
    check: str
    argument: object = None


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def failing(rule: Rule) -> Column:
    """True when a row breaks a row-level rule; nulls fail only ``not_null``."""
    c = _c(rule.column)
    if rule.check == "not_null":
        return c.isNull()
    if rule.check == "in_set":
        return c.isNotNull() & ~c.isin(list(rule.argument))
    if rule.check == "range":
        lo, hi = rule.argument
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (c < F.lit(lo))
        if hi is not None:
            cond = cond | (c > F.lit(hi))
        return c.isNotNull() & cond
    if rule.check == "regex":
        return c.isNotNull() & ~c.cast(StringType()).rlike(str(rule.argument))
    raise ValueError(f"not a row-level check: {rule.check}")


def _key_cols(rule: Rule) -> list[str]:
    if rule.argument:
        return [rule.argument] if isinstance(rule.argument, str) else list(rule.argument)
    return [rule.column]


def check_rules(rules: Sequence[Rule]) -> None:
    """Refuse an unknown check and a rule id that is given twice."""
    seen: set[str] = set()
    for r in rules:
        if r.check not in ROW_CHECKS + SET_CHECKS:
            raise ValueError(f"rule {r.rule_id}: unknown check {r.check!r}")
        if r.rule_id in seen:
            raise ValueError(f"rule id {r.rule_id} is given twice")
        seen.add(r.rule_id)


def _parent_keys(r: Rule, refs: dict[str, DataFrame]) -> DataFrame:
    ref_name, ref_col = r.argument
    return refs[ref_name].select(_c(ref_col).alias("__ref")).distinct()


def _set_flags(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame]) -> tuple[DataFrame, list]:
    """Add one boolean column per set-level rule.

    Each rule has its own narrow frame of *failing* keys: the keys counted more
    than once (``unique``), or the values the parent lacks (``referential``).
    Both are grouped first, so a hot key or value collapses map-side. Rows of
    rules on the same columns meet their frames in one join; the frame reaches
    it through its own exchange, so AQE can split a hot key on the row side, or
    broadcast the frame when few keys fail.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    original, out, flags = df.columns, df, []
    by_keys: dict[tuple[str, ...], list[tuple[Rule, str]]] = {}
    for i, r in enumerate(rules):
        ks = tuple(sorted(_key_cols(r))) if r.check == "unique" else (r.column,)
        by_keys.setdefault(ks, []).append((r, f"__fail{i}"))
    for n, (ks, group) in enumerate(by_keys.items()):
        kf = df.groupBy(*[_c(k) for k in ks]).agg(F.count(F.lit(1)).alias("__n"))
        for r, flag in group:
            if r.check == "unique":
                kf = kf.withColumn(flag, F.col("__n") > 1)
            else:
                kf = (kf.join(_parent_keys(r, refs), _c(r.column) == F.col("__ref"), "left")
                      .withColumn(flag, _c(r.column).isNotNull() & F.col("__ref").isNull()).drop("__ref"))
        bad = reduce(lambda x, y: x | y, [F.col(f) for _, f in group])
        alias = [f"__kf{n}_{i}" for i in range(len(ks))]
        ktypes = [types[k] for k in ks]
        probe = kf.filter(bad).select([_c(k).alias(a) for k, a in zip(ks, alias)] + [F.col(f) for _, f in group])
        probe_k, probe_names = with_join_keys(probe, alias, ktypes, f"__pq{n}_")
        # an exchange of its own on the join columns keeps the join splittable (see .keys)
        rows_k, row_names = with_join_keys(out, ks, ktypes, f"__rq{n}_")
        out = (rows_k.join(probe_k, equal(row_names, probe_names), "left")
               .select(*[_c(c) for c in original], *[F.col(f) for _, f in flags],
                       *[F.coalesce(F.col(f), F.lit(False)).alias(f) for _, f in group]))
        flags += group
    return out, [(r, F.col(f)) for r, f in flags]


def validate(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` plus ``failed_rules``: ids of broken rules in rule order, '' if none (Q4)."""
    check_rules(rules)
    refs = refs or {}
    original = df.columns
    row_rules = [(r, failing(r)) for r in rules if r.check in ROW_CHECKS]
    df, set_rules = _set_flags(df, [r for r in rules if r.check in SET_CHECKS], refs)
    all_rules = {r.rule_id: cond for r, cond in row_rules + set_rules}
    ordered = [F.when(all_rules[r.rule_id], F.lit(r.rule_id)) for r in rules if r.rule_id in all_rules]
    failed = F.concat_ws(",", *ordered) if ordered else F.lit("")
    return df.select(*[_c(c) for c in original], failed.alias("failed_rules"))


def split_valid(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame] | None = None,
                required: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons); ``required=False`` skips checks (Q5)."""
    if not required:
        empty = df.limit(0).withColumn("failed_rules", F.lit(""))
        return df, empty
    checked = validate(df, rules, refs)
    ok = checked.filter(F.col("failed_rules") == "").drop("failed_rules")
    bad = checked.filter(F.col("failed_rules") != "")
    return ok, bad


SUMMARY_SCHEMA = StructType([
    StructField("rule_id", StringType()), StructField("rule_check", StringType()),
    StructField("column_name", StringType()), StructField("n_failed", LongType()),
    StructField("n_rows", LongType())])


def dq_summary(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Failed-row count per rule (Q4). Row rules: one scan, one aggregation. An empty
    table gives zeros; no rules give no rows."""
    check_rules(rules)
    if not rules:
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    refs = refs or {}
    parts = []
    row_rules = [r for r in rules if r.check in ROW_CHECKS]
    if row_rules:
        aggs = [F.count(F.lit(1)).alias("n_rows")] + [
            F.sum(F.when(failing(r), 1).otherwise(0)).cast(LongType()).alias(f"f{i}") for i, r in enumerate(row_rules)]
        wide = df.agg(*aggs)
        per_rule = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.check).alias("rule_check"),
                                      F.lit(r.column).alias("column_name"), F.col(f"f{i}").alias("n_failed"))
                             for i, r in enumerate(row_rules)])
        parts.append(wide.select(F.inline(per_rule), "n_rows"))
    for r in rules:
        if r.check == "unique":
            keys = _key_cols(r)
            g = df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
            part = g.agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast(LongType()).alias("n_failed"),
                         F.sum("n").cast(LongType()).alias("n_rows"))
        elif r.check == "referential":
            parent = _parent_keys(r, refs)
            # count per value first: a hot value is one row before it meets the parent keys
            per_value = df.groupBy(_c(r.column).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
            j = per_value.join(parent, F.col("__v") == F.col("__ref"), "left")
            part = j.agg(
                F.sum(F.when(F.col("__v").isNotNull() & F.col("__ref").isNull(), F.col("__n")).otherwise(0))
                 .cast(LongType()).alias("n_failed"),
                F.sum("__n").cast(LongType()).alias("n_rows"))
        else:
            continue
        parts.append(part.select(F.lit(r.rule_id).alias("rule_id"), F.lit(r.check).alias("rule_check"),
                                 F.lit(r.column).alias("column_name"), "n_failed", "n_rows"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select([(F.coalesce(F.col(f.name), F.lit(0)) if f.name.startswith("n_") else F.col(f.name))
                       .cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])


def dq_rejects(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows breaking at least one rule, with the rule ids (Q4)."""
    return validate(df, rules, refs).filter(F.col("failed_rules") != "")


# ---------------------------------------------------------------- schema drift

DRIFT_SCHEMA = StructType([
    StructField("source_name", StringType()), StructField("field", StringType()),
    StructField("kind", StringType()), StructField("observed_type", StringType()),
    StructField("expected_type", StringType()), StructField("n_records", LongType())])


def json_value_kind(value: Column) -> Column:
    """JSON kind of a VARIANT value: string, number, boolean, null, object or array."""
    t = F.schema_of_variant(value)
    return (F.when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(t == "VOID", "null")
             .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
             .otherwise("number"))


def observed_fields(raw: DataFrame, json_col: str, source_col: str) -> DataFrame:
    """(source, field, kind, records) over every record of a raw JSON feed.

    Each record is parsed once into ``map<string, variant>`` (top-level fields
    with their values' types), exploded and counted; the count runs as a
    partial aggregation before the shuffle.
    """
    fields = raw.select(_c(source_col).alias("source_name"),
                        F.explode(F.from_json(_c(json_col), "map<string,variant>")).alias("field", "value"))
    return (fields.select("source_name", "field", json_value_kind(F.col("value")).alias("kind"))
            .groupBy("source_name", "field", "kind").agg(F.count(F.lit(1)).alias("n_records")))


def json_field_drift(raw: DataFrame, json_col: str, source_col: str, registry: DataFrame) -> DataFrame:
    """Drift of a raw JSON feed against the approved registry (Q1).

    ``registry``: ``source_name, field, type`` (JSON kinds). Output rows:
    ``new`` (field not registered), ``retyped`` (kind differs), ``ok``, and
    ``missing`` with the number of records lacking a registered field.
    """
    obs = observed_fields(raw, json_col, source_col)
    totals = raw.groupBy(_c(source_col).alias("source_name")).agg(F.count(F.lit(1)).alias("n_total"))
    reg = registry.select("source_name", "field", F.col("type").alias("expected_type"))
    j = obs.join(reg, ["source_name", "field"], "left")
    present = j.select(
        "source_name", "field",
        F.when(F.col("expected_type").isNull(), "new")
         .when(F.col("expected_type") != F.col("kind"), "retyped").otherwise("ok").alias("kind"),
        F.col("kind").alias("observed_type"), "expected_type", "n_records")
    seen = obs.groupBy("source_name", "field").agg(F.sum("n_records").alias("n_seen"))
    missing = (reg.join(totals, "source_name").join(seen, ["source_name", "field"], "left")
               .withColumn("n_missing", F.col("n_total") - F.coalesce(F.col("n_seen"), F.lit(0)))
               .filter(F.col("n_missing") > 0)
               .select("source_name", "field", F.lit("missing").alias("kind"),
                       F.lit(None).cast(StringType()).alias("observed_type"), "expected_type",
                       F.col("n_missing").alias("n_records")))
    out = present.unionByName(missing)
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in DRIFT_SCHEMA.fields])


def schema_drift(spark: SparkSession, observed: DataFrame, registry: DataFrame) -> DataFrame:
    """Drift of DataFrame schemas (Q1): both sides as ``table_name, column_name, type``.

    Names compare case-insensitively (Spark's resolver). Kinds: new, missing,
    retyped.
    """
    o = observed.select("table_name", F.lower("column_name").alias("lc"), F.col("column_name").alias("o_name"),
                        F.col("type").alias("observed_type"))
    r = registry.select("table_name", F.lower("column_name").alias("lc"), F.col("column_name").alias("r_name"),
                        F.col("type").alias("expected_type"))
    j = o.join(r, ["table_name", "lc"], "full")
    kind = (F.when(F.col("expected_type").isNull(), "new").when(F.col("observed_type").isNull(), "missing")
             .when(F.lower("observed_type") != F.lower("expected_type"), "retyped"))
    return (j.select("table_name", F.coalesce("o_name", "r_name").alias("column_name"), kind.alias("kind"),
                     "observed_type", "expected_type").filter(F.col("kind").isNotNull()))


def frame_schema_rows(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, type`` rows of a few frames' schemas."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in frames.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string")


def drift_gate(drift: DataFrame, block_kinds: Sequence[str] = ("new", "missing", "retyped")) -> DataFrame:
    """Per source: PASS, or BLOCK silver with the drifting fields (Q2).

    Bronze always lands; the gate only decides whether silver is loaded. The
    list names every drifting field of a source once, in one string as in the
    oracle; a feed whose keys come from the data makes that string as long.
    """
    named = drifting_fields(drift, block_kinds).groupBy("source_name").agg(
        F.concat_ws(",", F.array_sort(F.collect_list(F.concat("kind", F.lit(":"), "field")))).alias("drift"))
    joined = gate_status(drift, block_kinds).join(named, "source_name", "left")
    return joined.select("source_name", "n_drift_fields", F.coalesce("drift", F.lit("")).alias("drift"), "status")


def drifting_fields(drift: DataFrame, block_kinds: Sequence[str] = ("new", "missing", "retyped")) -> DataFrame:
    """The drifting fields as rows ``source_name, kind, field`` (Q2), however many a source has."""
    return drift.filter(F.col("kind").isin(list(block_kinds))).select("source_name", "kind", "field").distinct()


def gate_status(drift: DataFrame, block_kinds: Sequence[str] = ("new", "missing", "retyped")) -> DataFrame:
    """Per source the number of drift rows, and PASS or BLOCK (Q2): one small row a source."""
    bad = F.col("kind").isin(list(block_kinds))
    counted = drift.groupBy("source_name").agg(F.sum(F.when(bad, 1).otherwise(0)).cast(LongType()).alias("n_drift_fields"))
    return counted.withColumn("status", F.when(F.col("n_drift_fields") > 0, "BLOCK").otherwise("PASS"))


def apply_gate(df: DataFrame, gate: DataFrame, source_col: str = "source_name") -> tuple[DataFrame, DataFrame]:
    """Split bronze rows by the gate (Q2): (rows of passing sources -> silver,
    rows of blocked sources -> quarantine). Bronze itself always lands."""
    from .joins import semi_by_values

    blocked = gate.filter(F.col("status") == "BLOCK").select("source_name")
    return (semi_by_values(df, source_col, blocked, "source_name", anti=True),
            semi_by_values(df, source_col, blocked, "source_name"))


class DriftError(RuntimeError):
    """Raised by :func:`enforce_gate` in strict mode."""


def enforce_gate(gate: DataFrame, strict: bool = False) -> DataFrame:
    """The blocked sources, one row each. ``strict`` raises if there is any (one job)."""
    blocked = gate.filter(F.col("status") == "BLOCK").select("source_name")
    if strict and (first := blocked.orderBy("source_name").first()) is not None:
        raise DriftError(f"schema drift blocks silver for {first['source_name']!r} (and perhaps others)")
    return blocked


# ---------------------------------------------------------------- audit

AUDIT_SCHEMA = StructType([
    StructField("run_id", StringType()), StructField("source_name", StringType()),
    StructField("object_name", StringType()), StructField("status", StringType()),
    StructField("rows_loaded", LongType()), StructField("error_message", StringType()),
    StructField("logged_at", StringType())])


def audit_row(spark: SparkSession, run_id: str, source_name: str, object_name: str, status: str,
              rows_loaded: int | None, error_message: str | None = None,
              logged_at: dt.datetime | None = None) -> DataFrame:
    """One audit record per load (Q6); append it to the audit table."""
    at = (logged_at or dt.datetime.now(dt.timezone.utc)).isoformat()
    return spark.createDataFrame([(run_id, source_name, object_name, status,
                                   None if rows_loaded is None else int(rows_loaded), error_message, at)],
                                 AUDIT_SCHEMA)


def audit_summary(log: DataFrame) -> DataFrame:
    """Runs, rows and failures per source and status."""
    return log.groupBy("source_name", "status").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(F.coalesce(F.col("rows_loaded"), F.lit(0))).cast(LongType()).alias("rows_loaded"),
        F.sum(F.when(F.col("error_message").isNotNull(), 1).otherwise(0)).cast(LongType()).alias("n_errors"),
        F.max("logged_at").alias("last_logged_at"))


def failure_alerts(log: DataFrame, failed: str = "FAILED") -> DataFrame:
    """Alert rows for failed loads (Q7)."""
    return log.filter(F.upper(F.col("status")) == failed).select(
        "run_id", "source_name", "object_name",
        F.concat(F.lit("load failed: "), F.col("source_name"), F.lit(" "), F.col("object_name"),
                 F.lit(": "), F.coalesce(F.col("error_message"), F.lit("unknown"))).alias("alert"))
