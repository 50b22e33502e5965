"""Validation, drift and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pyspark.sql.types import DoubleType, StructField, StructType, TimestampNTZType

from ..operators.mapping import mapping_audit
from ..operators.merge import duplicate_keys
from ..operators.quality import observed_fields
from ..operators.rule_table import check_table, flag_rows, load_rules, rejected, summarize
from ..sources.spec import spec_from_dict
from ..operators.quality import (
    Rule,
    audit_summary,
    dq_rejects,
    dq_summary,
    drift_gate,
    enforce_gate,
    failure_alerts,
    gate_status,
    json_field_drift,
)
from .registry import ORACLE, register, table

# Fixed rule set for lineitem (rule id, column, check, argument).
LINEITEM_RULES = [
    Rule("r1", "l_orderkey", "not_null"),
    Rule("r2", "l_quantity", "range", (1, 45)),
    Rule("r3", "l_returnflag", "in_set", ("A", "N")),
    Rule("r4", "l_linestatus", "regex", "^[OF]$"),
    Rule("r5", "l_discount", "range", (0.0, 0.08)),
    Rule("r6", "l_orderkey", "unique", ("l_orderkey", "l_linenumber")),
    Rule("r7", "l_orderkey", "referential", ("orders", "o_orderkey")),
]


def _inputs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem"), {"orders": table(spark, sf_dir, "orders")}


@register("dq_summary", """
SELECT 'r1' AS rule_id, 'not_null' AS rule_check, 'l_orderkey' AS column_name,
       CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS n_failed, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'r2', 'range', 'l_quantity',
       CAST(count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 45) AS BIGINT), count(*) FROM lineitem
UNION ALL SELECT 'r3', 'in_set', 'l_returnflag',
       CAST(count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS BIGINT), count(*) FROM lineitem
UNION ALL SELECT 'r4', 'regex', 'l_linestatus',
       CAST(count(*) FILTER (WHERE NOT regexp_matches(l_linestatus, '^[OF]$')) AS BIGINT), count(*) FROM lineitem
UNION ALL SELECT 'r5', 'range', 'l_discount',
       CAST(count(*) FILTER (WHERE l_discount < 0.0::DOUBLE OR l_discount > 0.08::DOUBLE) AS BIGINT), count(*)
       FROM lineitem
UNION ALL SELECT 'r6', 'unique', 'l_orderkey', CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT),
       CAST(sum(n) AS BIGINT)
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g
UNION ALL SELECT 'r7', 'referential', 'l_orderkey',
       CAST(count(*) FILTER (WHERE l_orderkey IS NOT NULL AND o.o_orderkey IS NULL) AS BIGINT), count(*)
       FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) o ON l_orderkey = o.o_orderkey
""")
def q_dq_summary(spark, sf_dir):
    li, refs = _inputs(spark, sf_dir)
    return dq_summary(li, LINEITEM_RULES, refs)


@register("dq_rejects", """
WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1),
o AS (SELECT DISTINCT o_orderkey FROM orders),
v AS (
  SELECT l.*, concat_ws(',',
    CASE WHEN l.l_orderkey IS NULL THEN 'r1' END,
    CASE WHEN l.l_quantity < 1 OR l.l_quantity > 45 THEN 'r2' END,
    CASE WHEN l.l_returnflag NOT IN ('A', 'N') THEN 'r3' END,
    CASE WHEN NOT regexp_matches(l.l_linestatus, '^[OF]$') THEN 'r4' END,
    CASE WHEN l.l_discount < 0.0::DOUBLE OR l.l_discount > 0.08::DOUBLE THEN 'r5' END,
    CASE WHEN d.l_orderkey IS NOT NULL THEN 'r6' END,
    CASE WHEN l.l_orderkey IS NOT NULL AND o.o_orderkey IS NULL THEN 'r7' END) AS failed_rules
  FROM lineitem l
  LEFT JOIN d ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
  LEFT JOIN o ON l.l_orderkey = o.o_orderkey)
SELECT * FROM v WHERE failed_rules <> ''
""")
def q_dq_rejects(spark, sf_dir):
    li, refs = _inputs(spark, sf_dir)
    return dq_rejects(li, LINEITEM_RULES, refs)


# The same rules as rows of a rules table, with those of another table beside them.
RULE_ROWS = [
    ("lineitem", "r1", "l_orderkey", "not_null", None),
    ("lineitem", "r2", "l_quantity", "range", '{"min": 1, "max": 45}'),
    ("lineitem", "r3", "l_returnflag", "in_set", '["A", "N"]'),
    ("lineitem", "r4", "l_linestatus", "regex", '"^[OF]$"'),
    ("lineitem", "r5", "l_discount", "range", '{"min": 0.0, "max": 0.08}'),
    ("lineitem", "r6", "l_orderkey", "unique", '["l_orderkey", "l_linenumber"]'),
    ("lineitem", "r7", "l_orderkey", "referential", '{"table": "orders", "column": "o_orderkey"}'),
    ("orders", "o1", "o_custkey", "not_null", None),
]


def rules_frame(spark):
    return spark.createDataFrame(RULE_ROWS, "table_name string, rule_id string, column_name string, check string, argument string")


@register("dq_rules_summary", ORACLE["dq_summary"])
def q_dq_rules_summary(spark, sf_dir):
    li, refs = _inputs(spark, sf_dir)
    rules = load_rules(rules_frame(spark), "lineitem")
    return summarize(flag_rows(li, rules, refs), rules)


@register("dq_rules_rejects", ORACLE["dq_rejects"])
def q_dq_rules_rejects(spark, sf_dir):
    li, refs = _inputs(spark, sf_dir)
    return rejected(flag_rows(li, load_rules(rules_frame(spark), "lineitem"), refs))


@register("dq_rules_zones", ORACLE["dq_rejects"].replace("SELECT * FROM v WHERE failed_rules <> ''", """
SELECT CASE WHEN failed_rules = '' THEN 'silver' ELSE 'quarantine' END AS zone, l_returnflag, count(*) AS n_rows,
       CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM v GROUP BY ALL"""))
def q_dq_rules_zones(spark, sf_dir):
    """Silver and quarantine from one staged evaluation of the rules table."""
    li, refs = _inputs(spark, sf_dir)
    checked = check_table(li, rules_frame(spark), refs, "lineitem")
    zones = [(checked.silver, "silver"), (checked.quarantine, "quarantine")]
    parts = [df.groupBy(F.lit(zone).alias("zone"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_linenumber").cast(LongType()).alias("lines")) for df, zone in zones]
    return parts[0].unionAll(parts[1])


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# Fixed registry: the approved fields of every event feed and their JSON kinds.
FEED_FIELDS = [("event_id", "number"), ("ts", "string"), ("user_id", "number"), ("value", "number")]
FEEDS = ["click", "error", "purchase", "signup", "view"]


def raw_feed(spark, sf_dir):
    """Raw JSON records of the event feeds with upstream drift: purchase drops
    ``value``, signup adds ``coupon``, error sends ``value`` as text."""
    ev = table(spark, sf_dir, "events")
    t = F.col("event_type")
    base = [F.col("event_id"), F.col("ts"), F.col("user_id")]
    rec = (F.when(t == "purchase", F.to_json(F.struct(*base)))
            .when(t == "signup", F.to_json(F.struct(*base, F.col("value"),
                                                    F.concat(F.lit("C"), F.col("user_id")).alias("coupon"))))
            .when(t == "error", F.to_json(F.struct(*base, F.col("value").cast("string").alias("value"))))
            .otherwise(F.to_json(F.struct(*base, F.col("value")))))
    return ev.select(t.alias("source_name"), rec.alias("record"))


def registry_frame(spark):
    rows = [(s, f, k) for s in FEEDS for f, k in FEED_FIELDS]
    return spark.createDataFrame(rows, "source_name string, field string, type string")


_RAW_FEED_SQL = """
raw AS (
  SELECT event_type AS source_name,
         CASE WHEN event_type = 'purchase' THEN json_object('event_id', event_id, 'ts', ts, 'user_id', user_id)
              WHEN event_type = 'signup' THEN json_object('event_id', event_id, 'ts', ts, 'user_id', user_id,
                                                          'value', value, 'coupon', 'C' || CAST(user_id AS VARCHAR))
              WHEN event_type = 'error' THEN json_object('event_id', event_id, 'ts', ts, 'user_id', user_id,
                                                         'value', CAST(value AS VARCHAR))
              ELSE json_object('event_id', event_id, 'ts', ts, 'user_id', user_id, 'value', value) END AS record
  FROM events)"""
_DRIFT_SQL = _RAW_FEED_SQL + """,
reg AS (
  SELECT s.source_name, f.field, f.type
  FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) s(source_name),
       (VALUES ('event_id', 'number'), ('ts', 'string'), ('user_id', 'number'), ('value', 'number')) f(field, type)),
keyed AS (SELECT source_name, record, unnest(json_keys(record)) AS field FROM raw),
obs AS (
  SELECT source_name, field,
         CASE json_type(record, '$.' || field)
           WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null'
           WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS kind,
         count(*) AS n_records
  FROM keyed GROUP BY 1, 2, 3),
totals AS (SELECT source_name, count(*) AS n_total FROM raw GROUP BY 1),
seen AS (SELECT source_name, field, sum(n_records) AS n_seen FROM obs GROUP BY 1, 2),
drift AS (
  SELECT o.source_name, o.field,
         CASE WHEN r.type IS NULL THEN 'new' WHEN r.type <> o.kind THEN 'retyped' ELSE 'ok' END AS kind,
         o.kind AS observed_type, r.type AS expected_type, CAST(o.n_records AS BIGINT) AS n_records
  FROM obs o LEFT JOIN reg r ON o.source_name = r.source_name AND o.field = r.field
  UNION ALL
  SELECT r.source_name, r.field, 'missing', CAST(NULL AS VARCHAR), r.type,
         CAST(t.n_total - coalesce(s.n_seen, 0) AS BIGINT)
  FROM reg r JOIN totals t ON r.source_name = t.source_name
  LEFT JOIN seen s ON r.source_name = s.source_name AND r.field = s.field
  WHERE t.n_total - coalesce(s.n_seen, 0) > 0)"""


@register("schema_drift", f"WITH {_DRIFT_SQL} SELECT * FROM drift")
def q_schema_drift(spark, sf_dir):
    return json_field_drift(raw_feed(spark, sf_dir), "record", "source_name", registry_frame(spark))


@register("drift_gate", f"""WITH {_DRIFT_SQL}
SELECT source_name,
       CAST(sum(CASE WHEN kind IN ('new', 'missing', 'retyped') THEN 1 ELSE 0 END) AS BIGINT) AS n_drift_fields,
       coalesce(array_to_string(list_sort(list_distinct(
         list(kind || ':' || field) FILTER (WHERE kind IN ('new', 'missing', 'retyped')))), ','), '') AS drift,
       CASE WHEN sum(CASE WHEN kind IN ('new', 'missing', 'retyped') THEN 1 ELSE 0 END) > 0
            THEN 'BLOCK' ELSE 'PASS' END AS status
FROM drift GROUP BY source_name""")
def q_drift_gate(spark, sf_dir):
    return drift_gate(json_field_drift(raw_feed(spark, sf_dir), "record", "source_name", registry_frame(spark)))


@register("gate_blocked", f"""WITH {_DRIFT_SQL}
SELECT DISTINCT source_name FROM drift WHERE kind IN ('new', 'retyped')""")
def q_gate_blocked(spark, sf_dir):
    """Sources whose new or retyped fields keep them from silver; missing fields don't."""
    drift = json_field_drift(raw_feed(spark, sf_dir), "record", "source_name", registry_frame(spark))
    return enforce_gate(gate_status(drift, ("new", "retyped")))


def run_log(spark, sf_dir):
    """Audit log (F10) derived from events: one load run per event."""
    ev = table(spark, sf_dir, "events")
    failed = F.col("value") < 5
    return ev.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("source_name"),
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd")).alias("object_name"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.lit(0).cast(LongType())).otherwise(F.floor(F.col("value") * 100).cast(LongType()))
         .alias("rows_loaded"),
        F.when(failed, F.lit("timeout")).alias("error_message"),
        F.col("ts").alias("logged_at"))


@register("audit_summary", """
WITH log AS (
  SELECT event_type AS source_name, CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN value < 5 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS rows_loaded,
         CASE WHEN value < 5 THEN 'timeout' END AS error_message, ts AS logged_at
  FROM events)
SELECT source_name, status, count(*) AS n_runs, CAST(sum(coalesce(rows_loaded, 0)) AS BIGINT) AS rows_loaded,
       CAST(sum(CASE WHEN error_message IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_errors,
       max(logged_at) AS last_logged_at
FROM log GROUP BY source_name, status
""")
def q_audit_summary(spark, sf_dir):
    return audit_summary(run_log(spark, sf_dir))


@register("failure_alerts", """
SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS source_name,
       'events_' || strftime(ts, '%Y%m%d') AS object_name,
       'load failed: ' || event_type || ' events_' || strftime(ts, '%Y%m%d') || ': timeout' AS alert
FROM events WHERE value < 5
""")
def q_failure_alerts(spark, sf_dir):
    return failure_alerts(run_log(spark, sf_dir))


# Fixed spec of every JSON feed (their columns are only known from the records) and the
# contract they load into. The coupon column is in no record, its target in no contract.
FEEDS = ("click", "error", "purchase", "signup", "view")
FEED_SPEC = {feed: {"type": "sale", "schema": "sdm", "tablename": "sale_std", "relational": "False", "mapping": [
    {"source_column": "event_id", "target_column": "sale.SaleId", "source_key": "event_id", "target_key": "SaleId"},
    {"source_column": "ts", "target_column": "sale.SoldAt", "source_key": "event_id", "target_key": "SaleId"},
    {"source_column": "value", "target_column": "sale.Amount", "source_key": "event_id", "target_key": "SaleId"},
    {"source_column": "coupon", "target_column": "sale.Coupon", "source_key": "event_id", "target_key": "SaleId"},
]} for feed in FEEDS}
SALE_CONTRACT = StructType([StructField("SaleId", LongType()), StructField("SoldAt", TimestampNTZType()),
                            StructField("Amount", DoubleType())])


@register("mapping_audit", f"""WITH {_RAW_FEED_SQL},
seen AS (SELECT DISTINCT source_name, unnest(json_keys(record)) AS field FROM raw),
spec AS (SELECT f.source, m.* FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) f(source),
         (VALUES ('event_id', 'SaleId'), ('ts', 'SoldAt'), ('value', 'Amount'), ('coupon', 'Coupon'))
         m(source_column, target_column))
SELECT source, 'missing_source' AS kind, source_column AS "column" FROM spec
WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.source_name = spec.source AND seen.field = spec.source_column)
UNION
SELECT source, 'missing_target', target_column FROM spec
WHERE lower(target_column) NOT IN ('saleid', 'soldat', 'amount')""")
def q_mapping_audit(spark, sf_dir):
    """Spec source columns never seen in any record of their feed, and spec targets the
    contract lacks (A3)."""
    seen = (observed_fields(raw_feed(spark, sf_dir), "record", "source_name")
            .select(F.col("source_name").alias("source_table"), F.col("field").alias("column")).distinct())
    return mapping_audit(spark, spec_from_dict(spark, FEED_SPEC), seen, SALE_CONTRACT)
