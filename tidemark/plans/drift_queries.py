"""Drift queries below the top level of records (Q1, Q2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.nested_drift import json_path_drift
from ..operators.quality import drifting_fields, gate_status
from .registry import register, table

# Fixed registry: the approved paths of every line feed and their JSON kinds.
LINE_PATHS = [("line", "object"), ("line.order", "number"), ("line.nr", "number"), ("price", "object"),
              ("price.amount", "number"), ("price.parts", "array"), ("price.parts[]", "object"),
              ("price.parts[].rate", "number"), ("price.parts[].name", "string"), ("marks", "array"), ("marks[]", "string")]
LINE_FEEDS = ["A", "N", "R"]


def nested_feed(spark, sf_dir):
    """Every line as a nested record with drift below the top: feed N names a note in one part of
    the price of first lines, feed R sends line numbers above 3 as text, feed A drops the amount
    of second lines, and first lines hold a number among their marks."""
    feed, nr = F.col("l_returnflag"), F.col("l_linenumber")

    def part(rate, name, note):
        return F.struct(F.col(rate).alias("rate"), F.lit(name).alias("name"), note.alias("note"))

    note = F.when((feed == "N") & (nr == 1), F.lit("gift"))
    price = F.struct(F.when((feed != "A") | (nr != 2), F.col("l_extendedprice")).alias("amount"),
                     F.array(part("l_tax", "tax", note), part("l_discount", "discount", F.lit(None).cast("string"))).alias("parts"))

    def record(number):  # absent fields are null here, and null fields aren't written
        return F.to_json(F.struct(F.struct(F.col("l_orderkey").alias("order"), number.alias("nr")).alias("line"),
                                  price.alias("price")))

    rest = F.when((feed == "R") & (nr > 3), record(nr.cast("string"))).otherwise(record(nr))
    marks = F.concat(F.lit('{"marks":["'), F.col("l_linestatus"), F.when(nr == 1, F.lit('",7],')).otherwise(F.lit('"],')))
    return table(spark, sf_dir, "lineitem").select(
        feed.alias("source_name"), F.concat(marks, F.substring(rest, F.lit(2), F.length(rest))).alias("record"))


def line_registry(spark):
    rows = [(s, f, k) for s in LINE_FEEDS for f, k in LINE_PATHS]
    return spark.createDataFrame(rows, "source_name string, field string, type string")


_REGISTRY_SQL = ", ".join(f"('{f}', '{k}')" for f, k in LINE_PATHS)
_NESTED_SQL = f"""
raw AS (
  SELECT l_returnflag AS source_name, json_merge_patch(json_object(
    'line', json_object('order', l_orderkey),
    'price', json_object('parts', json_array(
       CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN json_object('rate', l_tax, 'name', 'tax', 'note', 'gift')
            ELSE json_object('rate', l_tax, 'name', 'tax') END,
       json_object('rate', l_discount, 'name', 'discount'))),
    'marks', CASE WHEN l_linenumber = 1 THEN json_array(l_linestatus, 7) ELSE json_array(l_linestatus) END),
    CASE WHEN l_returnflag = 'R' AND l_linenumber > 3 THEN json_object('line', json_object('nr', CAST(l_linenumber AS VARCHAR)))
         ELSE json_object('line', json_object('nr', l_linenumber)) END,
    CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN json_object('line', json_object())
         ELSE json_object('price', json_object('amount', l_extendedprice)) END) AS record
  FROM lineitem),
reg AS (SELECT s.source_name, f.field, f.type FROM (VALUES ('A'), ('N'), ('R')) s(source_name),
        (VALUES {_REGISTRY_SQL}) f(field, type)),
obs AS (
  SELECT source_name, regexp_replace(substr(t.fullkey, 3), '\\[[0-9]+\\]', '[]', 'g') AS field,
         CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null'
                     WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS kind,
         count(*) AS n_records
  FROM raw, json_tree(raw.record) t WHERE t.fullkey <> '$' GROUP BY 1, 2, 3),
holders AS (SELECT source_name, field AS parent, n_records AS n FROM obs WHERE kind = 'object'
            UNION ALL SELECT source_name, '', count(*) FROM raw GROUP BY 1),
seen AS (SELECT source_name, field, sum(n_records) AS n_seen FROM obs GROUP BY 1, 2),
named AS (SELECT *, regexp_extract(field, '^(.*)\\.[^.]*$', 1) AS parent FROM reg WHERE field NOT LIKE '%[]'),
drift AS (
  SELECT o.source_name, o.field,
         CASE WHEN r.type IS NULL THEN 'new' WHEN r.type <> o.kind THEN 'retyped' ELSE 'ok' END AS kind,
         o.kind AS observed_type, r.type AS expected_type, CAST(o.n_records AS BIGINT) AS n_records
  FROM obs o LEFT JOIN reg r ON o.source_name = r.source_name AND o.field = r.field
  UNION ALL
  SELECT r.source_name, r.field, 'missing', CAST(NULL AS VARCHAR), r.type, CAST(h.n - coalesce(s.n_seen, 0) AS BIGINT)
  FROM named r JOIN holders h ON r.source_name = h.source_name AND r.parent = h.parent
  LEFT JOIN seen s ON r.source_name = s.source_name AND r.field = s.field
  WHERE h.n - coalesce(s.n_seen, 0) > 0)"""


@register("nested_drift", f"WITH {_NESTED_SQL} SELECT * FROM drift")
def q_nested_drift(spark, sf_dir):
    return json_path_drift(nested_feed(spark, sf_dir), "record", "source_name", line_registry(spark))


@register("drift_fields", f"""WITH {_NESTED_SQL},
gate AS (SELECT source_name, CAST(sum(CASE WHEN kind <> 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS n_drift_fields
         FROM drift GROUP BY source_name)
SELECT DISTINCT g.source_name, g.n_drift_fields, CASE WHEN g.n_drift_fields > 0 THEN 'BLOCK' ELSE 'PASS' END AS status,
       d.kind, d.field
FROM gate g LEFT JOIN drift d ON g.source_name = d.source_name AND d.kind <> 'ok'
""")
def q_drift_fields(spark, sf_dir):
    """The gate with the fields that block it as rows."""
    drift = json_path_drift(nested_feed(spark, sf_dir), "record", "source_name", line_registry(spark))
    return gate_status(drift).join(drifting_fields(drift), "source_name", "left")
