"""SCD2 queries (H1-H6). Dimension and source both derive from every customer.

Dimension: every customer open since 2024-01-01 (city = market segment, null
for every 11th key, band from the balance); every 4th key also carries an
older closed version. Source: every customer (every 10th twice, every 13th
without a key), every 6th key re-keyed to a new
negative key, city 'MOVED' for every 5th key and null for every 7th, band
'VIP' for every 9th. Applied as of 2024-06-01.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..operators.history import as_of_view, current_view, merged_versions, scd2_apply, scd2_expire, scd2_insert, scd2_new_rows, scd2_store
from ..session import shared_dir
from ..sinks.snapshots import SnapshotTable
from .registry import register, table

AS_OF = "2024-06-01"


def dimension(spark, sf_dir, with_band: bool = False):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    city = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    band = F.when(F.col("c_acctbal") > 5000, F.lit("HIGH")).otherwise(F.lit("LOW"))
    cur = [k.alias("customer_id"), city.alias("city")] + ([band.alias("band")] if with_band else []) + [
        F.lit("2024-01-01").cast(DateType()).alias("start_date"),
        F.lit(None).cast(DateType()).alias("end_date"), F.lit(True).alias("is_current")]
    old = [k.alias("customer_id"), F.lit("OLDCITY").alias("city")] + (
        [F.lit("LOW").alias("band")] if with_band else []) + [
        F.lit("2023-01-01").cast(DateType()).alias("start_date"),
        F.lit("2024-01-01").cast(DateType()).alias("end_date"), F.lit(False).alias("is_current")]
    versions = F.when(k % 4 == 0, F.array(F.struct(*cur), F.struct(*old))).otherwise(F.array(F.struct(*cur)))
    return c.select(F.inline(versions))


def source(spark, sf_dir, with_band: bool = False):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    cols = [F.when(k % 13 == 12, F.lit(None)).when(k % 6 == 5, -k).otherwise(k).alias("customer_id"),
            F.when(k % 5 == 0, F.lit("MOVED")).when(k % 7 == 0, F.lit(None).cast("string"))
             .otherwise(F.col("c_mktsegment")).alias("city")]
    if with_band:
        cols.append(F.when(k % 9 == 0, F.lit("VIP"))
                    .when(F.col("c_acctbal") > 5000, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("band"))
    # every 10th row comes twice, every 13th has no key
    return c.withColumn("twice", F.explode(F.when(k % 10 == 9, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select(cols)


def _sql_inputs(with_band: bool) -> str:
    b_dim = ", CASE WHEN c_acctbal > 5000 THEN 'HIGH' ELSE 'LOW' END AS band" if with_band else ""
    b_old = ", 'LOW' AS band" if with_band else ""
    b_src = (", CASE WHEN c_custkey % 9 = 0 THEN 'VIP' WHEN c_acctbal > 5000 THEN 'HIGH' ELSE 'LOW' END AS band"
             if with_band else "")
    return f"""
dim AS (
  SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS city{b_dim},
         DATE '2024-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current
  FROM customer
  UNION ALL
  SELECT c_custkey, 'OLDCITY'{b_old}, DATE '2023-01-01', DATE '2024-01-01', false
  FROM customer WHERE c_custkey % 4 = 0),
src AS (
  SELECT CASE WHEN c_custkey % 13 = 12 THEN NULL WHEN c_custkey % 6 = 5 THEN -c_custkey ELSE c_custkey END AS customer_id,
         CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS city
         {b_src}
  FROM customer, (VALUES (1), (2)) v(copy)
  WHERE copy = 1 OR (c_custkey % 10 = 9 AND c_custkey % 13 = 12)),
cur AS (SELECT * FROM dim WHERE is_current)"""


def _changed(with_band: bool) -> str:
    c = "t.city IS DISTINCT FROM s.city"
    return f"({c} OR t.band IS DISTINCT FROM s.band)" if with_band else c


def _expired_sql(with_band: bool) -> str:
    band = "t.band, " if with_band else ""
    chg = _changed(with_band)
    return f"""
expired AS (
  SELECT t.customer_id, t.city, {band}t.start_date,
         CASE WHEN s.customer_id IS NOT NULL AND {chg} THEN DATE '{AS_OF}' ELSE t.end_date END AS end_date,
         CASE WHEN s.customer_id IS NOT NULL AND {chg} THEN false ELSE t.is_current END AS is_current
  FROM cur t LEFT JOIN src s ON t.customer_id = s.customer_id)"""


def _new_sql(with_band: bool) -> str:
    band = "s.band, " if with_band else ""
    return f"""
new_rows AS (
  SELECT s.customer_id, s.city, {band}DATE '{AS_OF}' AS start_date, CAST(NULL AS DATE) AS end_date,
         true AS is_current
  FROM src s LEFT JOIN cur t ON s.customer_id = t.customer_id
  WHERE t.customer_id IS NULL OR {_changed(with_band)})"""


def _full_sql(with_band: bool) -> str:
    return f"""WITH {_sql_inputs(with_band)}, {_expired_sql(with_band)}, {_new_sql(with_band)}
SELECT * FROM dim WHERE NOT is_current
UNION ALL SELECT * FROM expired
UNION ALL SELECT * FROM new_rows"""


@register("scd2_expire", f"""WITH {_sql_inputs(False)}, {_expired_sql(False)}
SELECT * FROM dim WHERE NOT is_current UNION ALL SELECT * FROM expired""")
def q_scd2_expire(spark, sf_dir):
    return scd2_expire(dimension(spark, sf_dir), source(spark, sf_dir), ["customer_id"], ["city"], AS_OF)


@register("scd2_new_rows", f"""WITH {_sql_inputs(False)}, {_new_sql(False)}
SELECT * FROM new_rows""")
def q_scd2_new_rows(spark, sf_dir):
    return scd2_new_rows(dimension(spark, sf_dir), source(spark, sf_dir), ["customer_id"], ["city"], AS_OF)


@register("scd2_full", _full_sql(False))
def q_scd2_full(spark, sf_dir):
    return scd2_apply(dimension(spark, sf_dir), source(spark, sf_dir), ["customer_id"], ["city"], AS_OF)


@register("scd2_multi_attr", _full_sql(True))
def q_scd2_multi_attr(spark, sf_dir):
    return scd2_apply(dimension(spark, sf_dir, True), source(spark, sf_dir, True), ["customer_id"],
                      ["city", "band"], AS_OF)


@register("scd2_asof", f"""WITH {_sql_inputs(False)}, {_expired_sql(False)}, {_new_sql(False)},
snap AS (SELECT * FROM dim WHERE NOT is_current UNION ALL SELECT * FROM expired UNION ALL SELECT * FROM new_rows)
SELECT * FROM snap
WHERE start_date <= DATE '2024-03-01' AND (end_date IS NULL OR DATE '2024-03-01' < end_date)""")
def q_scd2_asof(spark, sf_dir):
    snap = scd2_apply(dimension(spark, sf_dir), source(spark, sf_dir), ["customer_id"], ["city"], AS_OF)
    return as_of_view(snap, "2024-03-01")


@register("scd2_current", f"""WITH {_sql_inputs(False)}, {_expired_sql(False)}, {_new_sql(False)},
snap AS (SELECT * FROM dim WHERE NOT is_current UNION ALL SELECT * FROM expired UNION ALL SELECT * FROM new_rows)
SELECT * FROM snap WHERE is_current""")
def q_scd2_current(spark, sf_dir):
    return current_view(scd2_apply(dimension(spark, sf_dir), source(spark, sf_dir), ["customer_id"], ["city"], AS_OF))


@register("scd2_merge_once", _full_sql(False))
def q_scd2_merge_once(spark, sf_dir):
    """``scd2_full`` on a dimension with NOT NULL columns."""
    dim = dimension(spark, sf_dir).withColumns({"start_date": F.coalesce("start_date", F.lit(dt.date(1970, 1, 1))),
                                                "is_current": F.coalesce("is_current", F.lit(False))})
    return scd2_apply(dim, source(spark, sf_dir), ["customer_id"], ["city"], AS_OF)


@register("scd2_late", """
WITH d AS (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS start_date, max(o_orderpriority) AS priority
           FROM orders GROUP BY 1, 2),
n AS (SELECT *, lag(priority) OVER w AS before FROM d WINDOW w AS (PARTITION BY customer_id ORDER BY start_date)),
v AS (SELECT * FROM n WHERE before IS NULL OR before <> priority)
SELECT customer_id, priority, start_date, lead(start_date) OVER w AS end_date, lead(start_date) OVER w IS NULL AS is_current
FROM v WINDOW w AS (PARTITION BY customer_id ORDER BY start_date)
""")
def q_scd2_late(spark, sf_dir):
    """Each customer's order priority over time, delivered in three batches out of order:
    every version ends up at its own date."""
    days = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("day")).agg(F.max("o_orderpriority").alias("priority"))
    dim = SnapshotTable(spark, shared_dir(spark, "priority_dim"))
    dim.replace(spark.createDataFrame([], "customer_id long, priority string, start_date date, end_date date, is_current boolean"))
    batch = F.pmod(F.dayofmonth("day") * 7 + F.col("customer_id"), F.lit(3))
    for late in (1, 0, 2):
        dim.replace(scd2_insert(dim.read(), days.filter(batch == late), ["customer_id"], "day"))
    return merged_versions(dim.read(), ["customer_id"], ["priority"])


@register("scd2_stored", f"""WITH {_sql_inputs(False)},
open1 AS (SELECT DISTINCT customer_id, city, DATE '2024-03-01' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current FROM src),
s2 AS (SELECT c_custkey AS customer_id, c_mktsegment AS city FROM customer)
SELECT o.customer_id, o.city, o.start_date,
       CASE WHEN s.customer_id IS NOT NULL AND o.city IS DISTINCT FROM s.city THEN DATE '{AS_OF}' END AS end_date,
       s.customer_id IS NULL OR o.city IS NOT DISTINCT FROM s.city AS is_current
FROM open1 o LEFT JOIN s2 s ON s.customer_id = o.customer_id
UNION ALL
SELECT s.customer_id, s.city, DATE '{AS_OF}', NULL, true
FROM s2 s LEFT JOIN open1 o ON s.customer_id = o.customer_id WHERE o.customer_id IS NULL OR o.city IS DISTINCT FROM s.city
""")
def q_scd2_stored(spark, sf_dir):
    """A stored dimension: two sources, each applied twice; the second time changes nothing,
    also for rows without a key."""
    path = shared_dir(spark, "customer_dim")
    dim = SnapshotTable(spark, path)
    second = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("city"))
    for src, day in ((source(spark, sf_dir), "2024-03-01"), (second, AS_OF)):
        for _ in range(2):
            scd2_store(dim, src, ["customer_id"], ["city"], day)
    return dim.read()
