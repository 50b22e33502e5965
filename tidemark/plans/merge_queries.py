"""Merge queries (J1-J5, S6): sources derived from whole driver tables.

Matched, target-only and source-only rows are produced by value rules over
every row (CASE on the key), never by dropping rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators.merge import first_run, fold, merge_all, upsert
from .registry import register, table


def customer_target(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def customer_changes(spark, sf_dir):
    """Every customer once: even keys re-delivered, odd keys as new negative keys;
    segment blank for every 7th key, balance missing for every 5th."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(k % 2 == 0, k).otherwise(-k - 1).alias("c_custkey"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat("c_mktsegment", F.lit("_V2"))).alias("c_mktsegment"),
        F.when(k % 5 == 0, F.lit(None).cast(DoubleType())).otherwise(F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.col("c_nationkey"),
    )


_CHANGES_SQL = """
s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey - 1 END AS c_custkey,
             CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment || '_V2' END AS c_mktsegment,
             CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal + 1 END AS c_acctbal,
             c_nationkey
      FROM customer)
"""


@register("coalesce_upsert", f"""
WITH t AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer),
{_CHANGES_SQL}
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name,
       coalesce(nullif(s.c_mktsegment, ''), t.c_mktsegment) AS c_mktsegment,
       coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, s.c_nationkey
FROM t FULL OUTER JOIN s ON t.c_custkey IS NOT DISTINCT FROM s.c_custkey
""")
def coalesce_upsert(spark, sf_dir):
    return upsert(customer_target(spark, sf_dir), customer_changes(spark, sf_dir), ["c_custkey"])


CUSTOMER_CONTRACT = StructType([
    StructField("c_custkey", LongType()),
    StructField("c_name", StringType()),
    StructField("c_mktsegment", StringType()),
    StructField("c_acctbal", DoubleType()),
])


@register("first_run_load", f"""
WITH {_CHANGES_SQL}
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, nullif(c_mktsegment, '') AS c_mktsegment,
       c_acctbal, c_nationkey
FROM s
""")
def first_run_load(spark, sf_dir):
    return first_run(CUSTOMER_CONTRACT, customer_changes(spark, sf_dir), ["c_custkey"], spark)


def _supplier_slices(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    s1 = sup.select(k, F.when(k % 3 == 0, F.col("s_acctbal") * 2).alias("s_acctbal"))
    s2 = sup.select(k, F.when(k % 4 == 0, F.concat("s_name", F.lit("#2"))).otherwise(F.lit("")).alias("s_name"))
    s3 = sup.select((k + 1).alias("s_suppkey"),
                    F.when(k % 5 == 0, F.col("s_acctbal") + 100).alias("s_acctbal"),
                    F.col("s_nationkey"))
    return sup.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), [s1, s2, s3]


_FOLD_SQL = """
WITH t0 AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier),
s1 AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal * 2 END AS s_acctbal FROM supplier),
s2 AS (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_name || '#2' ELSE '' END AS s_name FROM supplier),
s3 AS (SELECT s_suppkey + 1 AS s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 100 END AS s_acctbal,
              s_nationkey FROM supplier),
t1 AS (SELECT coalesce(t0.s_suppkey, s1.s_suppkey) AS s_suppkey, t0.s_name, t0.s_nationkey,
              coalesce(s1.s_acctbal, t0.s_acctbal) AS s_acctbal
       FROM t0 FULL OUTER JOIN s1 ON t0.s_suppkey IS NOT DISTINCT FROM s1.s_suppkey),
t2 AS (SELECT coalesce(t1.s_suppkey, s2.s_suppkey) AS s_suppkey,
              coalesce(nullif(s2.s_name, ''), t1.s_name) AS s_name, t1.s_nationkey, t1.s_acctbal
       FROM t1 FULL OUTER JOIN s2 ON t1.s_suppkey IS NOT DISTINCT FROM s2.s_suppkey)
SELECT coalesce(t2.s_suppkey, s3.s_suppkey) AS s_suppkey, t2.s_name,
       coalesce(s3.s_nationkey, t2.s_nationkey) AS s_nationkey,
       coalesce(s3.s_acctbal, t2.s_acctbal) AS s_acctbal
FROM t2 FULL OUTER JOIN s3 ON t2.s_suppkey IS NOT DISTINCT FROM s3.s_suppkey
"""


@register("multi_source_fold", _FOLD_SQL)
def multi_source_fold(spark, sf_dir):
    target, slices = _supplier_slices(spark, sf_dir)
    return fold(target, [(s, ["s_suppkey"]) for s in slices])


@register("multi_source_merge_once", _FOLD_SQL)
def multi_source_merge_once(spark, sf_dir):
    """The same three-source fold as ``multi_source_fold`` in one aggregation (unique keys)."""
    target, slices = _supplier_slices(spark, sf_dir)
    return merge_all(target, [(s, ["s_suppkey"]) for s in slices])


@register("composite_key_merge", """
WITH t AS (SELECT l_orderkey, l_linenumber, round(sum(l_quantity), 2) AS qty, min(l_returnflag) AS flag
           FROM lineitem GROUP BY l_orderkey, l_linenumber),
s AS (SELECT l_linenumber + 1 AS src_linenumber, l_orderkey AS src_orderkey,
             max(l_linestatus) AS flag, round(sum(l_extendedprice), 2) AS amount
      FROM lineitem GROUP BY l_orderkey, l_linenumber + 1)
SELECT coalesce(t.l_orderkey, s.src_orderkey) AS l_orderkey,
       coalesce(t.l_linenumber, s.src_linenumber) AS l_linenumber,
       t.qty, coalesce(nullif(s.flag, ''), t.flag) AS flag, s.amount
FROM t FULL OUTER JOIN s
  ON t.l_orderkey IS NOT DISTINCT FROM s.src_orderkey
 AND t.l_linenumber IS NOT DISTINCT FROM s.src_linenumber
""")
def composite_key_merge(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    target = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.round(F.sum("l_quantity"), 2).alias("qty"), F.min("l_returnflag").alias("flag"))
    source = li.groupBy((F.col("l_linenumber") + 1).alias("src_linenumber"),
                        F.col("l_orderkey").alias("src_orderkey")).agg(
        F.max("l_linestatus").alias("flag"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    return upsert(target, source, [("l_orderkey", "src_orderkey"), ("l_linenumber", "src_linenumber")])


@register("merge_fanout", """
WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
s AS (SELECT o_custkey AS c_custkey, o_orderkey,
             CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS c_acctbal FROM orders)
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name,
       coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, s.o_orderkey
FROM t FULL OUTER JOIN s ON t.c_custkey IS NOT DISTINCT FROM s.c_custkey
""")
def merge_fanout(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    source = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("c_acctbal"))
    return upsert(target, source, ["c_custkey"])
