"""Cleaning queries (P6, P7, P9, P11); the dirt is derived from the key."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.clean import blanks_to_null, drop_all_null_columns, nan_to_null_all, null_to_blank, trim_strings
from .registry import register, table


def _padded(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 3 == 0, F.concat(F.lit("  "), "c_name", F.lit("\t")))
         .when(k % 3 == 1, F.concat("c_name", F.lit(" \n"))).otherwise(F.col("c_name")).alias("c_name"),
        F.concat(F.lit(" "), "c_mktsegment").alias("c_mktsegment"),
        "c_acctbal")


@register("trim_strings", r"""
WITH p AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 3 = 0 THEN '  ' || c_name || chr(9)
              WHEN c_custkey % 3 = 1 THEN c_name || ' ' || chr(10) ELSE c_name END AS c_name,
         ' ' || c_mktsegment AS c_mktsegment, c_acctbal
  FROM customer)
SELECT c_custkey, regexp_replace(c_name, '^\s+|\s+$', '', 'g') AS c_name,
       regexp_replace(c_mktsegment, '^\s+|\s+$', '', 'g') AS c_mktsegment, c_acctbal
FROM p
""")
def q_trim_strings(spark, sf_dir):
    return trim_strings(_padded(spark, sf_dir))


@register("nan_to_null", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CAST(c_nationkey AS DOUBLE) AS nation_value
FROM customer
""")
def q_nan_to_null(spark, sf_dir):
    k = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 4 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.col("c_nationkey").cast("double").alias("nation_value"))
    return nan_to_null_all(df)


@register("null_to_blank", """
SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name END AS c_name, c_acctbal
FROM customer
""")
def q_null_to_blank(spark, sf_dir):
    k = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 6 != 0, F.col("c_name")).alias("c_name"), "c_acctbal")
    return null_to_blank(df)


@register("blanks_to_null", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders
""")
def q_blanks_to_null(spark, sf_dir):
    """Empty text is null; a blank that isn't empty stays."""
    k = F.col("o_orderkey")
    return blanks_to_null(table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 5 == 0, "").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 7 == 0, " ").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice"))


@register("drop_all_null_cols", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_alias
FROM customer
""")
def q_drop_all_null_cols(spark, sf_dir):
    k = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(k % 2 == 0, F.col("c_mktsegment")).alias("c_alias"),
        F.when(F.col("c_acctbal") > 1e15, F.col("c_name")).cast(StringType()).alias("c_comment"))
    return drop_all_null_columns(df)
