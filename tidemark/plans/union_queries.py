"""Set-operation queries (U1-U6) over customer, supplier, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.mapping import map_to_contract
from ..operators.merge import upsert
from ..operators.union import choose_result, per_source_upsert, rows_once_only, split_by_source, union_distinct, union_sources
from ..sources.spec import collect_mappings, spec_from_dict
from .mapping_queries import CLIENT_CONTRACT, _m
from .registry import register, table


@register("union_sources", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       CAST(NULL AS INTEGER) AS nation, 'customer' AS filename FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR), s_nationkey, 'supplier' FROM supplier
""")
def q_union_sources(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("filename"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("filename"))
    return union_sources([c, s])


@register("union_distinct", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
UNION
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END FROM orders
""")
def q_union_distinct(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = o.select("o_orderkey", "o_custkey", "o_orderstatus")
    new = o.select("o_orderkey", "o_custkey",
                   F.when(F.col("o_orderkey") % 3 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
                    .alias("o_orderstatus"))
    return union_distinct(old, new)


@register("rows_once_only", """
SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') b
GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1
""")
def q_rows_once_only(spark, sf_dir):
    """Base minus the rows that a second frame delivers again."""
    base = table(spark, sf_dir, "lineitem")
    again = base.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    return rows_once_only(base.select("l_orderkey", "l_linenumber"), again)


def _base_and_new(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    base = cust.select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                       F.lower("c_mktsegment").alias("filename"))
    redelivered = cust.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).select(
        k.alias("id"),
        F.when(k % 2 == 0, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name")).alias("name"),
        F.col("c_acctbal").alias("balance"), F.lower("c_mktsegment").alias("filename"))
    vendors = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.lit("supplier").alias("filename"))
    return base, redelivered.unionByName(vendors)


@register("per_source_upsert", """
WITH base AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, lower(c_mktsegment) AS filename
              FROM customer),
new AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name || '*' ELSE c_name END AS name,
               c_acctbal AS balance, lower(c_mktsegment) AS filename
        FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
        UNION ALL
        SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier),
ns AS (SELECT DISTINCT filename FROM new),
bs AS (SELECT DISTINCT filename FROM base)
SELECT * FROM base WHERE filename NOT IN (SELECT filename FROM ns)
UNION ALL
SELECT * FROM (SELECT * FROM base WHERE filename IN (SELECT filename FROM ns)
               UNION
               SELECT * FROM new WHERE filename IN (SELECT filename FROM bs)) r
UNION ALL
SELECT * FROM new WHERE filename NOT IN (SELECT filename FROM bs)
""")
def q_per_source_upsert(spark, sf_dir):
    base, new = _base_and_new(spark, sf_dir)
    return per_source_upsert(base, new)


@register("per_source_update", """
WITH base AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, lower(c_mktsegment) AS filename
              FROM customer),
new AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name || '*' ELSE c_name END AS name,
               c_acctbal AS balance, lower(c_mktsegment) AS filename
        FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
        UNION ALL
        SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier)
SELECT * FROM base b WHERE filename = 'automobile'
  AND NOT EXISTS (SELECT 1 FROM new n WHERE n.filename = b.filename AND n.id = b.id)
UNION SELECT * FROM new WHERE filename = 'automobile'
""")
def q_per_source_update(spark, sf_dir):
    """Refresh by key (re-delivered keys replace their old rows); one source of the result."""
    base, new = _base_and_new(spark, sf_dir)
    return split_by_source(per_source_upsert(base, new, keys=["id"]), "automobile")


VENDOR_SPEC = {"supplier.csv": {
    "type": "vendor", "schema": "sdm", "tablename": "client_std", "relational": False,
    "mapping": [
        _m("s_suppkey", "client.ClientId", "s_suppkey", "ClientId"),
        _m("s_name", "client.ClientName", "s_suppkey", "ClientId"),
        _m("s_acctbal", "client.Balance", "s_suppkey", "ClientId"),
    ]}}


@register("standardize_mixed", """
WITH t AS (SELECT c_custkey AS ClientId, c_name AS ClientName, c_mktsegment AS Segment, c_acctbal AS Balance
           FROM customer),
s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey - 1 END AS ClientId,
             CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment || '_V2' END AS Segment,
             CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal + 1 END AS Balance
      FROM customer)
SELECT coalesce(t.ClientId, s.ClientId) AS ClientId, t.ClientName,
       coalesce(nullif(s.Segment, ''), t.Segment) AS Segment, coalesce(s.Balance, t.Balance) AS Balance,
       CAST(NULL AS VARCHAR) AS Phone, CAST(NULL AS VARCHAR) AS Country,
       CAST(NULL AS VARCHAR) AS rec_type, CAST(NULL AS VARCHAR) AS filename
FROM t FULL OUTER JOIN s ON t.ClientId IS NOT DISTINCT FROM s.ClientId
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR), s_acctbal, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       'vendor', 'supplier'
FROM supplier
""")
def q_standardize_mixed(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    target = cust.select(k.alias("ClientId"), F.col("c_name").alias("ClientName"),
                         F.col("c_mktsegment").alias("Segment"), F.col("c_acctbal").alias("Balance"))
    relational = cust.select(
        F.when(k % 2 == 0, k).otherwise(-k - 1).alias("ClientId"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat("c_mktsegment", F.lit("_V2"))).alias("Segment"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") + 1).alias("Balance"))
    merged = upsert(target, relational, ["ClientId"])
    vendor_maps = collect_mappings(spec_from_dict(spark, VENDOR_SPEC))["supplier"]
    stacked = map_to_contract(table(spark, sf_dir, "supplier"), CLIENT_CONTRACT, vendor_maps)
    return choose_result(merged, stacked)


CHANGES_SPEC = {"client_changes": {
    "type": "client", "schema": "sdm", "tablename": "client_std", "relational": "True",
    "mapping": [
        _m("c_custkey", "client.ClientId", "c_custkey", "ClientId"),
        _m("c_mktsegment", "client.Segment", "c_custkey", "ClientId"),
        _m("c_acctbal", "client.Balance", "c_custkey", "ClientId"),
    ]}}


@register("standardize_run", """
WITH t AS (SELECT c_custkey AS ClientId, c_name AS ClientName, c_mktsegment AS Segment, c_acctbal AS Balance
           FROM customer),
s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey - 1 END AS ClientId,
             CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment || '_V2' END AS Segment,
             CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal + 1 END AS Balance
      FROM customer)
SELECT coalesce(t.ClientId, s.ClientId) AS ClientId, t.ClientName,
       coalesce(nullif(s.Segment, ''), t.Segment) AS Segment, coalesce(s.Balance, t.Balance) AS Balance,
       CAST(NULL AS VARCHAR) AS rec_type, CAST(NULL AS VARCHAR) AS filename
FROM t FULL OUTER JOIN s ON t.ClientId IS NOT DISTINCT FROM s.ClientId
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR), s_acctbal, 'vendor', 'supplier' FROM supplier
""")
def q_standardize_run(spark, sf_dir):
    """A full run into a stored table: relational client changes merged in,
    vendors stacked, all-null contract columns (Phone, Country) dropped, the
    table replaced by its next snapshot; returns the stored table."""
    from ..operators.standardize import run_standardization
    from ..session import shared_dir
    from ..sinks.snapshots import SnapshotTable
    from ..sources.target import read_target

    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    location = shared_dir(spark, "client_std")
    SnapshotTable(spark, location).replace(cust.select(k.alias("ClientId"), F.col("c_name").alias("ClientName"), F.col("c_mktsegment").alias("Segment"),
                F.col("c_acctbal").alias("Balance"), F.lit(None).cast("string").alias("Phone"),
                F.lit(None).cast("string").alias("Country")))
    sources = {
        "client_changes": cust.select(
            F.when(k % 2 == 0, k).otherwise(-k - 1).alias("c_custkey"),
            F.when(k % 7 == 0, F.lit("")).otherwise(F.concat("c_mktsegment", F.lit("_V2"))).alias("c_mktsegment"),
            F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") + 1).alias("c_acctbal")),
        "supplier": table(spark, sf_dir, "supplier"),
    }
    maps = collect_mappings(spec_from_dict(spark, {**CHANGES_SPEC, **VENDOR_SPEC}))
    run_standardization(spark, location, CLIENT_CONTRACT, maps, sources.__getitem__)
    return read_target(spark, location, CLIENT_CONTRACT)
