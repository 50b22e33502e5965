"""Mapping-spec queries (P4, P5, P10, P12-P14, F4) over driver tables.

The specs are configuration in the reference's JSON shape; the data each
query moves is a whole driver table.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from ..operators.mapping import derive_entity_id, map_to_contract, rename_by_mapping, with_provenance
from ..sources.spec import collect_mappings, spec_from_dict
from .registry import register, table


def _m(src: str, tgt: str, sk: str, tk: str) -> dict:
    return {"source_column": src, "target_column": tgt, "source_key": sk, "target_key": tk}


def customer_spec(relational: bool) -> dict:
    """Customer -> client contract; one source column the table lacks
    (``c_phone``) and one target the contract lacks (``NationCode``)."""
    key = ("c_custkey", "ClientId")
    return {"customer.csv": {
        "type": "client", "schema": "sdm", "tablename": "client_std",
        "relational": "True" if relational else "False",
        "mapping": [
            _m("c_custkey", "client.ClientId", *key),
            _m("c_name", "client.ClientName", *key),
            _m("c_mktsegment", "client.Segment", *key),
            _m("c_acctbal", "client.Balance", *key),
            _m("c_phone", "client.Phone", *key),
            _m("c_nationkey", "client.NationCode", *key),
        ]}}


CLIENT_CONTRACT = StructType([
    StructField("ClientId", LongType()), StructField("ClientName", StringType()),
    StructField("Segment", StringType()), StructField("Balance", DoubleType()),
    StructField("Phone", StringType()), StructField("Country", StringType()),
])

ORDERS_SPEC = {"orders.xlsx": {
    "type": "order", "schema": "sdm", "tablename": "order_std", "relational": "False",
    "mapping": [
        _m("o_orderkey", "order.OrderId", "o_orderkey", "OrderId"),
        _m("o_orderpriority", "order.Code", "o_orderkey", "OrderId"),
        _m("o_orderstatus", "order.Code", "o_orderkey", "OrderId"),
        _m("o_totalprice", "order.Amount", "o_orderkey", "OrderId"),
    ]}}

ORDER_CONTRACT = StructType([
    StructField("OrderId", LongType()), StructField("Code", StringType()),
    StructField("Amount", DoubleType()), StructField("OrderDate", DateType()),
])


def _mappings(spark, spec: dict, source: str):
    return collect_mappings(spec_from_dict(spark, spec))[source]


@register("rename_by_mapping", """
SELECT c_custkey AS ClientId, c_name AS ClientName, c_mktsegment AS Segment,
       c_acctbal AS Balance, c_nationkey AS NationCode
FROM customer
""")
def q_rename_by_mapping(spark, sf_dir):
    return rename_by_mapping(table(spark, sf_dir, "customer"), _mappings(spark, customer_spec(True), "customer"))


@register("map_to_contract", """
SELECT c_custkey AS ClientId, c_name AS ClientName, c_mktsegment AS Segment, c_acctbal AS Balance,
       CAST(NULL AS VARCHAR) AS Phone, CAST(NULL AS VARCHAR) AS Country,
       'client' AS rec_type, 'customer' AS filename
FROM customer
""")
def q_map_to_contract(spark, sf_dir):
    return map_to_contract(table(spark, sf_dir, "customer"), CLIENT_CONTRACT,
                           _mappings(spark, customer_spec(False), "customer"))


@register("provenance_cols", """
SELECT *, 'customer' AS filename, 'client' AS type, 'client_std' AS table_name, 'sdm' AS schema
FROM customer
""")
def q_provenance_cols(spark, sf_dir):
    m = _mappings(spark, customer_spec(False), "customer")[0]
    return with_provenance(table(spark, sf_dir, "customer"), m)


@register("stack_repeated_target", """
SELECT o_orderkey AS OrderId, o_orderpriority AS Code, o_totalprice AS Amount,
       CAST(NULL AS DATE) AS OrderDate, 'order' AS rec_type, 'orders' AS filename
FROM orders
UNION ALL
SELECT CAST(NULL AS BIGINT), o_orderstatus, CAST(NULL AS DOUBLE), CAST(NULL AS DATE), 'order', 'orders'
FROM orders
""")
def q_stack_repeated_target(spark, sf_dir):
    return map_to_contract(table(spark, sf_dir, "orders"), ORDER_CONTRACT, _mappings(spark, ORDERS_SPEC, "orders"))


@register("derived_entity_id", """
SELECT p_partkey, p_type, upper(substr(p_type, 1, 1)) || '_' || CAST(p_partkey AS VARCHAR) AS esg_entity_id
FROM part
""")
def q_derived_entity_id(spark, sf_dir):
    return derive_entity_id(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", "p_partkey")
