"""Selective ingestion queries (P1-P3) over the orders table."""

from __future__ import annotations

from ..operators.ingest import IngestionRule, apply_rule, select_columns
from .registry import register, table

# Fixed rules in the shape of the reference's ingestion config.
RULES = {
    "ingest_active": IngestionRule("parquet", "orders", "landing_orders_active",
                                   ("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderstatus = 'F'"),
    "ingest_amount": IngestionRule("parquet", "orders", "landing_orders_amount",
                                   ("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice > 250000"),
}


@register("select_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_select_columns(spark, sf_dir):
    return select_columns(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "o_custkey"])


@register("ingest_active", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_ingest_active(spark, sf_dir):
    rule = RULES["ingest_active"]
    return apply_rule(table(spark, sf_dir, rule.source_table), rule)


@register("ingest_amount", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def q_ingest_amount(spark, sf_dir):
    rule = RULES["ingest_amount"]
    return apply_rule(table(spark, sf_dir, rule.source_table), rule)
