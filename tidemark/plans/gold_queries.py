"""Gold aggregates (A6-A8): lineitem costs, order profitability, event usage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.gold import cost_per_unit, excess_projection, profitability
from .registry import register, table

TERM_DAYS = 365
ALLOWANCE = 50_000.0


@register("gold_cost_per_unit", """
SELECT l_suppkey, round(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 4) AS cost_per_unit
FROM lineitem GROUP BY l_suppkey
""")
def q_gold_cost_per_unit(spark, sf_dir):
    return cost_per_unit(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity")


@register("gold_profitability", """
WITH li AS (SELECT l_orderkey,
                   sum(CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(15, 2)))) AS c
            FROM lineitem GROUP BY l_orderkey),
g AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(15, 2))) AS revenue, sum(li.c) AS cost
      FROM orders LEFT JOIN li ON o_orderkey = li.l_orderkey GROUP BY o_custkey),
r AS (SELECT o_custkey, CAST(round(revenue, 2) AS DOUBLE) AS revenue,
             CAST(round(coalesce(cost, 0), 2) AS DOUBLE) AS cost,
             CAST(round(revenue - coalesce(cost, 0), 2) AS DOUBLE) AS profit
      FROM g)
SELECT o_custkey, revenue, cost, profit, round(profit / nullif(revenue, 0), 4) AS margin FROM r
""")
def q_gold_profitability(spark, sf_dir):
    # money is summed exactly (integer units inside the operator); the
    # oracle does the same with DECIMAL arithmetic
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = table(spark, sf_dir, "lineitem")
    line_cost = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return profitability(orders, "o_custkey", "o_orderkey", "o_totalprice", li, "l_orderkey", line_cost)


@register("gold_excess_projection", f"""
WITH g AS (SELECT user_id, sum(value) AS u, min(CAST(ts AS DATE)) AS first_day FROM events GROUP BY user_id)
SELECT user_id, round(u, 4) AS usage_to_date,
       CAST(date_diff('day', first_day, DATE '2024-01-31') + 1 AS INTEGER) AS elapsed_days,
       round(u / (date_diff('day', first_day, DATE '2024-01-31') + 1) * {TERM_DAYS}, 4) AS projected_usage,
       round(greatest(0.0, u / (date_diff('day', first_day, DATE '2024-01-31') + 1) * {TERM_DAYS} - {ALLOWANCE}),
             4) AS excess_usage
FROM g
""")
def q_gold_excess_projection(spark, sf_dir):
    return excess_projection(table(spark, sf_dir, "events"), "user_id", "ts", "value", "2024-01-31",
                             TERM_DAYS, ALLOWANCE)
