"""Gold-layer ratio aggregates (A6-A8); the reference names them, the formulas are ours.

Every ratio is a ratio of sums (never a mean of per-row ratios) so partial
aggregation works map-side and a hot group costs one partial row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from .keys import equal, with_join_keys


def _ratio(num: Column, den: Column) -> Column:
    return num / F.when(den != 0, den)


def cost_per_unit(df: DataFrame, group_cols: Sequence[str], cost: Column | str, units: Column | str,
                  digits: int = 4, name: str = "cost_per_unit") -> DataFrame:
    """``sum(cost) / sum(units)`` per group, null when no units."""
    c = F.col(cost) if isinstance(cost, str) else cost
    u = F.col(units) if isinstance(units, str) else units
    return df.groupBy(*group_cols).agg(F.round(_ratio(F.sum(c), F.sum(u)), digits).alias(name))


def to_units(amount: Column, scale: int = 4) -> Column:
    """An amount as an exact integer count of ``10**-scale`` units.

    Integer sums are exact and stay on Spark's 64-bit fast path (DECIMAL
    multiplication goes through ``BigDecimal``); inputs with at most
    ``scale`` decimals convert without loss.
    """
    return F.rint(amount * F.lit(10 ** scale)).cast(LongType())


def from_units(units: Column, scale: int = 4, digits: int = 2) -> Column:
    """Integer units back to an amount rounded HALF_UP to ``digits`` decimals."""
    step = 10 ** (scale - digits)
    q = F.floor((F.abs(units) + F.lit(step // 2)) / F.lit(step))
    return (F.signum(units) * q / F.lit(10 ** digits)).cast(DoubleType())


def profitability(revenue_rows: DataFrame, key: str, item_key: str, revenue: Column | str, cost_rows: DataFrame,
                  cost_key: str, cost: Column | str, scale: int = 4) -> DataFrame:
    """Per contract: revenue, cost, profit and margin.

    ``cost_rows`` is pre-aggregated per ``cost_key`` (partial aggregation
    before any shuffle), joined to the revenue rows' ``item_key``, and the
    joined rows are aggregated per contract ``key``: one join, two
    aggregations, no per-contract collection. Amounts are summed exactly in
    integer units of ``10**-scale`` and rounded once at the end.
    """
    c = F.col(cost) if isinstance(cost, str) else cost
    r = F.col(revenue) if isinstance(revenue, str) else revenue
    per_item = cost_rows.groupBy(F.col(cost_key).alias("__ck")).agg(F.sum(to_units(c, scale)).alias("__cost"))
    # never-null join columns derived after the aggregation give its side an exchange of
    # its own, so AQE can split a hot item on the revenue side (see .keys)
    kinds = [revenue_rows.schema[item_key].dataType]
    rows, left = with_join_keys(revenue_rows, [item_key], kinds, "__rk")
    costs, right = with_join_keys(per_item.where("__ck is not null"), ["__ck"], kinds, "__pk")
    j = rows.join(costs, equal(left, right), "left")
    g = j.groupBy(key).agg(F.sum(to_units(r, scale)).alias("__rev"),
                           F.coalesce(F.sum("__cost"), F.lit(0).cast(LongType())).alias("__cst"))
    rev = from_units(F.col("__rev"), scale)
    prof = from_units(F.col("__rev") - F.col("__cst"), scale)
    return g.select(key, rev.alias("revenue"), from_units(F.col("__cst"), scale).alias("cost"),
                    prof.alias("profit"), F.round(_ratio(prof, rev), 4).alias("margin"))


def excess_projection(df: DataFrame, key: str, ts: str, usage: str, as_of: dt.date | str, term_days: int,
                      allowance: float) -> DataFrame:
    """Projected usage over the term and the excess above the allowance.

    ``projected = usage_to_date / elapsed_days * term_days`` with elapsed days
    counted from the first usage day to ``as_of`` inclusive;
    ``excess = greatest(0, projected - allowance)``.
    """
    d = F.lit(str(as_of)).cast("date")
    g = df.groupBy(key).agg(F.sum(usage).alias("usage_to_date"), F.min(F.to_date(ts)).alias("first_day"))
    elapsed = F.datediff(d, F.col("first_day")) + 1
    projected = F.col("usage_to_date") / elapsed * F.lit(term_days)
    return g.select(
        key, F.round("usage_to_date", 4).alias("usage_to_date"), elapsed.alias("elapsed_days"),
        F.round(projected, 4).alias("projected_usage"),
        F.round(F.greatest(F.lit(0.0), projected - F.lit(float(allowance))), 4).alias("excess_usage"))
