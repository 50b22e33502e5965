"""Membership joins against metadata frames (config, watermark, policy, source names).

They are ordinary semi and anti joins on the distinct values of the small
side. Nothing is counted or collected while a query is built: whether a side
is broadcast is decided by the planner and AQE from measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def semi_by_values(big: DataFrame, column: str, values_df: DataFrame, values_column: str,
                   anti: bool = False) -> DataFrame:
    """``big`` rows whose ``column`` is (``anti``: is not) among ``values_df``'s values.

    Null never matches: a null ``column`` is dropped by the semi form and kept
    by the anti form. The distinct values are aggregated map-side first, so a
    value repeated on every row of ``values_df`` costs one row per task.
    """
    keys = values_df.select(F.col(f"`{values_column}`").alias("__v")).distinct()
    return big.join(keys, F.col(f"`{column}`") == F.col("__v"), "left_anti" if anti else "left_semi")
