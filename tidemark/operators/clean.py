"""Cleaning steps (P6-P11): one projection each, built-in expressions only.

Order matters where the reference mixes three kinds of "missing" (NaN, None
and ''): trim first, then NaN -> null, and blanks become null only on the
incoming side of a merge (handled in :mod:`.merge`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ..functions.columns import blank_to_null, nan_to_null, strip_blanks


def _c(name: str):
    return F.col(f"`{name}`")


def _string_cols(df: DataFrame, subset: Sequence[str] | None = None) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return [n for n in names if subset is None or n in subset]


def trim_strings(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Strip leading/trailing whitespace (any Unicode blank) of string columns."""
    todo = set(_string_cols(df, subset))
    return df.select([strip_blanks(_c(f.name)).alias(f.name) if f.name in todo else _c(f.name)
                      for f in df.schema.fields])


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> null on float/double columns; NaT needs nothing in Spark."""
    return df.select([nan_to_null(_c(f.name), f.dataType).alias(f.name)
                      if isinstance(f.dataType, (DoubleType, FloatType)) else _c(f.name)
                      for f in df.schema.fields])


def blanks_to_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exactly-empty strings -> null."""
    todo = set(_string_cols(df, subset))
    return df.select([blank_to_null(_c(f.name)).alias(f.name) if f.name in todo else _c(f.name)
                      for f in df.schema.fields])


def null_to_blank(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Null strings -> '' for display."""
    cols = _string_cols(df, subset)
    return df.na.fill("", subset=cols) if cols else df


def all_null_columns(df: DataFrame) -> list[str]:
    """Names of columns with no non-null value: one aggregate pass.

    ``count(c)`` for every column in a single global aggregation; partial
    counts are combined map-side, so the shuffle carries one row per task.
    """
    if not df.columns:
        return []
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count(_c(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    if row["n"] == 0:  # an empty frame says nothing about its columns: all stay
        return []
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] == 0]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null on every row (P11). Eager: the schema depends on data."""
    dead = set(all_null_columns(df))
    return df.select([_c(c) for c in df.columns if c not in dead])


def standard_clean(df: DataFrame) -> DataFrame:
    """The reference's per-source cleaning: NaN -> null, then trim strings."""
    return trim_strings(nan_to_null_all(df))
