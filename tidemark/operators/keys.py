"""Join keys that stay splittable when one key value is hot.

Two rules shape every key join in this package:

* keys are compared through never-null columns ``(key IS NULL,
  coalesce(key, filler))``: plain equality on them equals ``<=>`` on the key,
  so the null key matches itself without a special join condition;
* an anti/semi join probes the other side's *distinct* keys (partial
  aggregation collapses a hot key to one row per map task before anything is
  shuffled), and those distinct keys reach the join through their own
  exchange. AQE splits a skewed join partition only when both join inputs are
  plain shuffle stages; keeping the probe side that way lets it split a hot
  key on the streamed side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def filler(dtype: DataType) -> Column:
    """Any non-null value of ``dtype``; it only fills the slot of a null key."""
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, (StringType, BinaryType)):
        return F.lit("").cast(dtype)
    raise TypeError(f"unsupported key type {dtype.simpleString()}")


def typed_key(name: str, key_type: DataType, own_type: DataType | None = None) -> Column:
    c = F.col(f"`{name}`")
    return c if own_type is None or own_type == key_type else c.cast(key_type)


def null_safe_parts(key: Column, key_type: DataType) -> list[Column]:
    """``[key IS NULL, coalesce(key, filler)]``: never-null stand-ins for ``<=>``."""
    return [key.isNull(), F.coalesce(key, filler(key_type))]


def key_names(n_keys: int, tag: str) -> list[str]:
    return [f"{tag}{i}" for i in range(2 * n_keys)]


def with_join_keys(df: DataFrame, keys: Sequence[str], key_types: Sequence[DataType],
                   tag: str = "__k") -> tuple[DataFrame, list[str]]:
    """``df`` plus the never-null join columns of ``keys`` (cast to ``key_types``)."""
    own = {f.name: f.dataType for f in df.schema.fields}
    parts = [p for k, t in zip(keys, key_types) for p in null_safe_parts(typed_key(k, t, own[k]), t)]
    names = key_names(len(keys), tag)
    return df.withColumns(dict(zip(names, parts))), names


def probe_keys(df: DataFrame, keys: Sequence[str], key_types: Sequence[DataType],
               tag: str, distinct: bool = True) -> tuple[DataFrame, list[str]]:
    """Distinct keys of ``df`` as never-null join columns, ready to probe.

    The distinct runs on the raw keys; the join columns are derived after it,
    so the join adds one exchange on them and both join inputs stay plain
    shuffle stages that AQE can split.
    """
    own = {f.name: f.dataType for f in df.schema.fields}
    raw = [f"{tag}_raw{i}" for i in range(len(keys))]
    keyed = df.select([typed_key(k, t, own[k]).alias(r) for k, t, r in zip(keys, key_types, raw)])
    if distinct:  # callers passing an aggregate's output already have one row per key
        keyed = keyed.distinct()
    names = key_names(len(keys), tag)
    parts = [p for r, t in zip(raw, key_types) for p in null_safe_parts(F.col(r), t)]
    return keyed.select([p.alias(n) for p, n in zip(parts, names)]), names


def equal(left: Sequence[Column | str], right: Sequence[Column | str]) -> Column:
    """Conjunction of plain equalities, pairwise."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c
    return reduce(lambda a, b: a & b, [col(x) == col(y) for x, y in zip(left, right)])
