"""Ranges of a key that hold about the same number of rows, as predicates for parallel reads.

``lowerBound``/``upperBound`` cut a key's span into equal widths, which on skewed keys leaves most
rows to one task. Here the cuts are approximate percentiles of the key (of the table itself, or
of any sample of it, such as an earlier load), and each range becomes one condition. The
conditions are exact whatever the cuts are: each row meets one of them, null keys the last.

A value that fills several ranges by itself gets a range of its own; with ``then``, a second
column, its rows are cut along that one. Only integer, decimal, date and timestamp columns are
taken: a database may sort texts in another order than Spark, and ranges would then lose rows.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, TimestampNTZType

from .jdbc import ConfigError


def _literal(v) -> str:
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    return format(v, "f") if isinstance(v, Decimal) else str(int(v))


def _checked(sample: DataFrame, column: str) -> str:
    t = sample.schema[column].dataType
    if not isinstance(t, (IntegralType, DecimalType, DateType, TimestampNTZType)):
        raise ConfigError(f"{column} is {t.simpleString()}; ranges need an integer, decimal, date or timestamp without zone")
    return column


def _cuts(column: str, parts: int):
    """``parts - 1`` percentiles, in error by a hundredth of a range."""
    return F.percentile_approx(F.col(f"`{column}`"), [i / parts for i in range(1, parts)], 100 * parts)


def _between(name: str, bounds: list, rest: str) -> list[str]:
    """Conditions of the ranges between ascending ``bounds``; ``rest`` joins the nulls to the last."""
    if not bounds:
        return [rest]
    first = [f"{name} <= {_literal(bounds[0])}"]
    inner = [f"{name} > {_literal(a)} AND {name} <= {_literal(b)}" for a, b in zip(bounds, bounds[1:])]
    return first + inner + [f"{name} > {_literal(bounds[-1])} OR {name} IS NULL"]


def range_predicates(sample: DataFrame, column: str, parts: int, then: str | None = None, quote: str = '"') -> list[str]:
    """About ``parts`` conditions; each row of any table with these columns meets exactly one.

    ``quote``: the quotation mark of the database's names (```` ` ```` for Spark). One job, a
    second one if ``then`` is given and some value fills several ranges. The driver gets ``parts``
    values a column at most.
    """
    if parts < 1:
        raise ConfigError("parts must be at least 1")
    name = f"{quote}{_checked(sample, column)}{quote}"
    found = (sample.agg(_cuts(column, parts).alias("cuts")).first()["cuts"] if parts > 1 else None) or []
    times = Counter(found)
    hot = sorted(v for v, n in times.items() if n > 1)
    # rows below a hot value end before it, so that the value stands alone
    out, low = [], None
    for v in sorted(times):
        above = [f"{name} > {_literal(low)}"] if low is not None else []
        if v in hot:
            out.append(" AND ".join([*above, f"{name} < {_literal(v)}"]))
            out.append(f"{name} = {_literal(v)}")
        else:
            out.append(" AND ".join([*above, f"{name} <= {_literal(v)}"]))
        low = v
    out.append(f"{name} > {_literal(low)} OR {name} IS NULL" if low is not None else f"{name} IS NULL OR {name} IS NOT NULL")
    if then is None or not hot:
        return out
    second = f"{quote}{_checked(sample, then)}{quote}"
    most = max(times[v] for v in hot) + 1
    cuts = {r["v"]: r["cuts"] for r in sample.where(F.col(f"`{column}`").isin(hot)).groupBy(F.col(f"`{column}`").alias("v"))
            .agg(_cuts(then, most).alias("cuts")).collect()}
    for v in hot:
        whole = f"{name} = {_literal(v)}"
        inside = _between(second, sorted(set(cuts.get(v) or [])), f"{second} IS NULL OR {second} IS NOT NULL")
        at = out.index(whole)
        out[at:at + 1] = [f"{whole} AND ({c})" for c in inside]
    return out


def read_jdbc_ranges(spark: SparkSession, options: dict[str, str], predicates: list[str]) -> DataFrame:
    """A JDBC table (``dbtable`` in ``options``) read by one task for each condition."""
    if "dbtable" not in options:
        raise ConfigError("reading by conditions needs a table, not a query")
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)
