"""Range conditions split any frame exactly, and evenly where the keys allow it."""

from __future__ import annotations

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.sources.ranges import range_predicates, read_jdbc_ranges
from tidemark.sources.jdbc import ConfigError


def sizes(df, conditions):
    """Rows of each condition; every row has to meet exactly one."""
    hits = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions]
    r = df.agg(F.count(F.lit(1)).alias("all"), F.min(reduce(lambda a, b: a + b, hits)).alias("least"),
               F.max(reduce(lambda a, b: a + b, hits)).alias("most"), *[F.sum(h).alias(f"n{i}") for i, h in enumerate(hits)]).first()
    assert r["all"] == 0 or (r["least"], r["most"]) == (1, 1)
    return [r[f"n{i}"] or 0 for i in range(len(hits))]


def test_skewed_keys_come_out_even(spark):
    i = F.col("id")
    df = spark.range(20_000).select((i * i * i).alias("k"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id*0.25)").alias("t"),
                                    F.date_add(F.lit(dt.date(2020, 1, 1)), F.sqrt(i).cast("int")).alias("d"), (i / 7).cast("decimal(20,6)").alias("x"))
    for column in ("k", "t", "d", "x"):
        n = sizes(df, range_predicates(df, column, 16, quote="`"))
        assert len(n) == 16 and max(n) < 2 * 20_000 / 16, column


def test_a_value_with_a_third_of_the_rows(spark):
    i = F.col("id")
    df = spark.range(12_000).select(F.when(i % 3 == 0, F.lit(500)).when(i % 50 == 1, F.lit(None)).otherwise(i).alias("k"), i.alias("n"))
    alone = sizes(df, range_predicates(df, "k", 12, quote="`"))
    assert max(alone) == df.filter("k = 500").count() == 4001  # the value by itself
    split = sizes(df, range_predicates(df, "k", 12, then="n", quote="`"))
    assert max(split) < 2 * 1000


def test_cuts_of_a_sample_still_split_all_rows(spark):
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    conditions = range_predicates(lines.filter("l_orderkey % 10 = 0"), "l_orderkey", 8, then="l_partkey", quote="`")
    n = sizes(lines, conditions)
    assert max(n) < 2 * sum(n) / 8
    other = spark.createDataFrame([(None, None), (-5, 1), (10**9, None)], "l_orderkey long, l_partkey long")
    assert sum(sizes(other, conditions)) == 3


def test_empty_constant_and_refused_columns(spark):
    df = spark.createDataFrame([(7, "a")] * 5, "k int, s string")
    assert sizes(df.limit(0), range_predicates(df.limit(0), "k", 4, quote="`")) == [0]
    assert sorted(sizes(df, range_predicates(df, "k", 4, then="k", quote="`")))[-1] == 5
    assert sizes(df, range_predicates(df, "k", 1, quote="`")) == [5]
    with pytest.raises(ConfigError):
        range_predicates(df, "s", 4)
    with pytest.raises(ConfigError):
        read_jdbc_ranges(spark, {"url": "jdbc:x", "query": "select 1"}, ["1 = 1"])
    assert range_predicates(df, "k", 2)[-1] == '"k" > 7 OR "k" IS NULL'
