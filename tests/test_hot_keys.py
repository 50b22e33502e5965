"""Upsert finds hot keys by itself and spreads them, with the plain join's rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from test_skew import hot_lines, skew_session
from tidemark.operators import hotkeys
from tidemark.operators.keys import with_join_keys
from tidemark.operators.merge import fold, upsert


def tally(df):
    return Counter(tuple(r) for r in df.collect())


def orders(spark):
    return spark.read.parquet(f"{SF01}/orders.parquet").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), "o_totalprice")


def both_sides_hot(spark, n=3000):
    """A key with a third of the rows on both sides; every side also has its own keys."""
    i = F.col("id")
    target = spark.range(n).select(F.when(i < n // 3, F.lit(7)).otherwise(i).alias("k"), i.alias("t"),
                                   F.concat(F.lit("name"), i).alias("v"))
    source = spark.range(n // 3).select(F.when(i < n // 9, F.lit(7)).otherwise(i * 4).alias("k"), i.alias("s"),
                                        F.when(i % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("new"), i)).alias("v"))
    return target, source


@pytest.fixture
def spread(spark):
    """Sides of any size count as large; many partitions."""
    with skew_session(spark):
        old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                              "spark.sql.adaptive.coalescePartitions.enabled")}
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        yield spark
        for k, v in old.items():
            spark.conf.set(k, v)


def rows_by_task(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())


def test_key_hot_on_both_sides_is_spread_without_options(spread):
    target, source = both_sides_hot(spread)
    out = upsert(target, source, ["k"])
    plain = upsert(target, source, ["k"], hot_keys="plain")
    assert tally(out) == tally(plain)
    even, piled = rows_by_task(out), rows_by_task(plain)
    total = sum(even)
    assert total == sum(piled) and piled[-1] > 0.9 * total  # one task holds the fan-out
    assert even[-1] < 5 * even[len(even) // 2] and even[-1] < total / 5


@pytest.mark.parametrize("side", ["target", "source"])
def test_key_hot_on_one_side(spread, side):
    few, many = orders(spread), hot_lines(spread)
    # key 0 is hot and absent from the other side; 32 is hot and there
    many = many.withColumn("k", F.when(F.col("l_partkey") % 2 == 0, F.lit(32)).otherwise(F.col("k")))
    t, s = (many, few) if side == "target" else (few, many)
    assert tally(upsert(t, s, ["k"])) == tally(upsert(t, s, ["k"], hot_keys="plain"))


def test_hot_null_and_empty_keys_of_several_columns(spread):
    rows = [(None, "", i) for i in range(400)] + [(1, None, i) for i in range(400)] + [(i, "x", i) for i in range(300)]
    t = spread.createDataFrame(rows, "a int, b string, t int").repartition(4)
    s = spread.createDataFrame([(a, b, float(i)) for a, b, i in rows[::9]] + [(0, "", 1.0)] * 50,
                               "a int, b string, s double").repartition(3)
    for nulls in ("match", "append"):
        got = upsert(t, s, ["a", "b"], null_keys=nulls)
        assert tally(got) == tally(upsert(t, s, ["a", "b"], null_keys=nulls, hot_keys="plain"))


def test_zeros_and_nans_are_one_key_each(spread):
    values = [0.0, -0.0, float("nan")] * 200 + [float(i) for i in range(1, 300)]
    t = spread.createDataFrame([(v, i) for i, v in enumerate(values)], "k double, t int")
    s = spread.createDataFrame([(v, i) for i, v in enumerate(values[::7])], "k double, s int")
    count = lambda df: Counter((str(r["k"] + 0.0), r["t"], r["s"]) for r in df.collect())
    assert count(upsert(t, s, ["k"])) == count(upsert(t, s, ["k"], hot_keys="plain"))


def test_empty_sides_and_clashing_names(spread):
    t, s = both_sides_hot(spread, 900)
    for a, b in ((t.limit(0), s), (t, s.limit(0)), (t.limit(0), s.limit(0))):
        assert tally(upsert(a, b, ["k"])) == tally(upsert(a, b, ["k"], hot_keys="plain"))


def test_fold_looks_at_each_input_once(spread, monkeypatch):
    t, s = both_sides_hot(spread, 900)
    s2 = s.select(F.col("k").alias("key2"), (F.col("s") + 1).alias("s")).filter("s % 10 = 0")
    looked = []
    real = hotkeys.frequent_keys

    def counting(df, names, *a):
        looked.append(len(df.columns))
        return real(df, names, *a)

    monkeypatch.setattr("tidemark.operators.merge.frequent_keys", counting)
    sources = [(s, ["k"]), (s2, [("k", "key2")])]
    got = tally(fold(t, sources))
    assert looked == [3, 3, 3]  # the key and its two join columns
    assert got == tally(fold(t, sources, hot_keys="plain"))


def test_only_keys_above_the_share_are_found(spread):
    df = spread.range(20_000).select(F.when(F.col("id") % 10 < 3, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    keyed, names = with_join_keys(df, ["k"], [df.schema["k"].dataType])
    found = hotkeys.frequent_keys(keyed, names).collect()
    assert [(r["__k1"], r["splits"]) for r in found] == [(-1, 10)]
    assert hotkeys.frequent_keys(*with_join_keys(spread.range(5000), ["id"], [df.schema["k"].dataType])) is None


def test_small_sides_are_not_looked_at(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.merge.frequent_keys", lambda *a: pytest.fail("looked at a small side"))
    t, s = both_sides_hot(spark, 300)
    assert upsert(t, s, ["k"]).count() > 0
