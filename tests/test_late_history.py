"""Late deliveries, null keys and the stored dimension."""

from __future__ import annotations

import itertools
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import initial_load, merged_versions, scd2_apply, scd2_insert, scd2_new_rows, scd2_store
from tidemark.sinks.snapshots import SnapshotTable

DIM = "k string, v string, start_date date, end_date date, is_current boolean"


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_any_arrival_order_gives_the_same_history(spark):
    got = [("a", "x", "2024-01-01"), ("a", "x", "2024-03-01"), ("a", "y", "2024-02-01"), ("b", None, "2024-01-15"), ("a", "y", "2024-02-01")]
    want = None
    for order in itertools.islice(itertools.permutations(got), 0, 120, 29):
        dim = spark.createDataFrame([], DIM)
        for d in order:
            dim = scd2_insert(dim, spark.createDataFrame([d], "k string, v string, day string"), ["k"], "day")
        rows = rows_of(merged_versions(dim, ["k"], ["v"]))
        assert want is None or rows == want
        want = rows
    assert want == [("a", "x", "2024-01-01", "2024-02-01", "False"), ("a", "x", "2024-03-01", "None", "True"),
                    ("a", "y", "2024-02-01", "2024-03-01", "False"), ("b", "None", "2024-01-15", "None", "True")]


def test_equal_neighbours_merge_and_untouched_keys_stay(spark):
    dim = spark.createDataFrame([], DIM)
    src = spark.createDataFrame([("a", "x", "2024-01-01"), ("a", "x", "2024-02-01"), ("b", "z", "2024-01-01")], "k string, v string, day string")
    dim = scd2_insert(dim, src, ["k"], "day")
    assert dim.count() == 3
    assert rows_of(merged_versions(dim, ["k"], ["v"])) == [("a", "x", "2024-01-01", "None", "True"), ("b", "z", "2024-01-01", "None", "True")]
    again = scd2_insert(dim, src, ["k"], "day")
    assert rows_of(again) == rows_of(dim)


def test_contradicting_or_incomplete_deliveries_are_refused(spark):
    dim = spark.createDataFrame([], DIM)
    schema = "k string, v string, day string"
    for bad in ([("a", "x", "2024-01-01"), ("a", "y", "2024-01-01")], [("a", "x", None)], [(None, "x", "2024-01-01")]):
        with pytest.raises(Exception, match="different states|without key or date"):
            scd2_insert(dim, spark.createDataFrame(bad, schema), ["k"], "day").collect()


def test_null_keys_once_makes_a_rerun_a_no_op(spark):
    src = spark.createDataFrame([("a", "x"), (None, "n"), (None, "n"), (None, None)], "k string, v string")
    dim = initial_load(src.limit(0), "2024-01-01")
    one = scd2_apply(dim, src, ["k"], ["v"], "2024-01-01", null_keys="once")
    assert one.count() == 3
    assert rows_of(scd2_apply(one, src, ["k"], ["v"], "2024-02-01", null_keys="once")) == rows_of(one)
    assert scd2_new_rows(one, src, ["k"], ["v"], "2024-02-01", null_keys="once").count() == 0
    assert scd2_apply(one, src, ["k"], ["v"], "2024-02-01").count() == 6  # the reference's way
    with pytest.raises(Exception, match="without a key"):
        scd2_apply(dim, src, ["k"], ["v"], "2024-01-01", null_keys="refuse").collect()
    with pytest.raises(ValueError, match="null_keys"):
        scd2_apply(dim, src, ["k"], ["v"], "2024-01-01", null_keys="x")


def test_a_stored_dimension_writes_open_rows_and_newly_closed_ones_only(spark, tmp_path):
    path = str(tmp_path / "dim")
    table = SnapshotTable(spark, path)
    for version in range(8):  # every key changes: a long closed history
        src = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit(f"v{version}-"), F.sha2(F.concat("id", F.lit(version)), 256)).alias("v"))
        scd2_store(table, src, ["k"], ["v"], f"2024-01-{version + 1:02}")
    assert table.commit().rows == 16_000
    assert [tuple(map(str, r)) for r in table.read().filter("k = 7").orderBy("start_date").select("start_date", "end_date", "is_current").collect()] == [
        (f"2024-01-{i:02}", f"2024-01-{i + 1:02}" if i < 8 else "None", str(i == 8)) for i in range(1, 9)]
    before = set(os.listdir(f"{path}/_snapshots"))

    def size(folders):
        return sum(os.path.getsize(os.path.join(d, f)) for name in folders for d, _, files in os.walk(f"{path}/_snapshots/{name}") for f in files)

    named = {p.folder.split("/")[0] for p in table.commit().parts}
    changed = table.read(kind="open").select("k", F.when(F.col("k") % 100 == 0, F.lit("new")).otherwise(F.col("v")).alias("v"))
    commit = scd2_store(table, changed, ["k"], ["v"], "2024-03-01")
    written = set(os.listdir(f"{path}/_snapshots")) - before
    assert commit.rows_loaded == 2020  # 2,000 open rows and the 20 just closed
    assert size(written) < 0.25 * size(named)
    assert table.read().count() == 16_020 and table.read(kind="open").count() == 2000
    again = scd2_store(table, changed.filter("k is not null"), ["k"], ["v"], "2024-04-01")
    assert again.rows == 16_020
