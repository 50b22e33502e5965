"""Real files: listing, evolving reads, safe replacement, exactly-once intake."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001, rows
from tidemark.session import local_path, shared_dir
from tidemark.sinks.writers import replace_path, text_writer
from tidemark.sources.files import list_files, read_evolving
from tidemark.streaming.intake import file_intake


def test_list_files_glob(spark):
    root = shared_dir(spark, "listing")
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    text_writer(df, "csv").save(f"{root}/vehicle_cost/2026/01/29")
    text_writer(df, "json").save(f"{root}/fuel_txn/2026/01/29")
    names = [r.file_name for r in list_files(spark, root, "*.csv").collect()]
    assert names and all(n.endswith(".csv") for n in names)


def test_read_evolving_parquet(spark):
    a, b = shared_dir(spark, "a"), shared_dir(spark, "b")
    spark.createDataFrame([(1, "x")], "id int, old string").write.parquet(a)
    spark.createDataFrame([(2, 3.5)], "id int, added double").write.parquet(b)
    out = read_evolving(spark, "PARQUET", [a, b])
    assert sorted(out.columns) == ["added", "id", "old"]
    assert rows(out.select("id", "old", "added")) == [(1, "x", None), (2, None, 3.5)]


def test_replace_path_survives_self_overwrite(spark):
    path = shared_dir(spark, "target")
    spark.createDataFrame([(i,) for i in range(10)], "v int").write.parquet(path)
    cur = spark.read.parquet(path)
    n = replace_path(cur.filter("v % 2 = 0").withColumn("v", F.col("v") * 10), path)
    assert n == 5
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [0, 20, 40, 60, 80]


def test_stream_intake_exactly_once_and_late_file(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    feed, sink, ckpt = shared_dir(spark, "feed"), shared_dir(spark, "sink"), shared_dir(spark, "ckpt")
    early = ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    text_writer(early, "json", partition_by=["event_type"]).save(feed)
    schema = ev.drop("event_type").schema.add("event_type", "string")
    file_intake(spark, "JSON", feed, schema, sink, ckpt)
    n1 = spark.read.parquet(sink).count()
    assert n1 == early.count()
    # second run with no new file: nothing added
    file_intake(spark, "JSON", feed, schema, sink, ckpt)
    assert spark.read.parquet(sink).count() == n1
    # a late file dropped into an existing (older) folder is picked up next run
    late = ev.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).filter("event_type = 'click'")
    late_dir = os.path.join(local_path(feed), "event_type=click")
    tmp = shared_dir(spark, "late")
    text_writer(late.drop("event_type").coalesce(1), "json").save(tmp)
    for f in os.listdir(local_path(tmp)):
        if f.endswith(".json"):
            os.rename(os.path.join(local_path(tmp), f), os.path.join(late_dir, "late-" + f))
    file_intake(spark, "JSON", feed, schema, sink, ckpt)
    assert spark.read.parquet(sink).count() == n1 + late.count()
    assert spark.read.parquet(sink).select("event_id").distinct().count() == n1 + late.count()


def test_checkpoint_dir_is_shared_setting(spark):
    assert spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark, "x").startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))



def test_replace_partitioned_and_evolving_json(spark):
    path = shared_dir(spark, "part-target")
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(9)], "v int, src string")
    df.write.partitionBy("src").parquet(path)
    n = replace_path(spark.read.parquet(path).filter("v > 2"), path, partition_by=["src"])
    assert n == 6 and spark.read.parquet(path).count() == 6
    a, b = shared_dir(spark, "ja"), shared_dir(spark, "jb")
    text_writer(spark.createDataFrame([(1, "x")], "id int, old string"), "json").save(a)
    text_writer(spark.createDataFrame([(2, 2.5)], "id int, added double"), "json").save(b)
    out = read_evolving(spark, "JSON", [a, b])
    assert rows(out.select("id", "old", "added")) == [(1, "x", None), (2, None, 2.5)]


def test_observed_write_counts_in_same_pass(spark):
    from tidemark.sinks.writers import write_observed

    df = spark.createDataFrame([(i,) for i in range(10)], "v int")
    m = write_observed(df, shared_dir(spark, "obs"), metrics={"n_even": F.sum((F.col("v") % 2 == 0).cast("int"))})
    assert m["rows_loaded"] == 10 and m["n_even"] == 5


def test_bucketed_upsert_replay_is_idempotent(spark):
    from tidemark.operators.merge import upsert
    from tidemark.streaming.intake import BucketedUpsert

    target = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k long, a string")
    b0 = spark.createDataFrame([(1, "new1"), (25, "new25"), (3, "")], "k long, a string")
    b1 = spark.createDataFrame([(7, "new7"), (30, None)], "k long, a string")
    h = BucketedUpsert(shared_dir(spark, "bucketed"), ["k"], buckets=8)
    h.init(target)
    h(b0, 0)
    first = rows(h.latest(spark))
    h(b0, 0)  # the same batch again, as after a failure before the stream committed it
    assert rows(h.latest(spark)) == first
    h(b1, 1)
    expected = upsert(upsert(target, b0, ["k"]), b1, ["k"])
    assert rows(h.latest(spark).select("k", "a")) == rows(expected)
    # only the buckets a batch touches are rewritten: 8 bucket folders exist, untouched ones keep their files
    assert spark.read.parquet(h.path).select("__bucket").distinct().count() <= 8


def test_replace_drops_partitions_the_result_no_longer_has(spark):
    path = shared_dir(spark, "vanishing")
    spark.createDataFrame([(i, f"s{i % 3}") for i in range(9)], "v int, src string").write.partitionBy("src").parquet(path)
    replace_path(spark.read.parquet(path).filter("src <> 's2'"), path, partition_by=["src"])
    assert sorted({r.src for r in spark.read.parquet(path).collect()}) == ["s0", "s1"]
