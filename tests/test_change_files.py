"""The streaming upsert on change files: rows of the plain upsert, bytes of the batch."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.merge import DuplicateKeyError, upsert
from tidemark.session import local_path, shared_dir
from tidemark.sinks.snapshots import CommitConflict
from tidemark.streaming.changes import ChangeFileUpsert


def written(handler) -> int:
    """Bytes of all data files ever written to the table."""
    top = os.path.join(local_path(handler.table.path), "_snapshots")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet"))


def batches(spark):
    schema = "k long, a string, n double"
    return [spark.createDataFrame([(1, "one", None), (25, "", 2.5), (None, "nil", 1.0), (3, "", 9.0)], schema),
            spark.createDataFrame([(1, "", 7.0), (25, "late", None), (40, None, None)], schema),
            spark.createDataFrame([(1, "uno", "", 1), (41, "", "x", 2)], "K int, a string, extra string, more int"),
            spark.createDataFrame([(2, "two", "", None), (41, "b", "", 5)], "k long, a string, extra string, more int")]


def start(spark, **options):
    target = spark.createDataFrame([(i, f"v{i}", float(i)) for i in range(20)] + [(None, "", 0.0)],
                                   "k long, a string, n double")
    h = ChangeFileUpsert(spark, shared_dir(spark, "changes"), ["k"], "s", buckets=8, **options)
    h.init(target)
    return h, target


def folded(target, parts):
    out = target
    for b in parts:
        out = upsert(out, b, ["k"])
    return out


@pytest.mark.parametrize("share", [None, 0.0, 0.3])
def test_same_rows_as_the_upsert_batch_by_batch(spark, share):
    h, target = start(spark, compact_share=share)
    todo = batches(spark)
    for i, b in enumerate(todo):
        h(b, i)
        want = folded(target, todo[:i + 1])
        got = h.latest()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got.select(want.columns)) == rows(want), i
    kinds = [p.kind for p in h.table.commit().parts]
    assert kinds == {None: ["base"] + 4 * ["change"], 0.0: ["base"], 0.3: ["base", "change", "change"]}[share]
    before = rows(h.latest())
    h.compact()
    assert rows(h.latest()) == before and [p.kind for p in h.table.commit().parts] == ["base"]


def test_replayed_batches_are_skipped_and_old_ones_refused(spark):
    h, target = start(spark, compact_share=0.1)
    todo = batches(spark)
    h(todo[0], 0)
    h(todo[1], 1)
    at = h.table.commit().number
    again = ChangeFileUpsert(spark, h.table.path, ["k"], "s", buckets=8)  # after a restart, and a compaction
    again(todo[1], 1)
    assert again.table.commit().number == at
    assert rows(again.latest()) == rows(folded(target, todo[:2]))
    with pytest.raises(ValueError, match="another stream name"):
        again(todo[0], 0)
    other = ChangeFileUpsert(spark, h.table.path, ["k"], "other", buckets=8)
    other(todo[2], 0)
    want = folded(target, todo[:3])
    assert rows(other.latest().select(want.columns)) == rows(want)


def test_death_before_the_commit_leaves_the_table_as_it_was(spark, monkeypatch):
    h, target = start(spark, compact_share=None)
    b = batches(spark)[0]
    with monkeypatch.context() as m:
        m.setattr(type(h.table), "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            h(b, 0)
    assert rows(h.latest()) == rows(target)
    h(b, 0)
    assert rows(h.latest()) == rows(folded(target, [b]))


def test_bytes_written_follow_the_batch_not_the_table(spark):
    n = 40_000
    text = F.sha2(F.col("id").cast("string"), 512)
    h = ChangeFileUpsert(spark, shared_dir(spark, "wide"), ["id"], "s", buckets=32)
    h.init(spark.range(n).select("id", text.alias("v")))
    base = written(h)
    batch = spark.range(0, n, 100).select("id", F.concat(text, F.lit("!")).alias("v"))  # 1 % of the rows, all buckets
    assert batch.select(h._bucket(batch)).distinct().count() == 32
    h(batch, 0)
    assert written(h) - base < 0.03 * base
    assert h.latest().filter("v like '%!'").count() == n // 100 and h.latest().count() == n
    # a lookup gives the merged rows of its keys and reads no other bucket
    wanted = spark.createDataFrame([(100,), (101,), (-5,)], "id long")
    found = h.lookup(wanted)
    assert {r["id"]: r["v"].endswith("!") for r in found.collect()} == {100: True, 101: False}
    assert re.search(r"PushedFilters: \[[^\]]*__bucket", found._jdf.queryExecution().executedPlan().toString())


def test_a_few_changes_never_shuffle_the_base(spark):
    h, _ = start(spark, compact_share=None)
    h(batches(spark)[0], 0)
    plan = h.latest()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


def test_repeated_keys_empty_batches_and_other_writers(spark):
    h, target = start(spark, compact_share=None)
    b = batches(spark)[0]
    with pytest.raises(DuplicateKeyError):
        h(b.union(b), 0)
    h(b.limit(0), 0)
    assert rows(h.latest()) == rows(target)
    at = h.table.commit()
    h(b, 1)
    with pytest.raises(CommitConflict):
        h._new_base(target, 21, at)  # made from an older commit
    empty = ChangeFileUpsert(spark, shared_dir(spark, "empty"), ["k"], "s")
    empty.init(target.limit(0))
    empty(b, 0)
    assert rows(empty.latest()) == rows(upsert(target.limit(0), b, ["k"]))
    h.table.retain(1)
    assert rows(h.latest()) == rows(upsert(target, b, ["k"]))
