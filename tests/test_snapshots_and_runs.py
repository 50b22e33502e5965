"""Snapshot tables, and runs that die between any two of their steps."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.operators.quality import Rule
from tidemark.operators.runs import Zones, run_file_pipeline, run_table_loads
from tidemark.operators.standardize import run_standardization
from tidemark.sinks import snapshots
from tidemark.sinks.snapshots import CommitConflict, SnapshotTable
from tidemark.sources.target import read_target


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- snapshot tables -------------------------------------------------------------------------

def test_readers_see_the_old_or_the_new_table_whole(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.commit() is None
    first = table.replace(spark.range(10).withColumn("v", F.lit("a")))
    assert (first.number, first.rows, first.rows_loaded) == (1, 10, 10)
    began = table.read()  # a reader that starts before the replacement
    table.replace(table.read().filter("id < 4").withColumn("v", F.lit("b")))  # reads what it replaces
    assert began.count() == 10 and {r.v for r in began.collect()} == {"a"}
    assert rows_of(table.read()) == [(i, "b") for i in range(4)]
    assert rows_of(table.read(1)) == [(i, "a") for i in range(10)]
    assert rows_of(read_target(spark, str(tmp_path / "t"), first and table.read().schema)) == [(i, "b") for i in range(4)]


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(5))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_publish", die)  # everything is written, nothing is committed
        with pytest.raises(RuntimeError, match="lost"):
            table.replace(spark.range(100))
    with pytest.raises(Exception, match="boom"):
        table.replace(spark.range(100).withColumn("x", F.when(F.col("id") > 98, F.raise_error(F.lit("boom"))).otherwise(F.lit("x"))))
    assert rows_of(table.read()) == [(i,) for i in range(5)]
    table.replace(spark.range(6))
    table.replace(spark.range(7))
    assert table.retain(1) == 4  # the two left-overs and the two replaced folders
    assert rows_of(table.read()) == [(i,) for i in range(7)] and table.numbers() == [3]


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    now = table.commit()
    table.append(spark.range(3, 5))
    with pytest.raises(CommitConflict):
        table._publish(snapshots.Commit(now.number + 1, now.schema, now.parts, "other", 0))
    assert rows_of(table.read()) == [(i,) for i in range(5)]
    assert not [n for n in os.listdir(tmp_path / "t" / "_commits") if n.startswith(".draft")]


def test_null_columns_go_and_new_ones_come(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([(1, None, "x")], "a int, b string, c string"), drop_null_columns=True)
    assert table.read().columns == ["a", "c"]
    table.append(spark.createDataFrame([(2, "y", 7)], "a int, c string, d long"))
    assert rows_of(table.read()) == [(1, "x", None), (2, "y", 7)]
    with pytest.raises(ValueError, match="column c"):
        table.append(spark.createDataFrame([(3, 3)], "a int, c int"))
    table.replace(table.read().limit(0), drop_null_columns=True)
    assert table.read().columns == ["a", "c", "d"] and table.read().count() == 0


def test_appends_carry_the_high_mark(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    ts = "id long, ts timestamp_ntz"
    load = lambda *days: spark.sql(f"SELECT id, timestamp_ntz'2024-01-01 00:00:00.000005' + make_dt_interval(id) AS ts FROM VALUES "  # noqa: E731
                                   f"{','.join(f'({d}L)' for d in days)} AS t(id)").select("id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    table.append(load(1, 5, 3), mark="ts")
    assert table.commit().high == "2024-01-06 00:00:00.000005"
    table.append(load(2), mark="ts")  # an older row doesn't move it back
    assert table.commit().high == "2024-01-06 00:00:00.000005" and table.read().count() == 4
    assert table.append(spark.createDataFrame([], ts), mark="ts").rows_loaded == 0
    assert table.commit().number == 2


def test_standardisation_writes_the_table_once(spark, tmp_path, monkeypatch):
    written = []
    real = snapshots.write_observed
    monkeypatch.setattr(snapshots, "write_observed", lambda df, path, *a, **k: written.append(path) or real(df, path, *a, **k))
    contract = spark.createDataFrame([], "a int, b string").schema
    out = run_standardization(spark, str(tmp_path / "t"), contract, {}, lambda _: None)
    assert out["rows_loaded"] == 0 and len(written) == 1


def test_an_ordinary_folder_stays_one_until_it_is_adopted(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(path)
    contract = spark.createDataFrame([], "a int, b string").schema
    assert run_standardization(spark, path, contract, {}, lambda _: None)["rows_loaded"] == 1
    assert rows_of(spark.read.parquet(path)) == [(1, "x")] and not SnapshotTable(spark, path).exists()
    SnapshotTable(spark, path).adopt("a")
    assert SnapshotTable(spark, path).commit().high == "1" and rows_of(read_target(spark, path, contract)) == [(1, "x")]
    assert run_standardization(spark, path, contract, {}, lambda _: None)["rows_loaded"] == 1
    assert SnapshotTable(spark, path).commit().number == 2


# --- table loads -----------------------------------------------------------------------------

CONFIG = [{"table_name": "inc", "load_type": "INCR", "watermark_column": "ts", "backfill_days": None},
          {"table_name": "full", "load_type": "FULL", "watermark_column": "ts", "backfill_days": None},
          {"table_name": "back", "load_type": "BACKFILL", "watermark_column": "ts", "backfill_days": 3}]


def source(spark, n=10):
    return spark.range(n).withColumn("ts", F.expr("cast(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int)) as timestamp_ntz)"))


def test_table_loads_that_die_before_any_commit_equal_one_clean_run(spark, tmp_path, monkeypatch):
    """The run dies at its k-th commit (and at the audit), then runs again under another id."""
    for k in range(4):
        root, seen = str(tmp_path / f"r{k}"), []
        real = SnapshotTable._publish

        def publish(self, commit, seen=seen, k=k):
            seen.append(1)
            if len(seen) > k:
                raise KeyboardInterrupt
            return real(self, commit)

        with monkeypatch.context() as m:
            m.setattr(SnapshotTable, "_publish", publish)
            if k == 3:
                m.setattr(runs, "append_log", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                run_table_loads(spark, CONFIG, lambda _: source(spark), root, as_of="2024-01-10", run_id="one", side_by_side=1)
        for run_id in ("two", "two", "three"):  # also the same id again
            out = run_table_loads(spark, CONFIG, lambda _: source(spark), root, as_of="2024-01-10", run_id=run_id)
            assert {r.status for r in out.collect()} == {"SUCCESS"}
        ids = {c["table_name"]: sorted(r.id for r in read_target(spark, f"{root}/{c['table_name']}", source(spark).schema).collect()) for c in CONFIG}
        assert ids == {"inc": list(range(10)), "full": list(range(10)), "back": [6, 7, 8, 9]}


def test_incremental_loads_go_on_from_their_commit(spark, tmp_path):
    root = str(tmp_path / "r")
    for n, run_id in ((4, "a"), (4, "b"), (9, "c")):
        run_table_loads(spark, CONFIG[:1], lambda _, n=n: source(spark, n), root, as_of="2024-01-10", run_id=run_id)
    source(spark, 3).write.parquet(f"{root}/old/inc")  # an ordinary folder is taken over
    run_table_loads(spark, CONFIG[:1], lambda _: source(spark), f"{root}/old", as_of="2024-01-10", run_id="d")
    assert sorted(r.id for r in SnapshotTable(spark, f"{root}/old/inc").read().collect()) == list(range(10))
    table = SnapshotTable(spark, f"{root}/inc")
    assert Counter(r._load_id for r in table.read().collect()) == {"a": 4, "c": 5}
    assert table.commit().high == "2024-01-09 00:00:00"


def test_an_empty_config_and_a_table_that_fails(spark, tmp_path):
    assert run_table_loads(spark, [], lambda _: None, str(tmp_path / "e"), as_of="2024-01-10", run_id="x").count() == 0

    def read(name):
        if name == "full":
            raise FileNotFoundError(name)
        return source(spark)

    got = run_table_loads(spark, CONFIG, read, str(tmp_path / "f"), as_of="2024-01-10", run_id="x").collect()
    assert {r.source_name: r.status for r in got} == {"inc": "SUCCESS", "full": "FAILED", "back": "SUCCESS"}


# --- the file pipeline -----------------------------------------------------------------------

FEED = "id long, value double"


def land(root, feed, day, records):
    folder = root / feed / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{feed}_{day}.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def pipeline(spark, landing, zones, run_id, rules=(Rule("v", "value", "range", (0, 100)),), refs=None):
    schema = spark.createDataFrame([], FEED).schema
    feeds = spark.createDataFrame([(f, f"{f}_*.json", "Y") for f in ("a", "b")], "source_name string, file_pattern string, expected_daily string")
    registry = spark.createDataFrame([(s, f, "number") for s in ("a", "b") for f in ("id", "value")], "source_name string, field string, type string")
    name = F.element_at(F.split("file_path", "/"), -1)
    return run_file_pipeline(spark, feeds, str(landing), zones, source_of=F.split(name, "_")[0],
                             date_of=F.to_date(F.regexp_extract(name, r"_(\d{8})", 1), "yyyyMMdd"), schema=schema, registry=registry,
                             rules=rules, run_id=run_id, run_date="2024-02-01", since="2024-02-01", refs=refs)


def zones_hold(spark, zones):
    zone = lambda z, *c: rows_of(spark.read.parquet(f"{zones.root}/{z}").select(*c))
    return {"bronze": zone("bronze", "source_name", "id"), "silver": zone("silver", "source_name", "id"),
            "quarantine": zone("quarantine", "source_name", "id", "failed_rules"), "log": zone("log", "source_name", "file_name")}


def test_file_pipeline_killed_between_any_two_steps_equals_one_clean_run(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    land(landing, "a", "20240101", [{"id": i, "value": i * 30.0} for i in range(6)])
    land(landing, "b", "20240101", [{"id": 10, "value": 1.0}, {"id": 11, "value": 2.0, "more": 1}])
    clean = Zones(str(tmp_path / "clean"))
    pipeline(spark, landing, clean, "only")
    want = zones_hold(spark, clean)
    assert want["quarantine"] == [("a", 4, "v"), ("a", 5, "v"), ("b", 10, "schema drift"), ("b", 11, "schema drift")]
    assert want["silver"] == [("a", i) for i in range(4)] and len(want["log"]) == 2
    real = runs.replace_load
    for step in (1, 2, 4, 5, 8, 10):  # of five writes a feed: intent, bronze, quarantine, silver, log
        zones, seen = Zones(str(tmp_path / f"z{step}")), []

        def dying(*args, seen=seen, step=step):
            seen.append(1)
            if len(seen) == step:
                raise KeyboardInterrupt
            return real(*args)

        with monkeypatch.context() as m:
            m.setattr(runs, "replace_load", dying)
            with pytest.raises(KeyboardInterrupt):
                pipeline(spark, landing, zones, "one")
        pipeline(spark, landing, zones, "two")
        assert zones_hold(spark, zones) == want, step
        assert runs.open_intents(spark, zones) == []


def test_new_files_after_a_broken_run_and_a_feed_that_fails(spark, tmp_path, monkeypatch):
    landing, zones = tmp_path / "landing", Zones(str(tmp_path / "z"))
    land(landing, "a", "20240101", [{"id": 1, "value": 1.0}])
    land(landing, "b", "20240101", [{"id": 2, "value": 2.0}, {"id": 9, "value": -1.0}])
    real = runs._load_files

    def broken(spark_, source_, *args):
        if source_ == "a":
            raise OSError("bad feed")
        return real(spark_, source_, *args)

    with monkeypatch.context() as m:
        m.setattr(runs, "_load_files", broken)
        pipeline(spark, landing, zones, "one")
    assert zones_hold(spark, zones)["silver"] == [("b", 2)]
    land(landing, "a", "20240102", [{"id": 3, "value": 3.0}])  # in a folder of its own, after the broken run
    pipeline(spark, landing, zones, "two")
    held = zones_hold(spark, zones)
    assert held["silver"] == [("a", 1), ("a", 3), ("b", 2)] and len(held["log"]) == 3
    before = spark.read.parquet(f"{zones.root}/audit").count()
    pipeline(spark, landing, zones, "three")
    assert zones_hold(spark, zones) == held
    audit = spark.read.parquet(f"{zones.root}/audit")
    assert audit.count() == before + 1 and audit.filter("status = 'FAILED'").count() == 1


def test_the_load_id_is_that_of_the_file_set(spark):
    files = [("a", f"/x/{i}.json", f"{i}.json") for i in range(20)] + [("b", "/x/1.json", "1.json")]
    ids = lambda rows: {r.source_name: r.load_id for r in runs.load_ids(spark.createDataFrame(rows, "source_name string, file_path string, file_name string")).collect()}
    assert ids(files) == ids(files[::-1]) and ids(files)["a"] != ids(files[1:])["a"] and ids(files)["a"] != ids(files)["b"]


def test_file_pipeline_with_a_rules_table_for_each_feed(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", "20240101", [{"id": i, "value": i * 30.0} for i in range(6)] + [{"id": 5, "value": 1.0}])
    land(landing, "b", "20240101", [{"id": 10, "value": 500.0}])
    table = [("a", "v", "value", "range", '{"max": 100}'), ("a", "u", "id", "unique", None),
             ("a", "p", "id", "referential", '{"table": "known", "column": "id"}'), ("b", "w", "absent", "in_set", "{}")]
    rules = spark.createDataFrame(table, "table_name string, rule_id string, column_name string, check string, argument string")
    zones = Zones(str(tmp_path / "z"))
    pipeline(spark, landing, zones, "r1", rules, {"known": spark.range(1, 100)})
    found = zones_hold(spark, zones)
    assert found["silver"] == [("a", 1), ("a", 2), ("a", 3)]
    assert found["quarantine"] == [("a", 0, "p"), ("a", 4, "v"), ("a", 5, "u"), ("a", 5, "u,v")]
    assert ("b", 10) in found["bronze"] and [f[0] for f in found["log"]] == ["a"]
    audit = {r.source_name: (r.status, r.error_message) for r in spark.read.parquet(zones.audit).collect()}
    assert audit["a"][0] == "SUCCESS" and audit["b"][0] == "FAILED" and "rule w" in audit["b"][1]
    fixed = rules.filter("table_name = 'a'")
    pipeline(spark, landing, zones, "r2", fixed, {"known": spark.range(1, 100)})
    assert ("b", 10) in zones_hold(spark, zones)["silver"]
