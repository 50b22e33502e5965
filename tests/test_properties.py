"""Property tests with small generated frames."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.history import current_rows_per_key, scd2_apply
from tidemark.operators.incremental import load_incremental, unprocessed_files
from tidemark.operators.merge import upsert
from tidemark.operators.union import per_source_upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 6))
vals = st.one_of(st.none(), st.sampled_from(["", "a", "b", "c"]))


def unique_by_key(rs):
    seen, out = set(), []
    for r in rs:
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


@SETTINGS
@given(st.lists(st.tuples(keys, vals, st.one_of(st.none(), st.integers(0, 9))), max_size=8),
       st.lists(st.tuples(keys, vals, st.one_of(st.none(), st.integers(0, 9))), max_size=8))
def test_upsert_idempotent_and_identity(spark, t_rows, s_rows):
    schema = "k int, a string, n int"
    t = spark.createDataFrame(unique_by_key(t_rows), schema)
    s = spark.createDataFrame(unique_by_key(s_rows), schema)
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    assert rows(twice) == rows(once)
    # an empty source changes nothing
    assert rows(upsert(t, s.limit(0), ["k"])) == rows(t)
    # every target key survives, every source key appears
    out_keys = {r.k for r in once.collect()}
    assert {r[0] for r in t_rows} | {r[0] for r in s_rows} == out_keys


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["x", "y", None])), max_size=8),
       st.lists(st.tuples(st.integers(0, 7), st.sampled_from(["x", "y", "z", None])), max_size=8))
def test_scd2_one_current_row_and_rerun_noop(spark, d_rows, s_rows):
    d0 = dt.date(2024, 1, 1)
    dim = spark.createDataFrame([(k, c, d0, None, True) for k, c in unique_by_key(d_rows)],
                                "id int, city string, start_date date, end_date date, is_current boolean")
    src = spark.createDataFrame(unique_by_key(s_rows), "id int, city string")
    out = scd2_apply(dim, src, ["id"], ["city"], "2024-06-01")
    assert current_rows_per_key(out, ["id"]).count() == 0
    assert rows(scd2_apply(out, src, ["id"], ["city"], "2024-07-01")) == rows(out)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["s1", "s2", "s3"])), max_size=10),
       st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["s2", "s4"])), max_size=10))
def test_per_source_upsert_leaves_other_sources(spark, b_rows, n_rows):
    base = spark.createDataFrame(b_rows, "v int, filename string")
    new = spark.createDataFrame(n_rows, "v int, filename string")
    out = per_source_upsert(base, new)
    new_sources = {f for _, f in n_rows}
    untouched = sorted(r for r in b_rows if r[1] not in new_sources)
    assert sorted(tuple(r) for r in out.collect() if r.filename not in new_sources) == untouched
    for f in new_sources:
        got = sorted(tuple(r) for r in out.collect() if r.filename == f)
        old = [r for r in b_rows if r[1] == f]
        fresh = [r for r in n_rows if r[1] == f]
        expect = sorted(set(old) | set(fresh)) if old else sorted(fresh)
        assert got == expect


def test_unprocessed_plus_processed_is_listing(spark):
    listing = spark.createDataFrame([("a", f"a_{i}.csv") for i in range(6)], "source_name string, file_name string")
    log = spark.createDataFrame([("a", "a_1.csv", "SUCCESS"), ("a", "a_2.csv", "FAILED"), ("a", "a_4.csv", "SUCCESS")],
                                "source_name string, file_name string, status string")
    todo = {r.file_name for r in unprocessed_files(listing, log).collect()}
    done = {r.file_name for r in log.filter(F.col("status") == "SUCCESS").collect()}
    assert todo | done == {f"a_{i}.csv" for i in range(6)} and not (todo & done)


def test_full_equals_incremental_plus_older(spark):
    from conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    wm = "2024-01-15 00:00:00"
    inc = load_incremental(ev, "ts", wm)
    older = ev.filter(F.col("ts") <= F.lit(wm).cast("timestamp_ntz"))
    assert inc.count() + older.count() == ev.count()
    assert inc.join(older, "event_id").count() == 0


@SETTINGS
@given(st.lists(st.tuples(keys, vals, st.one_of(st.none(), st.integers(0, 9))), max_size=6),
       st.lists(st.tuples(keys, vals, st.one_of(st.none(), st.integers(0, 9))), max_size=6),
       st.lists(st.tuples(keys, vals, vals), max_size=6))
def test_merge_all_equals_fold_for_unique_keys(spark, t_rows, s1_rows, s2_rows):
    from tidemark.operators.merge import fold, merge_all

    t = spark.createDataFrame(unique_by_key(t_rows), "k int, a string, n int")
    s1 = spark.createDataFrame(unique_by_key(s1_rows), "k int, a string, n int")
    s2 = spark.createDataFrame(unique_by_key(s2_rows), "k int, a string, extra string")  # adds a column
    srcs = [(s1, ["k"]), (s2, ["k"])]
    one, chain = merge_all(t, srcs), fold(t, srcs)
    assert one.columns == chain.columns
    assert rows(one) == rows(chain)


def test_unique_keys_upsert_matches_join_form_on_driver_tables(spark):
    from conftest import SF001
    from tidemark.plans.merge_queries import customer_changes, customer_target

    t, s = customer_target(spark, SF001), customer_changes(spark, SF001)
    assert rows(upsert(t, s, ["c_custkey"], unique_keys=True)) == rows(upsert(t, s, ["c_custkey"]))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["x", "y", None])), max_size=8),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 7)), st.sampled_from(["x", "z", None])), max_size=8))
def test_scd2_against_plain_python(spark, d_rows, s_rows):
    d0, d1, day = dt.date(2024, 1, 1), dt.date(2023, 1, 1), dt.date(2024, 6, 1)
    cur, src_rows = unique_by_key(d_rows), unique_by_key(s_rows)
    dim = spark.createDataFrame([(k, c, d0, None, True) for k, c in cur] + [(1, "old", d1, d0, False)],
                                "id int, city string, start_date date, end_date date, is_current boolean")
    src = spark.createDataFrame(src_rows + [r for r in src_rows if r[0] is not None], "id int, city string")
    new = {k: c for k, c in src_rows if k is not None}
    want = [(1, "old", d1, d0, False)]
    for k, c in cur:
        moved = k in new and new[k] != c
        want.append((k, c, d0, day if moved else None, not moved))
    have = dict(cur)
    want += [(k, c, day, None, True) for k, c in src_rows if k is None or k not in have or have[k] != c]
    got = rows(scd2_apply(dim, src, ["id"], ["city"], "2024-06-01"))
    assert got == sorted(want, key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_long_fold_with_checkpoints_matches_single_aggregation(spark):
    from tidemark.operators.merge import fold, merge_all

    t = spark.createDataFrame([(i, f"t{i}", None) for i in range(10)], "k int, a string, b string")
    srcs = []
    for j in range(6):
        rows_j = [(i, "" if (i + j) % 4 == 0 else f"s{j}_{i}", None if i % 3 else f"b{j}") for i in range(j, 12, 2)]
        srcs.append((spark.createDataFrame(rows_j, "k int, a string, b string"), ["k"]))
    chained = fold(t, srcs, stage_every=2)  # cuts lineage with reliable checkpoints twice
    assert rows(chained) == rows(merge_all(t, srcs))
