"""Batches whose columns change their type between files (Q3)."""

from __future__ import annotations

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType, _parse_datatype_string

from conftest import rows

from tidemark.session import shared_dir
from tidemark.sources.evolve import join_schemas, join_types, schema_groups, type_evolution
from tidemark.sources.files import read_evolving


def write(spark, data, schema, fmt="parquet", path=None, mode="errorifexists"):
    path = path or shared_dir(spark, "batch")
    spark.createDataFrame(data, schema).coalesce(1).write.mode(mode).format(fmt).save(path)
    return path


def t(text):
    return _parse_datatype_string(text)


@pytest.mark.parametrize("a,b,want,exact", [
    ("int", "bigint", "bigint", "bigint"), ("int", "double", "double", "double"),
    ("bigint", "double", "double", "string"), ("float", "double", "double", "double"),
    ("bigint", "decimal(10,2)", "decimal(21,2)", "decimal(21,2)"),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)", "decimal(12,4)"),
    ("decimal(38,0)", "decimal(10,5)", "double", "string"), ("decimal(10,2)", "double", "double", "string"),
    ("int", "string", "string", "string"), ("boolean", "int", "string", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz", "timestamp_ntz"), ("date", "int", "string", "string"),
    ("struct<a:int>", "string", "string", "string"), ("array<int>", "array<bigint>", "array<bigint>", "array<bigint>"),
    ("struct<a:int,b:date>", "struct<A:string,c:int>", "struct<a:string,b:date,c:int>", "struct<a:string,b:date,c:int>"),
])
def test_join_of_two_types(spark, a, b, want, exact):
    assert join_types(t(a), t(b)).simpleString() == want
    assert join_types(t(b), t(a)).simpleString().lower() == want or "struct" in want
    assert join_types(t(a), t(b), exact=True).simpleString() == exact


def test_join_does_not_depend_on_the_order(spark):
    types = ["int", "bigint", "decimal(10,2)", "decimal(30,12)", "float", "double", "string", "boolean", "date"]
    for three in itertools.combinations(types, 3):
        for exact in (False, True):
            found = {join_schemas([StructType().add("x", t(x)) for x in order], exact)["x"].dataType.simpleString()
                     for order in itertools.permutations(three)}
            assert len(found) == 1, (three, found)


def test_int_in_one_file_and_string_in_another(spark):
    a = write(spark, [(1, 7), (2, None)], "id int, v int")
    b = write(spark, [(3, "x"), (4, "08")], "id bigint, V string")
    out = read_evolving(spark, "PARQUET", [a, b])
    assert out.dtypes == [("id", "bigint"), ("v", "string")]
    assert rows(out) == [(1, "7"), (2, None), (3, "x"), (4, "08")]
    orc = [write(spark, [(1, 7)], "id int, v int", "orc"), write(spark, [(2, "y")], "id int, v string", "orc")]
    assert rows(read_evolving(spark, "ORC", orc)) == [(1, "7"), (2, "y")]


def test_files_of_one_batch_that_differ(spark):
    path = write(spark, [(1, 2**62)], "id int, v bigint")
    write(spark, [(2, 0.5)], "id int, v double", path=path, mode="append")
    write(spark, [(3, 5)], "id int, v bigint", path=path, mode="append")
    assert rows(read_evolving(spark, "PARQUET", [path])) == [(1, 2.0**62), (2, 0.5), (3, 5.0)]
    assert rows(read_evolving(spark, "PARQUET", [path], exact=True)) == [(1, str(2**62)), (2, "0.5"), (3, "5")]
    assert sorted(len(g.paths) for g in schema_groups(spark, "parquet", [path])) == [1, 2]


def test_partition_columns_stay_when_a_batch_is_cut(spark):
    path = shared_dir(spark, "batch")
    spark.createDataFrame([(1, "a")], "v int, src string").write.partitionBy("src").parquet(path)
    spark.createDataFrame([("x", "b")], "v string, src string").write.mode("append").partitionBy("src").parquet(path)
    assert rows(read_evolving(spark, "PARQUET", [path]).select("src", "v")) == [("a", "1"), ("b", "x")]


def test_nested_columns_join_by_field(spark):
    a = write(spark, [((1, dt.date(2024, 1, 2)), [1, 2], {"k": 1}), (None, None, None)], "s struct<a:int,d:date>, l array<int>, m map<string,int>")
    b = write(spark, [(("x", 4), [2**40], {"k": 1.5})], "s struct<A:string,e:int>, l array<bigint>, m map<string,double>")
    c = write(spark, [("text", [None], {})], "s string, l array<int>, m map<string,int>")
    out = read_evolving(spark, "PARQUET", [a, b])
    assert out.schema.simpleString() == "struct<s:struct<a:string,d:date,e:int>,l:array<bigint>,m:map<string,double>>"
    got = {str(r.l): (r.s, r.m) for r in out.collect()}
    assert tuple(got["[1, 2]"][0]) == ("1", dt.date(2024, 1, 2), None) and got["[1, 2]"][1] == {"k": 1.0}
    assert got["None"] == (None, None) and tuple(got[str([2**40])][0]) == ("x", None, 4)
    texts = {r.s for r in read_evolving(spark, "PARQUET", [a, c]).collect()}
    assert texts == {'{"a":1,"d":"2024-01-02"}', None, "text"}


def test_one_scan_for_each_schema_and_pruned_columns(spark):
    paths = [write(spark, [(i, i)], "id int, v int") for i in range(6)]
    paths += [write(spark, [(i, str(i))], "id int, v string") for i in range(6, 9)]
    paths += [write(spark, [(9, 9)], "id int, v int")]
    out = read_evolving(spark, "PARQUET", paths)
    plan = out.select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "v:" not in plan
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,4)]" in out.filter("id > 4")._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == [(i, str(i)) for i in range(10)]
    seen = {(r.observed_type, r.joined_type, r.n_paths) for r in type_evolution(spark, "parquet", paths).filter("column_name = 'v'").collect()}
    assert seen == {("int", "string", 7), ("string", "string", 3)}


def test_empty_batches_and_other_formats(spark):
    empty = write(spark, [], "id int, v decimal(5,2)")
    full = write(spark, [(1, 2)], "id int, v bigint")
    assert rows(read_evolving(spark, "PARQUET", [empty, full])) == [(1, Decimal("2.00"))]
    with pytest.raises(ValueError):
        read_evolving(spark, "PARQUET", [])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_evolving(spark, "PARQUET", [full + "-absent"])
    j = [write(spark, [(1, 5)], "id int, v int", "json"), write(spark, [(2, "x")], "id int, v string", "json")]
    assert rows(read_evolving(spark, "JSON", j)) == [(1, "5"), (2, "x")]
    c = [shared_dir(spark, "csv"), shared_dir(spark, "csv")]
    spark.createDataFrame([(1, 5)], "id int, v int").write.option("header", True).csv(c[0])
    spark.createDataFrame([("x", 2)], "v string, id int").write.option("header", True).csv(c[1])
    assert rows(read_evolving(spark, "CSV", c, inferSchema=True).select("id", "v")) == [(1, "5"), (2, "x")]
