"""Paths of nested records against a plain walk, and what is missing from whom."""

from __future__ import annotations

import json
import random
from collections import Counter

from conftest import rows
from tidemark.operators.nested_drift import depth, json_path_drift, observed_paths

DEEP = {"x": 1}
for _ in range(40):
    DEEP = {"d": [DEEP]}
RECORDS = [
    ("s", '{"a": 1, "b": {"c": "t", "e": [1, "two", null, {"f": true}]}}'),
    ("s", '{"a": 2.5, "b": {"c": null}, "we.ird": {"[q]": 1, "ti`ck": 2}}'),
    ("s", '{"a": "text with { [ \\" ] }", "b": []}'),
    ("s", '[[1, 2], {"a": 3}]'),
    ("s", '7'), ("s", '{}'), ("s", 'no json {'), ("s", None), ("s", ''),
    ("t", json.dumps(DEEP)), ("t", '{"b": {}}'), ("t", '{"b": {}}'), (None, '{"a": [[]]}'),
]


def walk(value, path, out):
    kinds = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}
    if path:
        out[path, kinds.get(type(value), "number")] += 1
    if isinstance(value, dict):
        for k, v in value.items():
            name = "`" + k.replace("`", "``") + "`" if set(k) & set(".[]`") else k
            walk(v, f"{path}.{name}" if path else name, out)
    if isinstance(value, list):
        for v in value:
            walk(v, path + "[]", out)


def test_paths_equal_a_plain_walk(spark):
    raw = spark.createDataFrame(RECORDS, "source_name string, record string").repartition(3)
    want = Counter()
    for source, text in RECORDS:
        one = Counter()
        try:
            walk(json.loads(text), "", one)
        except (TypeError, ValueError):
            continue
        for (path, kind), n in one.items():
            want[source, path, kind] += n
    got = {(r["source_name"], r["path"], r["kind"]): r["n_values"] for r in observed_paths(raw, "record", "source_name").collect()}
    assert got == dict(want)
    assert depth(raw, "record") == 81


def test_missing_is_counted_against_the_parent_objects(spark):
    raw = spark.createDataFrame(RECORDS, "source_name string, record string")
    wanted = [("a", "number"), ("b", "object"), ("b.c", "string"), ("b.e[].f", "boolean"), ("b.e[]", "number"),
              ("gone", "object"), ("gone.child", "string"), ("`we.ird`.`[q]`", "number"), ("`we.ird`.`z.z`", "number")]
    reg = spark.createDataFrame([("s", f, k) for f, k in wanted], "source_name string, field string, type string")
    out = json_path_drift(raw.filter("source_name = 's'"), "record", "source_name", reg)
    missing = {r["field"]: r["n_records"] for r in out.filter("kind = 'missing'").collect()}
    # nine records; six lack `a`, two of the objects at b are objects, both with c, and so on
    assert missing == {"a": 6, "b": 6, "gone": 9, "`we.ird`.`z.z`": 1}
    kinds = {(r["field"], r["observed_type"]): r["kind"] for r in out.filter("kind <> 'missing'").collect()}
    assert kinds["a", "number"] == "ok" and kinds["a", "string"] == "retyped" and kinds["b.c", "null"] == "retyped"
    assert kinds["b.e[].f", "boolean"] == "ok" and kinds["b.e[]", "string"] == "retyped" and kinds["[][]", "number"] == "new"


def test_flat_and_empty_feeds(spark):
    empty = spark.createDataFrame([], "source_name string, record string")
    reg = spark.createDataFrame([("s", "a", "number")], "source_name string, field string, type string")
    assert rows(json_path_drift(empty, "record", "source_name", reg)) == []
    flat = spark.createDataFrame([("s", "1"), ("s", None)], "source_name string, record string")
    assert rows(json_path_drift(flat, "record", "source_name", reg)) == [("s", "a", "missing", None, "number", 2)]


def test_many_fields_from_the_data(spark):
    raw = spark.range(3000).selectExpr("'s' as source_name", "concat('{\"p\":{\"k', id, '\":', id, '}}') as record")
    reg = spark.createDataFrame([("s", "p", "object")], "source_name string, field string, type string")
    out = json_path_drift(raw, "record", "source_name", reg)
    assert out.filter("kind = 'new'").count() == 3000 and out.filter("kind = 'ok'").first()["n_records"] == 3000


TOKENS = ['"', '\\"', "\\\\", "\\q", "\\u00e9", "\\u12", ":", ",", "{", "}", "[", "]", " ", "\n", "\t", "\x01", "\x02", "-", "--", "0", "01",
          "7", "-3.5", "1.", ".5", "1e5", "1E+", "9" * 120, "true", "null", "nul", "NaN", "é", '"k":', '"k" :', '"k1":5', '"a 1 b"', "\\"]


def test_shapes_hold_what_their_records_hold(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.nested_drift import _paths, shapes

    rng = random.Random(7)
    known = [t for _, t in RECORDS if t and len(t) < 100]
    texts = [*known, None, ""] + [
        '{"a":--1}', '["5\\q"]', '["5\n,"x"]', '["x\\"5\\"\n]', '{5:1}', '{"a" : "b:c","1":"2"}', '{"a":1}\x01 "', '"a":1', '[1,"a"2]',
        '{"a":1,"a":2}', '{"\\u0061":"\\ud83d\\ude00","$1":"$2"}', '{"a":01}', '{"a":1.}', '{"a":-}', '{"a":-0.0e-7}', '["\x01"]', "['1']"]
    for _ in range(1500):
        base = rng.choice(known)
        for _ in range(rng.randint(1, 2)):
            at = rng.randint(0, len(base))
            base = base[:at] + rng.choice(TOKENS) + base[at + rng.randint(0, 2):]
        texts.append(base)
    texts += ["".join(rng.choice(TOKENS) for _ in range(rng.randint(1, 8))).join(rng.choice(['[]', '{}'])) for _ in range(1500)]
    raw = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source_name string, record string").repartition(8)
    plain = raw.select("source_name", F.col("record").alias("shape"), F.lit(1).cast("long").alias("n_records"))
    want = rows(_paths(plain))
    assert len({r[0] for r in want}) > 200
    assert rows(observed_paths(raw, "record", "source_name")) == want
    counted = shapes(raw, "record", "source_name")
    assert counted.count() == len(texts) and "\x01" not in "".join(r["shape"] or "" for r in counted.collect())


def test_records_of_one_shape_are_walked_once(spark):
    from tidemark.operators.nested_drift import shapes

    raw = spark.range(40000).selectExpr(
        "if(id % 2 = 0, 's', 't') as source_name",
        "to_json(struct(id - 20000 as n, id / 7 as x, concat('a \"', id, '\": [1] \\\\') as t, array(struct(id as k), struct(-id as k)) as p)) as record")
    assert rows(shapes(raw, "record", "source_name")) == [
        (s, '{"n":0,"x":0,"t":"","p":[{"k":0},{"k":0}]}', 20000) for s in "st"]
    assert rows(observed_paths(raw, "record", "source_name"))[:3] == [
        ("s", "n", "number", 20000), ("s", "p", "array", 20000), ("s", "p[]", "object", 40000)]


def test_drift_reads_its_records_once(spark, tmp_path):
    spark.createDataFrame(RECORDS, "source_name string, record string").write.parquet(str(tmp_path / "feed"))
    reg = spark.createDataFrame([("s", "a", "number")], "source_name string, field string, type string")
    out = json_path_drift(spark.read.parquet(str(tmp_path / "feed")), "record", "source_name", reg)
    assert out.inputFiles() == []  # the number of records comes from their shapes
    assert ("s", "a", "missing", None, "number", 6) in rows(out)


def test_one_match_a_value(spark):
    """Names, brackets and literals are no matches of their own, and runs of them no recursion."""
    import re

    from tidemark.operators.nested_drift import _END, _VALUES, shapes

    record = '{"a":[1,"t",{"b1":{"c 2":-3.5e7}}],"d":true,"e":null,"f":"4"}'
    assert len(re.findall(_VALUES, record + _END)) == 4 + 1  # and one for the end
    names = "{" + ",".join(f'"k{i}":true' for i in range(20000)) + "}"
    texts = [names, '["' + '\\n\\u00e9' * 20000 + '"]', "[" * 50000, '"' * 20001, "7" * 20000, "1,-" * 20000]
    raw = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source_name string, record string")
    got = {r["source_name"]: r["shape"] for r in shapes(raw, "record", "source_name").collect()}
    assert [got[str(i)] for i in range(6)] == [names, '[""]', "[" * 50000, '"' * 20001, "7" * 20000, "0," * 20000 + "-"]
