"""Schema drift below the top level of JSON records (Q1, Q2).

A path names where a value stands: ``ship.mode``, ``items[]`` (any element of the array) and
``items[].sku``; a field name that holds one of ``.[]`` or a backtick is quoted in backticks.

Paths and kinds don't depend on what the strings and numbers are, so one pass over the records
replaces each by one of its kind and counts the shapes that come out; tasks combine the counts
before anything is shuffled. Each shape is then parsed once and walked by a chain of generators,
one for each level: a value that holds others is replaced by itself and what it holds, all others
pass through. The number of levels comes from the shapes themselves (one pass that counts brackets
outside of strings), so no depth is cut off. Records that differ in shape are walked one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ..session import ensure_checkpoint_dir
from .quality import DRIFT_SCHEMA

_STRINGS = r'"(?:[^"\\]|\\.)*+"'
# Only strings and numbers that a JSON parser takes: it has to refuse a broken one in the shape too.
_CONTROL = "".join(f"\\x{i:02x}" for i in range(32))  # one by one, which Java matches by a table
_REST = rf'[^"\\{_CONTROL}]*+(?:(?:\\["\\/bfnrt]|\\u[0-9a-fA-F]{{4}})[^"\\{_CONTROL}]*+)*+"'
_NUMBER = r'(?<![\w.+"\-])-?(?:0|[1-9][0-9]{0,99}+)(?:[.][0-9]{1,99}+)?(?:[eE][+\-]?[0-9]{1,9}+)?(?![\w.+\-])'
# A match takes all up to the next value, fields' names included, and the value; so there are as many
# matches as values and none is looked for twice. The groups keep what stands before, of a string its
# quotes, of a number nothing, and the first character of what is neither (in a broken record).
_BEFORE = rf'(?:[^"\-0123456789]++|"{_REST}[ \t\r\n]*+:)*+'
_VALUES = rf'({_BEFORE})(?:{_NUMBER}|(")(?:{_REST[:-1]})(")|(["\-0-9]))'
_MARK = "\x01"  # put behind each match; stands nowhere in JSON
_END = " -"  # put behind the text, so that what follows its last value ends in a match too
#: Longer records (bytes) stay as they are, since the parser refuses values that get too large.
WHOLE_BYTES = 1 << 20


def depth(raw: DataFrame, json_col: str) -> int:
    """Levels of objects and arrays in the deepest record (0: no record holds any)."""
    marks = F.regexp_replace(F.regexp_replace(F.col(f"`{json_col}`"), _STRINGS, ""), r"[^\[\]{}]", "")
    step = F.transform(F.split(marks, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0))
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deepest = F.aggregate(step, zero, lambda acc, s: F.struct(
        (acc["now"] + s).alias("now"), F.greatest(acc["most"], acc["now"] + s).alias("most")))["most"]
    return raw.agg(F.max(deepest)).first()[0] or 0


def _quoted(name: Column) -> Column:
    return F.when(name.rlike(r"[.\[\]`]"), F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))).otherwise(name)


def _kind(value: Column) -> Column:
    """As ``json_value_kind``, with the type asked for once a value."""
    names = {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "OBJECT": "object", "ARRAY": "array"}
    kinds = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, F.substring_index(F.schema_of_variant(value), "<", 1)), F.lit("number"))


def _held(path: Column, value: Column) -> Column:
    """``array<struct<path,kind,value>>`` of what an object or array holds; null for other values.
    The kind comes later, in generated code; in here it would be interpreted for each element."""
    def cell(where: Column, what: Column) -> Column:
        return F.struct(where.alias("path"), F.lit(None).cast("string").alias("kind"), what.alias("value"))

    fields = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    items = F.try_variant_get(value, "$", "array<variant>")
    stem = F.when(path == "", F.lit("")).otherwise(F.concat(path, F.lit(".")))
    return F.coalesce(F.transform(fields, lambda e: cell(F.concat(stem, _quoted(e["key"])), e["value"])),
                      F.transform(items, lambda v: cell(F.concat(path, F.lit("[]")), v)))


def shapes(raw: DataFrame, json_col: str, source_col: str) -> DataFrame:
    """``source_name, shape, n_records``: the records with ``""`` for each string that is a value and
    ``0`` for each number. Field names, order and blanks stay; a record is JSON if its shape is.
    Kept below the checkpoint folder, so that the records are read once. Runs one job."""
    ensure_checkpoint_dir(raw.sparkSession)
    # no other character that JSON refuses may pass for the mark
    text = F.replace(F.col(f"`{json_col}`"), F.lit(_MARK), F.lit("\x02"))
    marked = raw.select(F.col(f"`{source_col}`").alias("source_name"), text.alias("text")).select(
        "source_name", F.when(F.octet_length("text") > WHOLE_BYTES, F.col("text"))
        .otherwise(F.regexp_replace(F.concat("text", F.lit(_END)), _VALUES, f"$1$2$3$4{_MARK}")).alias("marked"))
    counted = marked.groupBy("source_name", "marked").agg(F.count(F.lit(1)).alias("n_records"))
    # behind its quotes stands a string's mark, behind one character that of what is no value
    shape = F.regexp_replace("marked", rf"{_END}{_MARK}\z", "")
    shape = F.regexp_replace(F.replace(shape, F.lit(f'""{_MARK}'), F.lit('""')), rf'(["\-0-9]){_MARK}', "$1")
    return counted.select("source_name", F.replace(shape, F.lit(_MARK), F.lit("0")).alias("shape"),
                          "n_records").checkpoint(eager=True)


def observed_paths(raw: DataFrame, json_col: str, source_col: str) -> DataFrame:
    """``source_name, path, kind, n_values`` over every value in every record.

    ``n_values`` counts values, so a path below an array may count more than once a record.
    Records that are null or no JSON hold nothing. Runs two jobs, for the shapes and their depth.
    """
    return _paths(shapes(raw, json_col, source_col))


def _paths(counted: DataFrame) -> DataFrame:
    """:func:`observed_paths` of the records whose :func:`shapes` these are."""
    root = F.try_parse_json("shape")
    rows = counted.select("source_name", "n_records", F.lit("").alias("path"), _kind(root).alias("kind"), root.alias("value"))
    kind = F.coalesce("kind", _kind(F.col("value"))).alias("kind")
    for _ in range(depth(counted, "shape")):
        itself = F.array(F.struct("path", "kind", F.lit(None).cast("variant").alias("value")))
        held = F.when(F.col("kind").isin("object", "array"), _held(F.col("path"), F.col("value")))
        rows = rows.select("source_name", "n_records", F.inline(F.concat(itself, F.coalesce(held, F.array().cast(
            "array<struct<path:string,kind:string,value:variant>>"))))).select("source_name", "n_records", "path", kind, "value")
    return (rows.filter(F.col("path") != "").groupBy("source_name", "path", "kind")
            .agg(F.sum("n_records").alias("n_values")))


def json_path_drift(raw: DataFrame, json_col: str, source_col: str, registry: DataFrame) -> DataFrame:
    """Drift of all paths of a raw JSON feed against the approved ones (Q1).

    ``registry``: ``source_name, field, type`` with paths as fields and JSON kinds as types.
    Output as :func:`tidemark.operators.quality.json_field_drift`; ``n_records`` counts values,
    and for ``missing`` the objects (for a field at the top: the records) that lack the field.
    A field whose whole parent is missing is not reported beside its parent. Elements of an
    array are never missing. Runs one job over the records, two over their shapes: depth and counts.
    """
    counted = shapes(raw, json_col, source_col)
    # a small table, used three times: kept, so that the shapes are walked once
    seen = _paths(counted).checkpoint(eager=True)
    wanted = registry.select("source_name", F.col("field"), F.col("type").alias("expected_type"))
    present = seen.withColumnRenamed("path", "field").join(wanted, ["source_name", "field"], "left").select(
        "source_name", "field",
        F.when(F.col("expected_type").isNull(), "new")
         .when(F.col("expected_type") != F.col("kind"), "retyped").otherwise("ok").alias("kind"),
        F.col("kind").alias("observed_type"), "expected_type", F.col("n_values").alias("n_records"))
    # the objects that may hold a field: those at its parent's path, or the records
    records = counted.groupBy("source_name").agg(F.sum("n_records").alias("n_parents"))
    holders = (seen.filter("kind = 'object'").select("source_name", F.col("path").alias("parent"), F.col("n_values").alias("n_parents"))
               .unionByName(records.withColumn("parent", F.lit(""))))
    found = seen.groupBy("source_name", F.col("path").alias("field")).agg(F.sum("n_values").alias("n_found"))
    parent = F.regexp_extract("field", r"^(.*?)\.?(?:`(?:[^`]|``)*`|[^.\[\]`]+)$", 1)
    missing = (wanted.filter(~F.col("field").endswith("[]")).withColumn("parent", parent)
               .join(holders, ["source_name", "parent"]).join(found, ["source_name", "field"], "left")
               .withColumn("n_missing", F.col("n_parents") - F.coalesce("n_found", F.lit(0)))
               .filter("n_missing > 0")
               .select("source_name", "field", F.lit("missing").alias("kind"), F.lit(None).cast(StringType()).alias("observed_type"),
                       "expected_type", F.col("n_missing").cast(LongType()).alias("n_records")))
    return present.unionByName(missing).select([F.col(f.name).cast(f.dataType).alias(f.name) for f in DRIFT_SCHEMA.fields])
