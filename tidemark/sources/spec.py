"""Mapping-spec load.

A spec is a JSON object keyed by source name; each value holds the record
type, target schema and table, the relational flag and an ordered array of
``{source_column, target_column, source_key, target_key}``. It is read with
Spark's JSON functions and flattened with ``explode``/``posexplode`` so the
mapping order survives. Specs are configuration: the flat rows are small and
are collected once to build projections, the data itself never leaves Spark.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions.columns import split_entity, strip_extension

MAPPING_ITEM = StructType([
    StructField("source_column", StringType()),
    StructField("target_column", StringType()),
    StructField("source_key", StringType()),
    StructField("target_key", StringType()),
])

# ``relational`` arrives as the string "True"/"False" or as a JSON boolean; a
# string field keeps either spelling, coerced to boolean below.
SPEC_SCHEMA = MapType(StringType(), StructType([
    StructField("type", StringType()),
    StructField("schema", StringType()),
    StructField("tablename", StringType()),
    StructField("relational", StringType()),
    StructField("mapping", ArrayType(MAPPING_ITEM)),
]))

FLAT_COLUMNS = ["src_ord", "source", "source_table", "rec_type", "target_schema", "target_table", "relational",
                "ord", "source_column", "entity", "target_column", "source_key", "target_key"]


def flatten_spec(text_df: DataFrame, column: str = "value") -> DataFrame:
    """Nested spec text (one JSON document per row) to one row per mapping."""
    parsed = text_df.select(F.from_json(F.col(column), SPEC_SCHEMA).alias("spec"))
    per_source = parsed.select(F.posexplode("spec").alias("src_ord", "source", "cfg"))
    flat = per_source.select(
        "src_ord", "source", "cfg.type", "cfg.schema", "cfg.tablename", "cfg.relational",
        F.posexplode("cfg.mapping").alias("ord", "m"))
    entity, target = split_entity(F.trim(F.col("m.target_column")))
    rel = F.lower(F.trim(F.col("relational")))
    return flat.select(
        F.col("src_ord").cast("int").alias("src_ord"),
        F.col("source"),
        strip_extension(F.col("source")).alias("source_table"),
        F.col("type").alias("rec_type"),
        F.col("schema").alias("target_schema"),
        F.col("tablename").alias("target_table"),
        F.when(rel == "true", F.lit(True)).when(rel == "false", F.lit(False)).alias("relational"),
        F.col("ord").cast("int").alias("ord"),
        F.trim(F.col("m.source_column")).alias("source_column"),
        entity.alias("entity"),
        target.alias("target_column"),
        F.trim(F.col("m.source_key")).alias("source_key"),
        F.trim(F.col("m.target_key")).alias("target_key"),
    )


def load_spec(spark: SparkSession, path: str) -> DataFrame:
    """Read a spec file (whole text) and flatten it."""
    return flatten_spec(spark.read.text(path, wholetext=True))


def spec_from_dict(spark: SparkSession, spec: dict) -> DataFrame:
    """Flatten an in-memory spec through the same Spark JSON path as a file."""
    return flatten_spec(spark.createDataFrame([(json.dumps(spec),)], ["value"]))


@dataclass(frozen=True)
class Mapping:
    """One flat mapping row, as used to build projections on the driver."""

    src_ord: int
    source: str
    source_table: str
    rec_type: str | None
    target_schema: str | None
    target_table: str | None
    relational: bool | None
    ord: int
    source_column: str
    entity: str | None
    target_column: str
    source_key: str | None
    target_key: str | None


def collect_mappings(flat: DataFrame) -> dict[str, list[Mapping]]:
    """Spec rows grouped by source table, in spec order.

    The spec is configuration that the run's driver interprets; its rows are
    collected and ordered here.
    """
    out: dict[str, list[Mapping]] = {}
    for r in sorted(flat.collect(), key=lambda r: (r["src_ord"], r["ord"])):
        out.setdefault(r["source_table"], []).append(Mapping(**{c: r[c] for c in FLAT_COLUMNS}))
    return out
