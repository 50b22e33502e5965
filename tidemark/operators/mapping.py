"""Apply a column-mapping spec to a source.

The spec decides the *shape* of one projection per source; building it is a
driver-side loop over a handful of config rows, while the data moves through
a single ``select`` (or one ``inline`` generator for repeated targets), so a
wide contract stays one whole-stage-codegen span and one scan of the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import entity_id
from ..sources.spec import Mapping

# Reserved output columns of a contract projection.
REC_TYPE = "rec_type"
FILENAME = "filename"

# Source-column names that trigger the derived entity key in the
# ``esg`` schema, and the target column the key is read from.
ENTITY_TRIGGERS = {"issuerid": "issuer_id", "issuer_id": "issuer_id", "fund_id": "fund_id"}
ENTITY_SCHEMA = "esg"
ENTITY_COLUMN = "esg_entity_id"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _lookup(columns: Sequence[str], name: str) -> str | None:
    """Case-insensitive column resolution (Spark's default), returning the real spelling."""
    low = name.lower()
    for c in columns:
        if c.lower() == low:
            return c
    return None


def rename_by_mapping(df: DataFrame, mappings: Sequence[Mapping], *, keep_keys: bool = True) -> DataFrame:
    """Relational rename (P4, P5): the spec's distinct source columns, renamed.

    * source columns in first-appearance order, each once; a source column
      mapped twice takes its last target (dictionary update in the reference);
    * key columns are carried even when the spec maps no payload to them (the
      life spec's ``PolicyIdentifier``), renamed to the target key;
    * spec entries whose source column is absent are skipped (they show up in
      :func:`mapping_audit`).
    """
    last_target: dict[str, str] = {}
    order: list[str] = []
    for m in mappings:
        real = _lookup(df.columns, m.source_column)
        if real is None:
            continue
        if real not in last_target:
            order.append(real)
        last_target[real] = m.target_column
    cols = []
    emitted: set[str] = set()
    if keep_keys:
        for m in mappings:
            if not m.source_key or not m.target_key:
                continue
            real = _lookup(df.columns, m.source_key)
            if real is None or m.target_key in emitted:
                continue
            if last_target.get(real) == m.target_key:
                continue  # emitted with the payload below
            cols.append(_c(real).alias(m.target_key))
            emitted.add(m.target_key)
    for src in order:
        tgt = last_target[src]
        if tgt in emitted:
            continue
        cols.append(_c(src).alias(tgt))
        emitted.add(tgt)
    return df.select(cols)


def with_provenance(df: DataFrame, mapping: Mapping | None = None, **literals: str | None) -> DataFrame:
    """Constant provenance columns (P10): filename, type, table_name, schema."""
    values: dict[str, str | None] = {}
    if mapping is not None:
        values = {FILENAME: mapping.source_table, "type": mapping.rec_type,
                  "table_name": mapping.target_table, "schema": mapping.target_schema}
    values.update(literals)
    return df.withColumns({k: F.lit(v).cast(StringType()) for k, v in values.items()})


def _plan_contract(df_columns: Sequence[str], contract: StructType, mappings: Sequence[Mapping]):
    """First mapping per target fills the wide row; later ones become extra rows."""
    contract_names = [f.name for f in contract.fields]
    first: dict[str, str] = {}
    repeats: list[tuple[str, str]] = []
    for m in mappings:
        real = _lookup(df_columns, m.source_column)
        tgt = _lookup(contract_names, m.target_column)
        if real is None or tgt is None:
            continue
        if tgt not in first:
            first[tgt] = real
        else:
            repeats.append((tgt, real))
    return first, repeats


def _entity_expr(contract: StructType, mappings: Sequence[Mapping], values: dict[str, Column]) -> Column | None:
    """Derived ``esg_entity_id`` when a trigger column is mapped in schema ``esg``."""
    names = [f.name for f in contract.fields]
    if ENTITY_COLUMN not in names:
        return None
    for m in mappings:
        trigger = ENTITY_TRIGGERS.get((m.source_column or "").strip().lower())
        if trigger and (m.target_schema or "").lower() == ENTITY_SCHEMA and trigger in values:
            return entity_id(F.lit(m.rec_type), values[trigger])
    return None


def map_to_contract(df: DataFrame, contract: StructType, mappings: Sequence[Mapping], *,
                    rec_type: str | None = None, filename: str | None = None) -> DataFrame:
    """Non-relational mapping of one source into the target contract.

    Output columns: the contract in order, then ``rec_type`` and ``filename``.
    Unmapped contract columns are typed nulls. When a second (third, ...)
    source column maps to a target that is already filled, each adds one more
    block of rows holding only that target and the provenance columns (P13);
    all blocks come from one scan through ``inline(array(struct, ...))``.
    Values are cast to the contract's types with Spark's (ANSI) casts, so a
    value that cannot be converted fails the load instead of silently turning
    into null; validate bronze first (:mod:`.quality`) when sources are dirty.
    """
    if mappings:
        rec_type = rec_type if rec_type is not None else mappings[0].rec_type
        filename = filename if filename is not None else mappings[0].source_table
    first, repeats = _plan_contract(df.columns, contract, mappings)

    def block(fill: dict[str, str]) -> Column:
        values = {f.name: (_c(fill[f.name]).cast(f.dataType) if f.name in fill
                           else F.lit(None).cast(f.dataType)) for f in contract.fields}
        ent = _entity_expr(contract, mappings, values) if len(fill) == len(first) else None
        if ent is not None:
            values[ENTITY_COLUMN] = ent.cast(contract[ENTITY_COLUMN].dataType)
        return F.struct(*[values[f.name].alias(f.name) for f in contract.fields])

    tail = [F.lit(rec_type).cast(StringType()).alias(REC_TYPE),
            F.lit(filename).cast(StringType()).alias(FILENAME)]
    if not repeats:
        wide = block(first)
        return df.select(wide.alias("__row")).select("__row.*", *tail)
    blocks = [block(first)] + [block({tgt: src}) for tgt, src in repeats]
    return df.select(F.inline(F.array(*blocks))).select(*[_c(f.name) for f in contract.fields], *tail)


def mapping_audit(spark: SparkSession, flat: DataFrame, source_columns: DataFrame,
                  contract: StructType | None = None) -> DataFrame:
    """Missing source and target columns per source (A3).

    ``source_columns`` holds ``(source_table, column)`` rows (the schemas of the
    sources); the contract's column names are the targets. Matching ignores
    case, like Spark's resolver. Result: ``(source, kind, column)``.
    """
    sc = source_columns.select(F.col("source_table"), F.lower("column").alias("_lc"))
    missing_src = (flat.join(sc, (flat.source_table == sc.source_table)
                             & (F.lower(flat.source_column) == sc._lc), "left_anti")
                   .select(F.col("source"), F.lit("missing_source").alias("kind"),
                           F.col("source_column").alias("column")))
    if contract is None:
        return missing_src.distinct()
    tc = spark.createDataFrame([(f.name.lower(),) for f in contract.fields], ["_lc"])
    missing_tgt = (flat.join(F.broadcast(tc), F.lower(flat.target_column) == tc._lc, "left_anti")
                   .select(F.col("source"), F.lit("missing_target").alias("kind"),
                           F.col("target_column").alias("column")))
    return missing_src.unionByName(missing_tgt).distinct()


def schema_rows(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """``(source_table, column, type)`` rows for a few frames' schemas."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in frames.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, StructType([
        StructField("source_table", StringType()), StructField("column", StringType()),
        StructField("type", StringType())]))


def duplicate_columns(columns: DataFrame, name_col: str = "column", group_col: str | None = "source_table") -> DataFrame:
    """Column names that occur twice after case folding (A4)."""
    keys = ([F.col(group_col)] if group_col else []) + [F.lower(F.col(name_col)).alias("column_lc")]
    return (columns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.collect_set(name_col).alias("spellings"))
            .filter(F.col("n") > 1))


def derive_entity_id(df: DataFrame, type_col: Column | str, key_col: str, out: str = ENTITY_COLUMN) -> DataFrame:
    """Vectorised derived key ``<T>_<key>`` replacing the reference's row loop."""
    t = F.col(type_col) if isinstance(type_col, str) else type_col
    return df.withColumn(out, entity_id(t, _c(key_col)))
