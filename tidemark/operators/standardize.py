"""One standardisation run: many sources -> one standard table.

The reference loops over the spec's sources: relational sources are merged
into the target one after another (later wins), non-relational sources are
projected into the contract and stacked. Here the spec is resolved on the
driver (config-sized), the data flows as one Spark plan per target, and the
two flows are combined without dropping the stacked rows (D13).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.spec import Mapping
from .clean import standard_clean
from .mapping import map_to_contract, rename_by_mapping
from .merge import fold, key_pairs, merge_all
from .union import choose_result, union_sources


def relational_sources(mappings: dict[str, list[Mapping]]) -> list[str]:
    return [s for s, ms in mappings.items() if ms and ms[0].relational]


def standardize(spark: SparkSession, target: DataFrame | None, contract: StructType,
                mappings: dict[str, list[Mapping]], read: Callable[[str], DataFrame], *,
                clean: bool = True, stage_every: int | None = None, unique_keys: bool = False) -> DataFrame:
    """Run every source of a spec into the standard table.

    ``target``: the existing table or ``None`` (first run: an empty frame of
    the contract, D9); ``read(source_table)`` returns a source frame. Sources
    are cleaned once (NaN -> null, trim) and reused by both flows (D20).
    ``unique_keys=True`` declares that the target and every relational source
    hold each key at most once; the relational sources are then merged in one
    aggregation (:func:`.merge.merge_all`), which checks that, instead of one
    join per source.
    """
    if target is None:
        target = spark.createDataFrame([], contract)
    merged = target
    todo = []
    stacked = []
    for source_table, ms in mappings.items():
        df = read(source_table)
        if clean:
            df = standard_clean(df)
        if ms[0].relational:
            renamed = rename_by_mapping(df, ms)
            keys = [t for t, _ in key_pairs([{"target_key": m.target_key, "source_key": m.source_key}
                                             for m in ms if m.target_key])]
            todo.append((renamed, keys))
        else:
            stacked.append(map_to_contract(df, contract, ms))
    if todo:
        merged = merge_all(target, todo) if unique_keys else fold(target, todo, stage_every=stage_every)
    if not stacked:
        return merged
    return choose_result(merged, union_sources(stacked))


def run_standardization(spark: SparkSession, target_location: str, contract: StructType,
                        mappings: dict[str, list[Mapping]], read: Callable[[str], DataFrame], *,
                        fmt: str = "parquet", drop_null_columns: bool = True, unique_keys: bool = False) -> dict:
    """One full run into a stored standard table.

    Reads the current table (or starts from an empty frame of the contract
    when it does not exist yet), standardises every source of the spec, drops
    columns that are null on every row, commits the result as the table's next
    snapshot (it reads the one before, and is written once) and returns the load
    response ``{target_table, schema, rows_loaded}``. Read the table with
    :func:`..sources.target.read_target`. A target that is an ordinary folder stays
    one, since others may read it as such: it is replaced through a staged copy.
    ``SnapshotTable.adopt`` turns it into a snapshot table.
    """
    from ..sinks.snapshots import SnapshotTable
    from ..sinks.writers import replace_path
    from ..sources.target import read_target

    target = read_target(spark, target_location, contract, fmt)
    result = standardize(spark, target, contract, mappings, read, unique_keys=unique_keys)
    table = SnapshotTable(spark, target_location, fmt)
    if table.plain():
        n = replace_path(result, target_location, fmt, drop_null_columns=drop_null_columns)
    else:
        n = table.replace(result, drop_null_columns=drop_null_columns).rows_loaded
    first = next(iter(mappings.values()))[0] if mappings else None
    return {"target_table": first.target_table if first else None,
            "schema": first.target_schema if first else None, "rows_loaded": n}


def mappings_by_target(mappings: dict[str, list[Mapping]]) -> dict[tuple[str | None, str | None], dict[str, list[Mapping]]]:
    """Group a spec's sources by the standard table they feed.

    A spec may feed several tables; each ``(target_schema, target_table)``
    gets its own run instead of every source landing in one fixed table.
    """
    out: dict[tuple[str | None, str | None], dict[str, list[Mapping]]] = {}
    for source, ms in mappings.items():
        if ms:
            out.setdefault((ms[0].target_schema, ms[0].target_table), {})[source] = ms
    return out


def run_all_targets(spark: SparkSession, mappings: dict[str, list[Mapping]],
                    location: Callable[[str | None, str | None], str],
                    contract: Callable[[str | None, str | None], StructType],
                    read: Callable[[str], DataFrame], **kwargs) -> list[dict]:
    """:func:`run_standardization` once per target table of the spec; load responses in spec order."""
    return [run_standardization(spark, location(schema, table), contract(schema, table), group, read, **kwargs)
            for (schema, table), group in mappings_by_target(mappings).items()]
