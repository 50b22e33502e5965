"""Existing-target snapshot."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# error classes that mean "there is no target yet"; anything else is a real failure
_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_target(spark: SparkSession, location: str, contract: StructType, fmt: str = "parquet",
                is_table: bool = False) -> DataFrame:
    """The current target table, or an empty frame of the contract on a first run.

    Only "not found" is treated as a first run (D9): a permission or format
    error still raises instead of silently loading into an empty target. A folder
    with commits is read as its latest commit (:mod:`..sinks.snapshots`).
    """
    from ..sinks.snapshots import SnapshotTable

    if not is_table and (snapshots := SnapshotTable(spark, location, fmt)).exists():
        return snapshots.read()
    try:
        df = spark.table(location) if is_table else spark.read.format(fmt).load(location)
        df.schema  # resolve now, so a missing path surfaces here
        return df
    except AnalysisException as e:
        cls = e.getCondition() if hasattr(e, "getCondition") else e.getErrorClass()
        # nothing but what a first write left that died before its commit
        begun = cls and cls.startswith("UNABLE_TO_INFER_SCHEMA") and not is_table and snapshots.begun()
        if begun or cls and any(cls.startswith(a) for a in _ABSENT):
            return spark.createDataFrame([], contract)
        raise
