"""Sinks (K1-K7): landing, replacement, bronze/silver writes, load reports.

Two hazards shape them (SURVEY §4.3):

* a target must never be overwritten while it is being read: replacement
  writes a staged copy first and rewrites the target from that copy;
* appends are not atomic: every landed row carries a ``load_id`` so a retried
  job's rows can be found and replaced.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ..session import drop_shared, shared_dir

# Text formats (JSON/CSV) write timestamps with millisecond precision by
# default; these options keep the microseconds Spark and parquet hold.
TEXT_TIMESTAMP_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def text_writer(df: DataFrame, fmt: str, mode: str = "errorifexists", partition_by: Sequence[str] | None = None):
    """A ``DataFrameWriter`` for JSON/CSV that keeps full timestamp precision."""
    w = df.write.format(fmt).mode(mode).options(**TEXT_TIMESTAMP_OPTIONS)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


REPORT_SCHEMA = StructType([
    StructField("target_table", StringType()), StructField("schema", StringType()),
    StructField("rows_loaded", LongType())])


def write_jdbc(df: DataFrame, options: dict[str, str], table: str, mode: str = "append",
               batch_size: int = 10_000, num_partitions: int | None = None, truncate: bool = True) -> None:
    """JDBC append (K1) or replace (K2; ``truncate`` keeps the table's DDL)."""
    w = df.write.format("jdbc").options(**{k: v for k, v in options.items() if k not in ("dbtable", "query")})
    w = w.option("dbtable", table).option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    if mode == "overwrite" and truncate:
        w = w.option("truncate", "true")
    w.mode(mode).save()


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: Sequence[str] | None = None, metrics: dict | None = None,
                   **options) -> dict:
    """Write ``df`` and return metrics gathered during the same pass (K6, A1).

    An ``Observation`` counts rows while they are written, so a load report
    costs no second scan.
    """
    obs = Observation(f"obs_{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("rows_loaded")] + [e.alias(k) for k, e in (metrics or {}).items()]
    observed = df.observe(obs, *exprs)
    w = observed.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return dict(obs.get)


def load_report(spark: SparkSession, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Load response rows ``(target_table, schema, rows_loaded)`` (K6)."""
    return spark.createDataFrame([(t, s, int(n)) for t, s, n in rows], REPORT_SCHEMA)


def replace_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                 expected_rows: int | None = None, drop_null_columns: bool = False) -> int:
    """Safely replace the data at ``path`` with ``df``, even when ``df`` reads ``path`` (K2).

    The result is written to a staged folder in the shared checkpoint folder
    (counted on the way), read back and counted again, then copied over the
    target from the staged copy, so the target is never read and truncated by
    the same job. The staged copy is deleted after the replacement; if the copy
    fails, it stays and holds the complete result. A reader of a plain folder
    may meet it half-written while it is copied: where that matters, readers
    should go through a table or a pointer that is switched afterwards.
    ``drop_null_columns`` leaves out columns without any value (P11), counted in
    the staging pass; an empty result keeps all columns.
    """
    spark = df.sparkSession
    staged = shared_dir(spark, "staged")
    filled = {f"c{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(df.columns)} if drop_null_columns else {}
    m = write_observed(df, staged, fmt, "overwrite", partition_by, filled)
    n = int(m["rows_loaded"])
    if expected_rows is not None and n != expected_rows:
        raise RuntimeError(f"staged {n} rows, expected {expected_rows}; target left untouched")
    back = spark.read.format(fmt).schema(df.schema).load(staged)
    found = back.count()
    if found != n:
        raise RuntimeError(f"staged {n} rows but {found} read back; target left untouched")
    if drop_null_columns and n > 0:  # counted while the staged copy was written
        back = back.select([F.col(f"`{c}`") for i, c in enumerate(df.columns) if m[f"c{i}"] > 0])
    # a replacement replaces everything, also partitions the new data no longer
    # has (the session default is dynamic overwrite, used by silver loads)
    w = back.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    drop_shared(spark, staged)
    return n


def with_lineage(df: DataFrame, source_name: str | None = None, ingest_date: dt.date | str | None = None,
                 load_id: str | None = None) -> DataFrame:
    """Bronze lineage columns (K4): source, file name, ingest date, load id."""
    cols = {}
    if source_name is not None:
        cols["source_name"] = F.lit(source_name)
    if "_file_name" not in df.columns:
        try:  # file sources expose _metadata; tables and JDBC reads do not
            df.select(F.col("_metadata.file_name")).schema
            cols["_file_name"] = F.col("_metadata.file_name")
        except AnalysisException:
            cols["_file_name"] = F.lit(None).cast(StringType())
    cols["_ingest_date"] = (F.lit(str(ingest_date)).cast(DateType()) if ingest_date is not None
                            else F.current_date())
    cols["_load_id"] = F.lit(load_id or uuid.uuid4().hex)
    return df.withColumns(cols)


def land_bronze(df: DataFrame, root: str, fmt: str = "parquet") -> dict:
    """Append raw rows to bronze, one folder per source (K4)."""
    return write_observed(df, root, fmt, "append", ["source_name"])


def write_silver(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 mode: str = "overwrite") -> dict:
    """Silver write with dynamic partition overwrite (K5): only the partitions
    present in ``df`` are replaced when ``partition_by`` is given (set on the
    writer, so it holds in any session)."""
    return write_observed(df, path, "parquet", mode, partition_by,
                          partitionOverwriteMode="dynamic" if partition_by else "static")


def replace_load(df: DataFrame, path: str, load_id: str, partition_by: Sequence[str] = ()) -> dict:
    """Land rows under their load id so that a retried load replaces itself (K4).

    The folder is partitioned by ``_load_id`` first; dynamic overwrite of that
    one partition removes what an earlier attempt of the same load has left.
    """
    rows = df.withColumn("_load_id", F.lit(load_id))
    return write_observed(rows, path, "parquet", "overwrite", ["_load_id", *partition_by],
                          partitionOverwriteMode="dynamic")


def append_log(log_rows: DataFrame, path: str) -> dict:
    """Append processed-file log rows (K7)."""
    return write_observed(log_rows, path, "parquet", "append")
