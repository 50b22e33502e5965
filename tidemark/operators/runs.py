"""Whole runs composed from the operators: a file pipeline and a table load run.

A run's control data (sources, folders with new files, load config, bookmarks) is read by
the driver, as any Spark job's file list is; rows and file names stay in Spark.

Both runs are exactly-once, wherever they die:

* a table's rows, bookmark and row count are one commit (:mod:`..sinks.snapshots`); what a load
  left before its commit is never read, and the next run loads from the last commit on;
* a feed's files are written down as an intent before anything lands. The load id is a hash
  of the file set, and all zones are partitioned by it, so a load that is done again replaces
  what its first attempt left. Its commit is the log partition of that id. The next run first
  finishes the intents without a log partition, each with its own files, then looks for new files.

Every source ends in an audit row, whether it loaded or failed; a failing source doesn't
stop the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..session import drop_shared, shared_dir
from ..sinks.snapshots import SnapshotTable
from ..sinks.writers import append_log, replace_load, with_lineage
from ..sources.files import list_files, read_files
from ..sources.target import read_target
from .incremental import (
    BACKFILL,
    FULL,
    backfill_bound,
    files_matching,
    load_backfill,
    load_incremental,
    log_processed,
    missing_file_alerts,
    replace_window,
    unprocessed_files,
)
from .quality import AUDIT_SCHEMA, Rule, apply_gate, audit_row, gate_status, json_field_drift, validate
from .rule_table import load_rules

LOG_SCHEMA = StructType([StructField("source_name", StringType()), StructField("file_name", StringType()),
                         StructField("processed_date", DateType()), StructField("status", StringType())])
INTENT_SCHEMA = StructType([StructField("source_name", StringType()), StructField("file_path", StringType()),
                            StructField("file_name", StringType()), StructField("_load_id", StringType())])


@dataclass(frozen=True)
class Zones:
    """Folders of one pipeline below a common root."""

    root: str

    def __getattr__(self, zone: str) -> str:
        if zone.startswith("_"):
            raise AttributeError(zone)
        return f"{self.root.rstrip('/')}/{zone}"


def _union(frames: list[DataFrame], spark: SparkSession, schema: StructType) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else spark.createDataFrame([], schema)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def load_ids(files: DataFrame) -> DataFrame:
    """source_name, load_id of each source's file set, in whatever order it is listed."""
    one = F.sha2(F.concat_ws("\n", "source_name", "file_path"), 256)
    # sums of the files' hashes, 40 bits at a time: the same for any order, and exact
    lanes = [F.sum(F.conv(F.substring(one, 1 + 10 * i, 10), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"s{i}") for i in range(3)]
    sums = files.select("source_name", "file_path").distinct().groupBy("source_name").agg(*lanes, F.count(F.lit(1)).alias("n"))
    return sums.select("source_name", F.concat(
        F.lit("load-"), F.substring(F.sha2(F.concat_ws("-", "source_name", "n", "s0", "s1", "s2"), 256), 1, 32)).alias("load_id"))


def _file_log(spark: SparkSession, zones: Zones) -> DataFrame:
    return read_target(spark, zones.log, StructType([*LOG_SCHEMA.fields, StructField("_load_id", StringType())]))


def open_intents(spark: SparkSession, zones: Zones) -> list[tuple[str, str]]:
    """(source, load id) of the loads that were begun and not finished."""
    begun = read_target(spark, zones.intents, INTENT_SCHEMA).select("source_name", F.col("_load_id").cast("string").alias("id")).distinct()
    done = _file_log(spark, zones).select(F.col("_load_id").cast("string").alias("id")).distinct()
    return sorted((r["source_name"], r["id"]) for r in begun.join(done, "id", "left_anti").collect())


def run_file_pipeline(spark: SparkSession, config: DataFrame, landing: str, zones: Zones, *,
                      source_of: Column, date_of: Column, schema: StructType, registry: DataFrame,
                      rules: Sequence[Rule] | DataFrame, run_id: str, run_date: str, since: str,
                      drift_of: Callable[..., DataFrame] = json_field_drift,
                      refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """One run over a landing folder of JSON feeds; returns the missing-file alerts.

    Finishes what an earlier run began; then lists the files, keeps those that match their feed's
    pattern and aren't in the processed log, and loads feed by feed: lands the files in bronze,
    blocks a feed whose fields drift (new or retyped), sends blocked rows and rows that break
    a rule to quarantine and the others to silver, and logs the files. ``source_of`` and
    ``date_of`` give a file's feed and business date from the column ``file_path``. Zones:
    intents, bronze, silver, quarantine, log, audit. Every load adds an audit row, also one that
    fails (its files stay unlogged); a run without new files adds one for itself. ``drift_of``:
    how a feed is held against ``registry``; ``nested_drift.json_path_drift`` looks below the top.
    ``rules``: a list, or a rules table (:mod:`.rule_table`) whose ``table_name``, if it has that column,
    is the feed; a table that can't be applied fails its feed, after bronze. ``refs``: parent
    tables of referential rules. Unique rules look at the rows of one load.
    """
    def load(source: str, load_id: str) -> DataFrame:
        try:
            n = _load_files(spark, source, load_id, landing, zones, source_of, schema, registry, rules, run_date, drift_of, refs)
            return audit_row(spark, run_id, source, landing, "SUCCESS", n)
        except Exception as e:  # logged; the other feeds go on
            return audit_row(spark, run_id, source, landing, "FAILED", None, f"{type(e).__name__}: {str(e)[:400]}")

    audits = [load(source, load_id) for source, load_id in open_intents(spark, zones)]
    listing = list_files(spark, landing).withColumns({"source_name": source_of, "business_date": date_of})
    matched = files_matching(listing, config)
    todo = unprocessed_files(matched, _file_log(spark, zones)).select("source_name", "file_path", "file_name")
    alerts = missing_file_alerts(config, matched, since, run_date)
    ids = load_ids(todo).collect()  # one row a feed
    failed = {load_id for _, load_id in open_intents(spark, zones)}
    for r in sorted(ids):
        if r["load_id"] in failed:
            continue  # just tried again, and failed
        files = todo.filter(F.col("source_name").eqNullSafe(F.lit(r["source_name"])))
        replace_load(files, zones.intents, r["load_id"])
        audits.append(load(r["source_name"], r["load_id"]))
    if not audits:
        audits = [audit_row(spark, run_id, "files", landing, "SUCCESS", 0)]
    append_log(_union(audits, spark, AUDIT_SCHEMA), zones.audit)
    return alerts


def _load_files(spark, source, load_id, landing, zones, source_of, schema, registry, rules, run_date, drift_of, refs) -> int:
    """Load the files of one intent; its last step is the log partition, which commits it."""
    files = read_target(spark, zones.intents, INTENT_SCHEMA).filter(F.col("_load_id") == load_id).select("file_path", "file_name")
    # whole folders are read and met with the file set: the driver holds folders, not files
    folders = [r[0] for r in files.select(_folder(F.col("file_path"))).distinct().collect()]
    wanted = files.select(F.col("file_path").alias("__wanted"))

    def only_wanted(df: DataFrame, path: str) -> DataFrame:
        return df.join(wanted, F.col(path) == F.col("__wanted"), "left_semi")

    rows = only_wanted(read_files(spark, "JSON", folders, schema), "_file_path").withColumn("file_path", F.col("_file_path"))
    rows = rows.withColumn("source_name", source_of).drop("file_path")
    replace_load(with_lineage(rows, ingest_date=run_date, load_id=load_id), zones.bronze, load_id, ["source_name"])

    raw = only_wanted(spark.read.text(folders).select("value", F.col("_metadata.file_path").alias("file_path")), "file_path")
    raw = raw.select(F.col("value").alias("record"), source_of.alias("source_name"))
    held = [shared_dir(spark, "gate"), shared_dir(spark, "checked")]
    gate_status(drift_of(raw, "record", "source_name", registry), ("new", "retyped")).write.parquet(held[0])
    gate = spark.read.parquet(held[0])  # one row a feed: the records are parsed for it once
    landed = spark.read.parquet(f"{zones.bronze}/_load_id={load_id}").withColumn("_load_id", F.lit(load_id))
    passing, blocked = apply_gate(landed, gate)
    if isinstance(rules, DataFrame):
        rules = load_rules(rules, source if "table_name" in rules.columns else None)
    checked = validate(passing, rules, refs).unionByName(blocked.withColumn("failed_rules", F.lit("schema drift")))
    checked.write.parquet(held[1])  # the rules are evaluated once for both zones
    checked = spark.read.schema(checked.schema).parquet(held[1])
    replace_load(checked.filter("failed_rules <> ''"), zones.quarantine, load_id, ["source_name"])
    silver = replace_load(checked.filter("failed_rules = ''").drop("failed_rules"), zones.silver, load_id, ["source_name"])
    done = files.select(F.lit(source).alias("source_name"), "file_name")
    replace_load(log_processed(spark.createDataFrame([], LOG_SCHEMA), done, run_date), zones.log, load_id)
    for path in held:
        drop_shared(spark, path)
    return int(silver["rows_loaded"])


def run_table_loads(spark: SparkSession, config: Sequence[dict], read: Callable[[str], DataFrame], root: str, *,
                    as_of: str, run_id: str, side_by_side: int = 4) -> DataFrame:
    """Load every table of ``config`` (table_name, load_type, watermark_column,
    backfill_days) into ``root/<table>``; returns the run's audit rows.

    FULL replaces the table; BACKFILL replaces its window; anything else appends what lies
    after the bookmark (no bookmark: everything). A table's bookmark is the high mark of its
    latest commit and moves with the rows. Up to ``side_by_side`` tables load at a time; audit rows
    are kept in ``root/_audit``. A table that is an ordinary folder is taken over by its first
    load here. Read the tables with :func:`..sources.target.read_target`.
    """
    root = root.rstrip("/")

    def load(c: dict) -> DataFrame:
        name, column, path = c["table_name"], c["watermark_column"], f"{root}/{c['table_name']}"
        kind = (c["load_type"] or "").upper()
        try:
            rows, table = read(name), SnapshotTable(spark, path)
            before = table.adopt(column) if kind not in (FULL, BACKFILL) and table.plain() else table.commit()
            high = before.high if before else None
            if kind == FULL:
                n = table.replace(rows, run_id, high=high).rows_loaded
            elif kind == BACKFILL:
                window = load_backfill(rows, column, as_of, c["backfill_days"])
                old = read_target(spark, path, rows.schema)
                kept = replace_window(old, window, column, backfill_bound(as_of, c["backfill_days"]))
                n = table.replace(kept, run_id, high=high).rows_loaded
            else:
                new = load_incremental(rows, column, high).withColumn("_load_id", F.lit(run_id))
                n = table.append(new, run_id, mark=column).rows_loaded
            return audit_row(spark, run_id, name, path, "SUCCESS", n)
        except Exception as e:  # logged; the other tables go on
            return audit_row(spark, run_id, name, path, "FAILED", None, f"{type(e).__name__}: {str(e)[:400]}")

    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        out = _union(list(pool.map(load, config)), spark, AUDIT_SCHEMA)
    append_log(out, f"{root}/_audit")
    return out
