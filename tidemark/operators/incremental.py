"""Full, incremental and backfill loads; bookmarks; file-feed bookkeeping.

(I1-I7, J8-J10, A2, S8, S10, K7.) Every operator is a predicate or a join
against a metadata-sized frame, so the big side (the table or the feed
listing) is scanned once with its filter pushed into the scan; the planner
decides from sizes whether the metadata side is broadcast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from ..functions.columns import date_from_file_name, dated_folder, glob_match, yn_to_bool

FULL, INCR, BACKFILL = "FULL", "INCR", "BACKFILL"


def _lit_date(d: str | dt.date | Column) -> Column:
    return d.cast(DateType()) if isinstance(d, Column) else F.lit(str(d)).cast(DateType())


def _lit_ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(str(v)).cast(TimestampNTZType())


def load_full(df: DataFrame) -> DataFrame:
    """Every row."""
    return df


def load_incremental(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows strictly after the bookmark (I2); a null bookmark means a full load."""
    if watermark is None:
        return df
    return df.filter(F.col(column) > _lit_ts(watermark))


def backfill_bound(as_of, days: int) -> Column:
    """Start of the last ``days`` days before ``as_of``."""
    return F.date_sub(_lit_date(as_of), int(days)).cast(TimestampNTZType())


def load_backfill(df: DataFrame, column: str, as_of, days: int) -> DataFrame:
    """Rows of the last N days, bound inclusive.

    Re-running the same window returns the same rows; the writer replaces the
    affected key range (see :func:`replace_window`) so reruns stay idempotent.
    """
    return df.filter(F.col(column) >= backfill_bound(as_of, days))


def replace_window(existing: DataFrame, reloaded: DataFrame, column: str, lower: Column) -> DataFrame:
    """Existing rows outside the reloaded window plus the reloaded rows."""
    return existing.filter(~(F.col(column) >= lower) | F.col(column).isNull()).unionByName(reloaded)


def plan_loads(config: DataFrame, watermarks: DataFrame, as_of) -> DataFrame:
    """Per table: load type and lower bound.

    ``config``: ``table_name, load_type, watermark_column, backfill_days``;
    ``watermarks``: ``table_name, value``. Output adds ``lower_bound`` and
    ``inclusive``: FULL -> no bound; INCR -> stored bookmark, exclusive (no
    bookmark yet -> full); BACKFILL -> ``as_of`` minus N days, inclusive.
    """
    wm = watermarks.select("table_name", F.col("value").alias("watermark"))
    j = config.join(wm, "table_name", "left")
    lt = F.upper(F.col("load_type"))
    # FULL loads everything; everything else takes the incremental path, with
    # BACKFILL re-reading its window (the load type is a two-way switch, so an
    # unexpected value never silently becomes a full reload)
    lower = (F.when(lt == FULL, F.lit(None).cast(TimestampNTZType()))
              .when(lt == BACKFILL, F.date_sub(_lit_date(as_of), F.col("backfill_days").cast("int"))
                    .cast(TimestampNTZType()))
              .otherwise(F.col("watermark").cast(TimestampNTZType())))
    return j.select("table_name", lt.alias("load_type"), "watermark_column", "backfill_days", "watermark",
                    lower.alias("lower_bound"), lt.eqNullSafe(F.lit(BACKFILL)).alias("inclusive"))


def apply_plan(rows: DataFrame, plan: DataFrame, table_col: str, ts_col: str) -> DataFrame:
    """Rows of many logical tables that their plan loads, in one pass.

    The plan has one row per table: the planner broadcasts it from its size,
    and AQE splits a hot table name if it doesn't.
    """
    p = plan.select(F.col("table_name").alias("__t"), F.col("load_type").alias("__lt"),
                    F.col("lower_bound").alias("__lb"), F.col("inclusive").alias("__inc"))
    ts = F.col(ts_col)
    keep = (F.col("__lb").isNull() | (F.col("__inc") & (ts >= F.col("__lb")))
            | (~F.col("__inc") & (ts > F.col("__lb"))))
    j = rows.join(p, F.col(table_col) == F.col("__t"), "inner")
    return j.filter(keep).drop("__t", "__lb", "__inc").withColumnRenamed("__lt", "load_type")


def watermark_max(df: DataFrame, table_col: str, ts_col: str) -> DataFrame:
    """High-water mark per table (A2): partial max before the shuffle."""
    return df.groupBy(F.col(table_col).alias("table_name")).agg(F.max(ts_col).alias("value"))


def watermark_advance(old: DataFrame, loaded: DataFrame, table_col: str, ts_col: str) -> DataFrame:
    """New bookmark = greatest(old, max loaded); an empty load keeps the old."""
    new = watermark_max(loaded, table_col, ts_col).withColumnRenamed("value", "new_value")
    j = old.join(new, "table_name", "full")
    return j.select("table_name", F.greatest(F.col("value"), F.col("new_value")).alias("value"))


def pending_dates(bookmarks: DataFrame, processed: DataFrame, as_of) -> DataFrame:
    """Business dates after each bookmark up to ``as_of`` not yet processed.

    ``bookmarks``: ``source_name, last_date``; ``processed``: ``source_name,
    business_date``. The calendar is generated per source (``sequence``), not
    by a cross join. A source without a bookmark yields no dates: it needs a
    full load first (see :func:`plan_loads`).
    """
    cal = bookmarks.select(
        "source_name",
        F.explode(F.sequence(F.date_add(F.col("last_date").cast(DateType()), 1), _lit_date(as_of)))
         .alias("business_date"))
    return cal.join(processed.select("source_name", "business_date"), ["source_name", "business_date"],
                    "left_anti")


def config_lookup(config: DataFrame, source_name: str | None = None, column: str = "source_name") -> DataFrame:
    """All config rows, or one source's."""
    if source_name is None:
        return config
    return config.filter(F.col(column) == F.lit(source_name))


def dated_paths(listing: DataFrame, root_col: str = "source_folder", date_col: str = "business_date") -> DataFrame:
    """Adds ``path = root/yyyy/MM/dd/``."""
    return listing.withColumn("path", dated_folder(F.col(root_col), F.col(date_col)))


def unprocessed_files(listing: DataFrame, log: DataFrame, keys: Sequence[str] = ("source_name", "file_name"),
                      ok_status: str = "SUCCESS") -> DataFrame:
    """Listed files without a successful log entry."""
    done = log.filter(F.upper(F.col("status")) == ok_status).select(*keys)
    return listing.join(done, list(keys), "left_anti").select(*listing.columns)


def late_files(unprocessed: DataFrame, arrival_col: str = "arrival_date",
               date_col: str = "business_date") -> DataFrame:
    """Unprocessed files that arrived after their business date, with the delay."""
    delay = F.datediff(F.col(arrival_col), F.col(date_col))
    return unprocessed.withColumn("days_late", delay).filter(F.col("days_late") > 0)


def missing_file_alerts(config: DataFrame, listing: DataFrame, start, end,
                        expected_col: str = "expected_daily") -> DataFrame:
    """Expected daily sources with no file for a business date.

    One alert row per (source, date); delivery of alerts is not ours.
    """
    exp = config.filter(F.coalesce(yn_to_bool(F.col(expected_col)), F.lit(False))).select(
        "source_name", F.explode(F.sequence(_lit_date(start), _lit_date(end))).alias("business_date"))
    have = listing.select("source_name", "business_date").distinct()
    return (exp.join(have, ["source_name", "business_date"], "left_anti")
            .withColumn("alert", F.concat(F.lit("missing file: "), F.col("source_name"), F.lit(" "),
                                          F.date_format("business_date", "yyyy-MM-dd"))))


def file_business_date(listing: DataFrame, name_col: str = "file_name", out: str = "business_date") -> DataFrame:
    """Business date parsed from the ``_yyyyMMdd`` part of each file name."""
    return listing.withColumn(out, date_from_file_name(F.col(name_col)))


def files_matching(listing: DataFrame, config: DataFrame, name_col: str = "file_name",
                   pattern_col: str = "file_pattern", source_col: str = "source_name") -> DataFrame:
    """Listed files that match a configured glob of their feed, e.g. ``fuel_txn_*.json``.

    A feed may have several patterns: a file that matches any of them is kept
    once (left semi join on the feed with the glob as extra condition).
    Partial uploads and stray files are left out.
    """
    p = config.select(F.col(source_col).alias("__src"), F.col(pattern_col).alias("__pat")).distinct()
    return listing.join(p, (F.col(source_col) == F.col("__src")) & glob_match(F.col(name_col), F.col("__pat")),
                        "left_semi")


def log_processed(log: DataFrame, files: DataFrame, run_date, status: str = "SUCCESS") -> DataFrame:
    """Processed-file log after a run: old entries plus the files just loaded (K7)."""
    new = files.select("source_name", "file_name", _lit_date(run_date).alias("processed_date"),
                       F.lit(status).alias("status"))
    return log.select("source_name", "file_name", "processed_date", "status").unionByName(new)
