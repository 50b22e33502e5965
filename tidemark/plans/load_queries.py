"""Load-type queries (I1-I7, J8-J10, A2, S8, S10, K7) over the events table.

Event types stand for source tables / feeds. Bookmarks, processed logs and
the feed listing are derived from the events themselves, so every query's
work grows with the table; only the per-table load config is a fixed list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

from ..operators.incremental import (
    apply_plan,
    config_lookup,
    dated_paths,
    file_business_date,
    files_matching,
    late_files,
    load_backfill,
    load_full,
    load_incremental,
    log_processed,
    missing_file_alerts,
    pending_dates,
    plan_loads,
    unprocessed_files,
    watermark_advance,
    watermark_max,
)
from ..operators.runs import run_table_loads
from ..sources.target import read_target
from ..session import shared_dir
from .registry import register, table

AS_OF = "2024-01-31"
PREVIOUS_RUN = "2024-01-20"

# Fixed load config: table, load type, bookmark column, backfill days.
LOAD_CONFIG = [
    ("click", "FULL", "ts", None),
    ("error", "INCR", "ts", None),
    ("purchase", "INCR", "ts", None),
    ("signup", "BACKFILL", "ts", 3),
    ("view", "BACKFILL", "ts", 10),
    ("refund", "INCR", "ts", None),
]
LOAD_CONFIG_SCHEMA = StructType([
    StructField("table_name", StringType()), StructField("load_type", StringType()),
    StructField("watermark_column", StringType()), StructField("backfill_days", IntegerType())])

_CFG_SQL = """cfg AS (SELECT * FROM (VALUES ('click', 'FULL', NULL), ('error', 'INCR', NULL),
  ('purchase', 'INCR', NULL), ('signup', 'BACKFILL', 3), ('view', 'BACKFILL', 10), ('refund', 'INCR', NULL))
  v(table_name, load_type, backfill_days))"""
_WM_SQL = f"""wm AS (SELECT event_type AS table_name, max(ts) AS value FROM events
  WHERE ts < TIMESTAMP '{PREVIOUS_RUN}' GROUP BY event_type
  UNION ALL SELECT 'refund', TIMESTAMP '2024-01-10')"""
_PLAN_SQL = f"""plan AS (SELECT c.table_name, c.load_type,
  CASE WHEN c.load_type = 'INCR' THEN w.value
       WHEN c.load_type = 'BACKFILL' THEN CAST(DATE '{AS_OF}' - CAST(c.backfill_days AS INTEGER) AS TIMESTAMP)
  END AS lb
  FROM cfg c LEFT JOIN wm w ON c.table_name = w.table_name),
loaded AS (SELECT e.*, p.load_type FROM events e JOIN plan p ON e.event_type = p.table_name
  WHERE p.lb IS NULL OR (p.load_type = 'BACKFILL' AND e.ts >= p.lb)
     OR (p.load_type <> 'BACKFILL' AND e.ts > p.lb))"""


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def previous_watermarks(spark, sf_dir):
    ev = events(spark, sf_dir).filter(F.col("ts") < F.lit(PREVIOUS_RUN).cast(TimestampNTZType()))
    extra = spark.createDataFrame([("refund", "2024-01-10 00:00:00")], ["table_name", "value"]).select(
        "table_name", F.col("value").cast(TimestampNTZType()).alias("value"))
    return watermark_max(ev, "event_type", "ts").unionByName(extra)


def planned_rows(spark, sf_dir):
    cfg = spark.createDataFrame(LOAD_CONFIG, LOAD_CONFIG_SCHEMA)
    plan = plan_loads(cfg, previous_watermarks(spark, sf_dir), AS_OF)
    return apply_plan(events(spark, sf_dir), plan, "event_type", "ts")


@register("load_full", "SELECT * FROM events")
def q_load_full(spark, sf_dir):
    return load_full(events(spark, sf_dir))


@register("load_incremental", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def q_load_incremental(spark, sf_dir):
    return load_incremental(events(spark, sf_dir), "ts", "2024-01-20 00:00:00")


@register("load_backfill", f"SELECT * FROM events WHERE ts >= CAST(DATE '{AS_OF}' - 7 AS TIMESTAMP)")
def q_load_backfill(spark, sf_dir):
    return load_backfill(events(spark, sf_dir), "ts", AS_OF, 7)


@register("load_plan", f"WITH {_CFG_SQL}, {_WM_SQL}, {_PLAN_SQL} SELECT * FROM loaded")
def q_load_plan(spark, sf_dir):
    return planned_rows(spark, sf_dir)


@register("watermark_max", "SELECT event_type AS table_name, max(ts) AS value FROM events GROUP BY event_type")
def q_watermark_max(spark, sf_dir):
    return watermark_max(events(spark, sf_dir), "event_type", "ts")


@register("watermark_advance", f"""WITH {_CFG_SQL}, {_WM_SQL}, {_PLAN_SQL},
newmax AS (SELECT event_type AS table_name, max(ts) AS new_value FROM loaded GROUP BY event_type)
SELECT coalesce(w.table_name, n.table_name) AS table_name, greatest(w.value, n.new_value) AS value
FROM wm w FULL OUTER JOIN newmax n ON w.table_name = n.table_name""")
def q_watermark_advance(spark, sf_dir):
    return watermark_advance(previous_watermarks(spark, sf_dir), planned_rows(spark, sf_dir), "event_type", "ts")


def _bookmarks_and_processed(spark, sf_dir):
    ev = events(spark, sf_dir)
    bookmarks = (ev.filter(F.col("ts") < F.lit(PREVIOUS_RUN).cast(TimestampNTZType()))
                 .groupBy(F.col("event_type").alias("source_name"))
                 .agg(F.to_date(F.max("ts")).alias("last_date")))
    processed = (ev.filter(F.hour("ts") == 0)
                 .select(F.col("event_type").alias("source_name"), F.to_date("ts").alias("business_date"))
                 .distinct())
    return bookmarks, processed


@register("pending_dates", f"""
WITH b AS (SELECT event_type AS source_name, CAST(max(ts) AS DATE) AS last_date FROM events
           WHERE ts < TIMESTAMP '{PREVIOUS_RUN}' GROUP BY event_type),
p AS (SELECT DISTINCT event_type AS source_name, CAST(ts AS DATE) AS business_date FROM events
      WHERE hour(ts) = 0),
cal AS (SELECT source_name,
               CAST(unnest(generate_series(CAST(last_date + 1 AS TIMESTAMP), TIMESTAMP '{AS_OF}',
                                           INTERVAL 1 DAY)) AS DATE) AS business_date
        FROM b)
SELECT source_name, business_date FROM cal
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source_name = cal.source_name AND p.business_date = cal.business_date)
""")
def q_pending_dates(spark, sf_dir):
    bookmarks, processed = _bookmarks_and_processed(spark, sf_dir)
    return pending_dates(bookmarks, processed, AS_OF)


def feed_config(spark, sf_dir):
    """File-ingestion config (F8) for the feeds the event types stand for."""
    t = F.col("event_type")
    return events(spark, sf_dir).select(t.alias("source_name")).distinct().select(
        "source_name",
        F.concat(F.lit("/feeds/"), "source_name", F.lit("/")).alias("source_folder"),
        F.concat("source_name", F.lit("_*.json")).alias("file_pattern"),
        F.lit("JSON").alias("file_type"),
        F.concat(F.lit("silver_"), "source_name").alias("target_table"),
        F.lit("Y").alias("date_partitioned"),
        F.lit("Y").alias("expected_daily"),
        F.when(F.col("source_name") != "view", "Y").otherwise("N").alias("validation_required"))


_FEED_CFG_SQL = """cfg AS (SELECT source_name, '/feeds/' || source_name || '/' AS source_folder,
  source_name || '_*.json' AS file_pattern, 'JSON' AS file_type, 'silver_' || source_name AS target_table,
  'Y' AS date_partitioned, 'Y' AS expected_daily,
  CASE WHEN source_name <> 'view' THEN 'Y' ELSE 'N' END AS validation_required
  FROM (SELECT DISTINCT event_type AS source_name FROM events) d)"""


@register("config_lookup", f"WITH {_FEED_CFG_SQL} SELECT * FROM cfg WHERE source_name = 'purchase'")
def q_config_lookup(spark, sf_dir):
    return config_lookup(feed_config(spark, sf_dir), "purchase")


def feed_listing(spark, sf_dir):
    """One file per (feed, business day) with its record count; every fifth
    file by record count arrives a day late."""
    ev = events(spark, sf_dir)
    g = ev.groupBy(F.col("event_type").alias("source_name"), F.to_date("ts").alias("business_date")).agg(
        F.count(F.lit(1)).alias("n_records"))
    return g.select(
        "source_name",
        F.concat(F.lit("/feeds/"), "source_name", F.lit("/")).alias("source_folder"),
        F.concat("source_name", F.lit("_"), F.date_format("business_date", "yyyyMMdd"), F.lit(".json"))
         .alias("file_name"),
        "business_date",
        F.when(F.col("n_records") % 5 == 0, F.date_add("business_date", 1))
         .otherwise(F.col("business_date")).alias("arrival_date"),
        "n_records")


def processed_log(listing):
    """Files before the 25th were processed; those of every 7th day failed."""
    return listing.filter(F.col("business_date") < F.lit("2024-01-25").cast("date")).select(
        "source_name", "file_name", F.date_add("business_date", 1).alias("processed_date"),
        F.when(F.dayofmonth("business_date") % 7 == 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"))


_LISTING_BODY = """
  SELECT source_name, '/feeds/' || source_name || '/' AS source_folder,
         source_name || '_' || strftime(business_date, '%Y%m%d') || '.json' AS file_name,
         business_date,
         CASE WHEN n_records % 5 = 0 THEN business_date + 1 ELSE business_date END AS arrival_date,
         n_records
  FROM (SELECT event_type AS source_name, CAST(ts AS DATE) AS business_date, count(*) AS n_records
        FROM events GROUP BY 1, 2) g"""
_LISTING_SQL = f"""listing AS ({_LISTING_BODY}),
log AS (
  SELECT source_name, file_name, business_date + 1 AS processed_date,
         CASE WHEN day(business_date) % 7 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM listing WHERE business_date < DATE '2024-01-25'),
unprocessed AS (
  SELECT * FROM listing l WHERE NOT EXISTS (
    SELECT 1 FROM log g WHERE g.status = 'SUCCESS' AND g.source_name = l.source_name
                          AND g.file_name = l.file_name))"""


@register("dated_paths", f"""WITH {_LISTING_SQL}
SELECT *, source_folder || strftime(business_date, '%Y/%m/%d') || '/' AS path FROM listing""")
def q_dated_paths(spark, sf_dir):
    return dated_paths(feed_listing(spark, sf_dir))


@register("unprocessed_files", f"WITH {_LISTING_SQL} SELECT * FROM unprocessed")
def q_unprocessed_files(spark, sf_dir):
    listing = feed_listing(spark, sf_dir)
    return unprocessed_files(listing, processed_log(listing))


@register("late_files", f"""WITH {_LISTING_SQL}
SELECT *, CAST(date_diff('day', business_date, arrival_date) AS INTEGER) AS days_late FROM unprocessed
WHERE date_diff('day', business_date, arrival_date) > 0""")
def q_late_files(spark, sf_dir):
    listing = feed_listing(spark, sf_dir)
    pending = unprocessed_files(listing, processed_log(listing))
    # the business date a file stands for is the one in its name
    return late_files(file_business_date(pending))


@register("missing_file_alerts", f"""WITH {_FEED_CFG_SQL}, {_LISTING_SQL},
cal AS (SELECT source_name, CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '{AS_OF}',
                                                        INTERVAL 1 DAY)) AS DATE) AS business_date
        FROM cfg WHERE expected_daily = 'Y')
SELECT source_name, business_date,
       'missing file: ' || source_name || ' ' || strftime(business_date, '%Y-%m-%d') AS alert
FROM cal c WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.source_name = c.source_name
                                                        AND l.business_date = c.business_date)""")
def q_missing_file_alerts(spark, sf_dir):
    return missing_file_alerts(feed_config(spark, sf_dir), feed_listing(spark, sf_dir), "2024-01-01", AS_OF)


@register("file_log_update", f"""WITH {_LISTING_SQL}
SELECT source_name, file_name, processed_date, status FROM log
UNION ALL
SELECT source_name, file_name, DATE '2024-02-01', 'SUCCESS' FROM unprocessed""")
def q_file_log_update(spark, sf_dir):
    listing = feed_listing(spark, sf_dir)
    log = processed_log(listing)
    return log_processed(log, unprocessed_files(listing, log), "2024-02-01")


@register("feed_file_match", f"""WITH {_FEED_CFG_SQL},
landing AS (
  SELECT source_name, source_folder,
         CASE WHEN n_records % 7 = 0 THEN replace(file_name, '.json', '.json.tmp') ELSE file_name END AS file_name,
         business_date, arrival_date, n_records
  FROM ({_LISTING_BODY}) l)
SELECT l.* FROM landing l WHERE EXISTS (
  SELECT 1 FROM cfg c WHERE c.source_name = l.source_name AND l.file_name GLOB c.file_pattern)
  OR (l.source_name = 'click' AND (l.file_name GLOB 'click_2024010*.tmp' OR l.file_name GLOB 'click_2024*'))""")
def q_feed_file_match(spark, sf_dir):
    """Files in the landing folders, some still partial uploads (``.tmp``), matched
    against each feed's configured pattern."""
    listing = feed_listing(spark, sf_dir)
    landing = listing.withColumn(
        "file_name", F.when(F.col("n_records") % 7 == 0, F.concat("file_name", F.lit(".tmp")))
        .otherwise(F.col("file_name")))
    config = feed_config(spark, sf_dir).select("source_name", "file_pattern")
    # a feed may have several patterns, and a file may match more than one
    more = spark.createDataFrame([("click", "click_2024010*.tmp"), ("click", "click_2024*")], config.schema)
    return files_matching(landing, config.unionByName(more))


@register("table_load_run", f"""
SELECT event_id, event_type AS table_name FROM events
WHERE event_type IN ('click', 'purchase') OR (event_type = 'view' AND ts >= CAST(DATE '{AS_OF}' - 10 AS TIMESTAMP))""")
def q_table_load_run(spark, sf_dir):
    """Full, incremental and backfill loads, run twice into the same folder; a table whose
    source can't be read is logged and the others finish."""
    ev = events(spark, sf_dir)
    root = shared_dir(spark, "tables")
    config = [dict(zip(("table_name", "load_type", "watermark_column", "backfill_days"), c)) for c in (
        ("click", "FULL", "ts", None), ("gone", "INCR", "ts", None), ("purchase", None, "ts", None),
        ("view", "BACKFILL", "ts", 10))]

    def read(name):
        if name == "gone":
            raise FileNotFoundError(name)
        return ev.filter(F.col("event_type") == name)

    for run_id in ("run-1", "run-2"):
        run_table_loads(spark, config, read, root, as_of=AS_OF, run_id=run_id)
    loaded = [read_target(spark, f"{root}/{c['table_name']}", ev.schema).select("event_id", F.lit(c["table_name"]).alias("table_name"))
              for c in config if c["table_name"] != "gone"]
    return reduce(lambda a, b: a.unionByName(b), loaded)
