"""File round-trip queries.

Each query writes driver tables as real files into a fresh folder under the
shared checkpoint folder (``spark.checkpoint.dir``; never a machine-local
temp folder on a cluster), reads them back through the operator and returns
the result. Nondeterministic lineage (part-file names, load ids) is kept in
the written data but left out of the returned columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.columns import yn_to_bool
from ..operators.quality import Rule, validate
from ..session import shared_dir
from ..sinks.writers import land_bronze, text_writer, with_lineage, write_observed, write_silver
from ..sources.files import list_files, read_evolving, read_files, read_source
from ..operators.runs import Zones, run_file_pipeline
from .load_queries import feed_config
from .registry import register, table

INGEST_DATE = "2024-02-01"


@register("file_csv", "SELECT * FROM part")
def q_file_csv(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = shared_dir(spark, "feed-csv")
    text_writer(part, "csv").save(path)
    return read_source(spark, "CSV", path, schema=part.schema)


@register("file_json", "SELECT * FROM customer")
def q_file_json(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    path = shared_dir(spark, "feed-json")
    text_writer(cust, "json").save(path)
    return read_source(spark, "JSON", path, schema=cust.schema)


@register("file_parquet", "SELECT * FROM orders")
def q_file_parquet(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "feed-parquet")
    orders.write.parquet(path)
    return read_source(spark, "PARQUET", path)


@register("generic_read", "SELECT * FROM lineitem")
def q_generic_read(spark, sf_dir):
    return read_source(spark, "parquet", f"{sf_dir.rstrip('/')}/lineitem.parquet")


def _write_dated_feed(spark, sf_dir):
    """Events as JSON files in ``source/yyyy/MM/dd`` folders (one feed per type)."""
    ev = table(spark, sf_dir, "events")
    root = shared_dir(spark, "feeds")
    dated = ev.withColumns({"yyyy": F.date_format("ts", "yyyy"), "MM": F.date_format("ts", "MM"),
                            "dd": F.date_format("ts", "dd")})
    text_writer(dated, "json", partition_by=["event_type", "yyyy", "MM", "dd"]).save(root)
    return root, ev.drop("event_type").schema


FOLDER = r"event_type=([^/]+)/yyyy=(\d{4})/MM=(\d{2})/dd=(\d{2})/"


def feed_of(path: str):
    """Feed name from a file's path in the dated layout."""
    return F.regexp_extract(F.col(path), FOLDER, 1)


def day_of(path: str):
    """Business date from a file's path in the dated layout."""
    return F.to_date(F.concat_ws("-", *(F.regexp_extract(F.col(path), FOLDER, i) for i in (2, 3, 4))))


@register("file_inventory", """
SELECT event_type AS source_name, CAST(ts AS DATE) AS business_date, count(*) AS n_records
FROM events GROUP BY 1, 2
""")
def q_file_inventory(spark, sf_dir):
    """The folders that the file listing shows, with the records their files hold."""
    root, schema = _write_dated_feed(spark, sf_dir)
    listed = list_files(spark, root, "*.json").select(feed_of("file_path").alias("source_name"),
                                                      day_of("file_path").alias("business_date")).distinct()
    df = read_files(spark, "JSON", root, schema, pathGlobFilter="*.json", recursiveFileLookup="true")
    counts = (df.select(feed_of("_file_path").alias("source_name"), day_of("_file_path").alias("business_date"))
              .groupBy("source_name", "business_date").agg(F.count(F.lit(1)).alias("n_records")))
    return listed.join(counts, ["source_name", "business_date"])


@register("bronze_land", f"""
SELECT event_id, ts, user_id, value, props, event_type AS source_name, DATE '{INGEST_DATE}' AS _ingest_date
FROM events
""")
def q_bronze_land(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    feed = shared_dir(spark, "feed-events")
    text_writer(ev, "json", partition_by=["event_type"]).save(feed)
    raw = read_source(spark, "JSON", feed, ev.drop("event_type").schema)
    landed = with_lineage(raw.withColumnRenamed("event_type", "source_name"), ingest_date=INGEST_DATE,
                          load_id="run-1")
    bronze = shared_dir(spark, "bronze")
    land_bronze(landed, bronze)
    return (read_source(spark, "PARQUET", bronze)
            .select("event_id", "ts", "user_id", "value", "props", "source_name", "_ingest_date"))


@register("bronze_evolve", """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts < TIMESTAMP '2024-01-15' THEN value END AS value,
       CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN props END AS props,
       CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN CASE WHEN value > 50 THEN 'web' ELSE 'app' END END AS channel
FROM events
""")
def q_bronze_evolve(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cut = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    p1, p2 = shared_dir(spark, "batch1"), shared_dir(spark, "batch2")
    ev.filter(cut).select("event_id", "ts", "user_id", "event_type", "value").write.parquet(p1)
    ev.filter(~cut).select("event_id", "ts", "user_id", "event_type", "props",
                           F.when(F.col("value") > 50, "web").otherwise("app").alias("channel")).write.parquet(p2)
    return read_evolving(spark, "PARQUET", [p1, p2])


@register("bronze_evolve_types", """
SELECT l_orderkey, l_linenumber, l_shipdate,
       CAST(CASE WHEN l_shipdate < DATE '1995-01-01' THEN floor(l_quantity) ELSE l_quantity END AS DOUBLE)
         AS l_quantity,
       CASE WHEN l_shipdate < DATE '1995-01-01' THEN CAST(l_suppkey AS VARCHAR)
            ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS supplier,
       CAST(CASE WHEN l_shipdate < DATE '1997-01-01' THEN l_partkey
            ELSE l_partkey + 0.25 END AS DECIMAL(21,2)) AS part,
       CASE WHEN l_shipdate >= DATE '1997-01-01' THEN l_linestatus END AS l_linestatus
FROM lineitem
""")
def q_bronze_evolve_types(spark, sf_dir):
    """Three batches of one feed: quantity turns from int to double, the supplier from a number to
    text, the part from bigint to decimal, and a column comes in with the last batch."""
    li = table(spark, sf_dir, "lineitem")
    day, kind = F.col("l_shipdate"), li.schema["l_shipdate"].dataType
    early, late = day < F.lit("1995-01-01").cast(kind), day >= F.lit("1997-01-01").cast(kind)
    common = ["l_orderkey", "l_linenumber", "l_shipdate"]
    as_text = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    batches = [
        (early, [F.floor("l_quantity").cast("int").alias("l_quantity"), F.col("l_suppkey").cast("int").alias("supplier"),
                 F.col("l_partkey").cast("long").alias("part")]),
        (~early & ~late, [F.col("l_quantity"), as_text.alias("supplier"), F.col("l_partkey").cast("long").alias("part")]),
        (late, [F.col("l_quantity"), as_text.alias("supplier"),
                (F.col("l_partkey") + F.lit("0.25").cast("decimal(3,2)")).cast("decimal(14,2)").alias("PART"), F.col("l_linestatus")])]
    paths = []
    for rows, columns in batches:
        paths.append(shared_dir(spark, "evolving"))
        li.filter(rows).select(*common, *columns).write.parquet(paths[-1])
    return read_evolving(spark, "PARQUET", paths)


# Fixed silver rules for the event feeds.
SILVER_RULES = [Rule("v1", "value", "range", (0, 400)), Rule("v2", "user_id", "not_null")]


@register("silver_load", """
SELECT event_id, ts, user_id, value, props, event_type AS source_name FROM events
WHERE event_type = 'view' OR (value >= 0 AND value <= 400 AND user_id IS NOT NULL)
""")
def q_silver_load(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumnRenamed("event_type", "source_name")
    cfg = feed_config(spark, sf_dir).select("source_name", "validation_required")
    # config is one row per feed: the planner broadcasts it, the events aren't shuffled
    flagged = ev.join(cfg, "source_name", "left")
    checked = validate(flagged, SILVER_RULES)
    required = F.coalesce(yn_to_bool(F.col("validation_required")), F.lit(True))
    silver_rows = checked.filter(~required | (F.col("failed_rules") == "")).drop("validation_required",
                                                                                  "failed_rules")
    path = shared_dir(spark, "silver")
    write_silver(silver_rows, path, partition_by=["source_name"])
    return read_source(spark, "PARQUET", path).select("event_id", "ts", "user_id", "value", "props", "source_name")


@register("load_report", """
SELECT 'customer_' || lower(r_name) AS target_table, 'sdm' AS schema, count(c_custkey) AS rows_loaded
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
GROUP BY r_name
""")
def q_load_report(spark, sf_dir):
    """Customers written by region in one pass, counted by one aggregation of what landed;
    a region without customers reports 0."""
    region = table(spark, sf_dir, "region")
    geo = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "r_name")
    path = shared_dir(spark, "sdm-customer")
    write_observed(rows, path, partition_by=["r_name"])
    landed = read_source(spark, "PARQUET", path, schema=rows.schema).groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))
    return region.select("r_name").distinct().join(landed, "r_name", "left").select(
        F.concat(F.lit("customer_"), F.lower("r_name")).alias("target_table"), F.lit("sdm").alias("schema"),
        F.coalesce(F.col("n"), F.lit(0)).cast(LongType()).alias("rows_loaded"))


# Fixed run settings: the error feed carries a field its registry doesn't have.
RUN_REGISTRY = [(s, f, k) for s in ("click", "error", "purchase", "signup", "view")
                for f, k in (("event_id", "number"), ("ts", "string"), ("user_id", "number"), ("value", "number"),
                             ("props", "string"))]
RUN_RULES = [Rule("v1", "value", "range", (0, 300)), Rule("v2", "user_id", "not_null")]


@register("file_pipeline_run", """
SELECT event_id, value, event_type AS source_name,
       CASE WHEN event_type = 'error' OR NOT (value >= 0 AND value <= 300) OR user_id IS NULL
            THEN 'quarantine' ELSE 'silver' END AS zone,
       CASE WHEN event_type = 'error' THEN 'schema drift'
            ELSE concat_ws(',', CASE WHEN NOT (value >= 0 AND value <= 300) THEN 'v1' END,
                           CASE WHEN user_id IS NULL THEN 'v2' END) END AS failed_rules
FROM events
""")
def q_file_pipeline_run(spark, sf_dir):
    """The file pipeline over dated JSON feeds, run twice: the second run finds nothing new."""
    ev = table(spark, sf_dir, "events")
    landing = shared_dir(spark, "landing")
    dated = ev.withColumns({"yyyy": F.date_format("ts", "yyyy"), "MM": F.date_format("ts", "MM"),
                            "dd": F.date_format("ts", "dd"),
                            "trace": F.when(F.col("event_type") == "error", F.lit("stack"))})
    text_writer(dated, "json", partition_by=["event_type", "yyyy", "MM", "dd"]).save(landing)
    config = feed_config(spark, sf_dir).withColumn("file_pattern", F.lit("part-*.json"))
    zones = Zones(shared_dir(spark, "pipeline"))
    for run_id in ("run-1", "run-2"):
        run_file_pipeline(spark, config, landing, zones, source_of=feed_of("file_path"), date_of=day_of("file_path"),
                          schema=ev.drop("event_type").schema,
                          registry=spark.createDataFrame(RUN_REGISTRY, "source_name string, field string, type string"),
                          rules=RUN_RULES, run_id=run_id, run_date="2024-02-01", since="2024-01-01")
    silver = spark.read.parquet(zones.silver).select("event_id", "value", "source_name", F.lit("silver").alias("zone"),
                                                     F.lit("").alias("failed_rules"))
    held = spark.read.parquet(zones.quarantine).select("event_id", "value", "source_name",
                                                       F.lit("quarantine").alias("zone"), "failed_rules")
    return silver.unionByName(held)
