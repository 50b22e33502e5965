"""Streaming queries (I8, I9): feeds written from driver tables, consumed with
``availableNow`` runs; feed, sink and checkpoints live in the shared folder."""

from __future__ import annotations

from ..session import shared_dir
from ..sinks.writers import text_writer
from ..streaming.changes import ChangeFileUpsert
from ..streaming.intake import BucketedUpsert, file_intake, stream_upsert
from .merge_queries import _CHANGES_SQL, customer_changes, customer_target
from .registry import register, table


@register("stream_file_intake", "SELECT * FROM events")
def q_stream_file_intake(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    feed, sink, ckpt = shared_dir(spark, "feed"), shared_dir(spark, "landed"), shared_dir(spark, "ckpt")
    text_writer(ev, "json", partition_by=["event_type"]).save(feed)
    schema = ev.drop("event_type").schema.add("event_type", "string")
    file_intake(spark, "JSON", feed, schema, sink, ckpt, partition_by=["event_type"], max_files_per_trigger=8)
    return spark.read.parquet(sink)


_UPSERT_SQL = f"""
WITH t AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer),
{_CHANGES_SQL}
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name,
       coalesce(nullif(s.c_mktsegment, ''), t.c_mktsegment) AS c_mktsegment,
       coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, s.c_nationkey
FROM t FULL OUTER JOIN s ON t.c_custkey IS NOT DISTINCT FROM s.c_custkey
"""


@register("stream_upsert", _UPSERT_SQL)
def q_stream_upsert(spark, sf_dir):
    changes = customer_changes(spark, sf_dir)
    feed, ckpt = shared_dir(spark, "changes"), shared_dir(spark, "ckpt")
    # each key is delivered once, spread round-robin over several files and micro-batches
    text_writer(changes.repartition(8), "json").save(feed)
    handler = BucketedUpsert(shared_dir(spark, "sdm"), ["c_custkey"], buckets=16)
    handler.init(customer_target(spark, sf_dir))
    stream_upsert(spark, "JSON", feed, changes.schema, handler, ckpt, max_files_per_trigger=2)
    return handler.latest(spark)


@register("stream_upsert_changes", _UPSERT_SQL)
def q_stream_upsert_changes(spark, sf_dir):
    """Four batches as change files; the table is compacted once on the way, as soon as the
    changes hold 60 % of the base's rows, and read with the other batches not yet merged."""
    changes = customer_changes(spark, sf_dir)
    feed, ckpt = shared_dir(spark, "changes"), shared_dir(spark, "ckpt")
    text_writer(changes.repartition(8), "json").save(feed)
    handler = ChangeFileUpsert(spark, shared_dir(spark, "sdm"), ["c_custkey"], "customer-feed", compact_share=0.6)
    handler.init(customer_target(spark, sf_dir))
    stream_upsert(spark, "JSON", feed, changes.schema, handler, ckpt, max_files_per_trigger=2)
    return handler.latest()
