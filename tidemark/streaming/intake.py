"""Exactly-once file intake and streaming upsert.

The reference keeps a processed-file log by hand and filters listings
against it. Structured Streaming's file source does the same bookkeeping in
its checkpoint: every file is taken exactly once, a late file dropped into an
*older* dated folder is still picked up by the next run, and a run with
``trigger(availableNow=True)`` processes everything present and stops, which
is how a scheduled batch job consumes a feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.merge import upsert
from ..session import drop_shared, shared_dir
from ..sources.files import format_name


def feed_stream(spark: SparkSession, kind: str, path: str, schema: StructType,
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming read of a file feed with a fixed schema (no inference)."""
    fmt = format_name(kind)
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def file_intake(spark: SparkSession, kind: str, source: str, schema: StructType, sink: str, checkpoint: str,
                partition_by: Sequence[str] | None = None, max_files_per_trigger: int | None = None,
                timeout_s: float | None = None, **options) -> StreamingQuery:
    """Land every new file of a feed into a parquet sink exactly once (I8).

    The parquet sink's commit log plus the source offsets in ``checkpoint``
    make re-runs idempotent: a second run with no new files adds nothing.
    Returns the finished query (``availableNow`` run).
    """
    stream = feed_stream(spark, kind, source, schema, max_files_per_trigger, **options)
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(sink)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("file intake did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


class SnapshotUpsert:
    """``foreachBatch`` handler merging each micro-batch into the target.

    Parquet has no row-level MERGE, so every batch ``b`` reads snapshot ``b``
    and writes snapshot ``b + 1`` next to it (never over the table it reads).
    A batch replayed after a failure rewrites the same ``b + 1`` from the same
    ``b``: the handler is idempotent by batch id.
    """

    def __init__(self, root: str, keys: Sequence[str]):
        self.root = root.rstrip("/")
        self.keys = list(keys)

    def snapshot(self, n: int) -> str:
        return f"{self.root}/snap-{n:08d}"

    def init(self, target: DataFrame) -> None:
        """Write the starting snapshot (number 0)."""
        target.write.mode("overwrite").parquet(self.snapshot(0))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        current = spark.read.parquet(self.snapshot(batch_id))
        upsert(current, batch, self.keys).write.mode("overwrite").parquet(self.snapshot(batch_id + 1))

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest complete snapshot in storage (its job wrote ``_SUCCESS``), so a
        handler rebuilt after a restart sees what earlier runs have merged."""
        jvm = spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/snap-*/_SUCCESS")
        store = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        done = sorted(s.getPath().getParent().toString() for s in store.globStatus(pattern))
        if not done:
            raise FileNotFoundError(f"no complete snapshot below {self.root}")
        return spark.read.parquet(done[-1])


class BucketedUpsert:
    """``foreachBatch`` handler that rewrites only the key buckets a batch touches.

    The standard table is partitioned by ``pmod(xxhash64(key), buckets)``. A
    batch reads just its buckets (partition pruning), merges, stages the result
    in the shared checkpoint folder and replaces those bucket folders with
    dynamic partition overwrite; all other buckets are not read or written, so
    a batch costs O(touched buckets), not O(table). The target is never read
    and overwritten by the same job (the staged copy sits in between). A batch
    replayed after a failure re-applies the same upsert, which is idempotent
    for unique source keys.
    """

    BUCKET = "__bucket"

    def __init__(self, path: str, keys: Sequence[str], buckets: int = 256, files_per_bucket: int = 1):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.buckets = int(buckets)
        self.files_per_bucket = int(files_per_bucket)
        self.key_types: dict = {}

    def _bucket(self, df: DataFrame) -> DataFrame:
        ks = [F.col(f"`{k}`").cast(self.key_types[k]) for k in self.keys]
        return df.withColumn(self.BUCKET, F.pmod(F.xxhash64(*ks), F.lit(self.buckets)).cast("int"))

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows of one bucket in ``files_per_bucket`` tasks, so a write makes that many
        files a bucket, not one per task and bucket."""
        ks = [F.col(f"`{k}`").cast(self.key_types[k]) for k in self.keys]
        salt = F.pmod(F.hash(*ks), F.lit(self.files_per_bucket))
        return df.repartition(self.buckets * self.files_per_bucket, F.col(self.BUCKET), salt)

    def init(self, target: DataFrame) -> None:
        """Write the starting table, one folder per bucket."""
        self.key_types = {f.name: f.dataType for f in target.schema.fields if f.name in self.keys}
        (self._dealt(self._bucket(target)).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(self.BUCKET).parquet(self.path))

    def _read(self, spark: SparkSession) -> DataFrame:
        # batches may add columns to the buckets they rewrite
        return spark.read.option("mergeSchema", "true").parquet(self.path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not self.key_types:  # handler rebuilt after a restart: learn key types from the table
            self.key_types = {f.name: f.dataType for f in self._read(spark).schema.fields if f.name in self.keys}
        incoming = self._bucket(batch)
        # touched bucket ids: at most ``buckets`` small ints
        touched = [r[0] for r in incoming.select(self.BUCKET).distinct().collect()]
        if not touched:
            return
        current = self._read(spark).filter(F.col(self.BUCKET).isin(touched))
        merged = upsert(current, incoming, self.keys)
        staged = shared_dir(spark, f"bucket-stage-{batch_id}")
        merged.write.mode("overwrite").parquet(staged)
        (self._dealt(spark.read.parquet(staged)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.BUCKET).parquet(self.path))
        drop_shared(spark, staged)

    def latest(self, spark: SparkSession) -> DataFrame:
        return self._read(spark).drop(self.BUCKET)


def stream_upsert(spark: SparkSession, kind: str, source: str, schema: StructType, handler,
                  checkpoint: str, max_files_per_trigger: int | None = None, timeout_s: float | None = None,
                  **options) -> StreamingQuery:
    """Run the feed through a ``foreachBatch`` upsert handler until caught up."""
    stream = feed_stream(spark, kind, source, schema, max_files_per_trigger, **options)
    q = (stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream upsert did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q
