"""Streaming upsert that writes changes, not the table.

The table is a snapshot table (:mod:`tidemark.sinks.snapshots`) of two kinds of parts::

    base      the rows as of the last compaction
    change    the rows of one batch each, numbered by the commit that added them

A batch is written once, as it came, sorted by key bucket and key: the bytes written are in
proportion to the batch, however many buckets it touches. Reading merges: per key and column
the value of the latest commit that has one, and below all of them the base. Compaction writes
a new base once the changes hold a given share of the base's rows, so that over many batches
each change is rewritten a bounded number of times; readers see one or the other.

The rules are those of :func:`tidemark.operators.merge.upsert`, batch after batch: null never
overwrites, nor does ``''`` in a column the table already has; null keys match each other;
columns only a batch has join the table. A key may occur once in a batch (checked).

A batch's number is committed together with its rows under the name of its stream, so a
replayed batch is skipped. A number below the last one can't come from the same stream
checkpoint and is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ..functions.columns import blank_to_null
from ..operators.keys import equal, probe_keys, with_join_keys
from ..operators.merge import DuplicateKeyError, _named_like
from ..sinks.snapshots import Commit, SnapshotTable

BUCKET, ORDER = "__bucket", "__commit"


class ChangeFileUpsert:
    """``foreachBatch`` handler; ``stream`` names the stream whose batches it takes.

    ``compact_share``: compact as soon as the changes hold this share of the base's rows
    (``None``: only when :meth:`compact` is called). ``rows_per_file`` sizes the files.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], stream: str = "stream", *,
                 buckets: int = 256, rows_per_file: int = 2_000_000, compact_share: float | None = 0.5):
        self.table = SnapshotTable(spark, path)
        self.keys, self.stream = list(keys), stream
        self.buckets, self.rows_per_file, self.compact_share = int(buckets), int(rows_per_file), compact_share

    # -- writing

    def init(self, target: DataFrame) -> Commit:
        """Begin the table with the rows of ``target``."""
        return self._new_base(target, target.count(), None)

    def _sorted(self, df: DataFrame, rows: int) -> DataFrame:
        keys = [F.col(f"`{k}`") for k in self.keys]
        files = max(1, -(-rows // self.rows_per_file))
        bucketed = df.withColumn(BUCKET, self._bucket(df))
        return bucketed.repartition(files, *keys).sortWithinPartitions(BUCKET, *keys)

    def _bucket(self, df: DataFrame):
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _new_base(self, rows: DataFrame, count: int, at: Commit | None) -> Commit:
        return self.table.replace(self._sorted(rows, count), kind="base", after=at)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        at = self.table.commit()
        if at is None:
            raise FileNotFoundError(f"{self.table.path} has no commit; call init first")
        last = at.loads.get(self.stream)
        if last is not None and batch_id < last:
            raise ValueError(f"batch {batch_id} of {self.stream!r} comes after batch {last}: another checkpoint "
                             "needs another stream name")
        if batch_id == last:
            return  # replayed after a failure between this commit and the stream's own
        found = (batch.groupBy(*[F.col(f"`{k}`") for k in self.keys]).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first())
        if not found["rows"]:
            return
        if found["most"] > 1:
            raise DuplicateKeyError(f"batch {batch_id} repeats a key of {self.keys}")
        change = self._as_stored(batch, at).withColumn(ORDER, F.lit(at.number + 1).cast(LongType()))
        self.table.append(self._sorted(change, found["rows"]), kind="change", loads={self.stream: batch_id}, after=at)
        if self.compact_share is not None:
            self.compact(self.compact_share)

    def _as_stored(self, batch: DataFrame, at: Commit) -> DataFrame:
        """The batch in the table's spelling and types; blanks that may not overwrite are null."""
        table = self.table.read(at.number)
        known = {f.name: f.dataType for f in table.schema.fields}
        batch = _named_like(batch, table)
        cols = []
        for f in batch.schema.fields:
            c = F.col(f"`{f.name}`")
            if f.name in known and f.dataType != known[f.name]:
                c = c.cast(known[f.name])
            if f.name in known and f.name not in self.keys and isinstance(known[f.name], StringType):
                c = blank_to_null(c)
            cols.append(c.alias(f.name))
        return batch.select(cols)

    def compact(self, share: float = 0.0) -> bool:
        """Write a new base if the changes hold more than ``share`` of the base's rows."""
        at = self.table.commit()
        changed = sum(p.rows for p in at.parts if p.kind == "change")
        base = sum(p.rows for p in at.parts if p.kind == "base")
        if changed == 0 or changed <= share * base:
            return False
        self._new_base(self._merged(at), base + changed, at)
        return True

    # -- reading

    def _merged(self, at: Commit, buckets: Sequence[int] | None = None) -> DataFrame:
        base, changes = self.table.read(at.number, "base"), self.table.read(at.number, "change")
        if buckets is not None:
            base, changes = (df.where(F.col(BUCKET).isin(list(buckets))) for df in (base, changes))
        own = [c for c in base.columns if c not in (BUCKET, ORDER)]
        base = base.select(*[F.col(f"`{c}`") for c in own])
        if not any(p.kind == "change" for p in at.parts):
            return base
        # One row a key; a column without any value stays null.
        payload = [c for c in own if c not in self.keys]
        late = changes.groupBy(*[F.col(f"`{k}`") for k in self.keys]).agg(
            *[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(ORDER))).alias(c) for c in payload],
            F.count(F.lit(1)).alias(ORDER)).drop(ORDER).select(*[F.col(f"`{c}`") for c in own])
        types = [base.schema[k].dataType for k in self.keys]
        b, names = with_join_keys(base, self.keys, types)
        c, _ = with_join_keys(late, self.keys, types)
        bl, cl = b.alias("__b"), c.alias("__c")
        updated = bl.join(cl, equal([F.col(f"__b.{n}") for n in names], [F.col(f"__c.{n}") for n in names]), "left").select(
            [F.col(f"__b.`{x}`") if x in self.keys else F.coalesce(F.col(f"__c.`{x}`"), F.col(f"__b.`{x}`")).alias(x)
             for x in own])
        # New keys are what is left of the changes without the keys that the base has. The base's
        # keys meet the changes first, so that a few changes never shuffle it.
        some, some_names = probe_keys(late, self.keys, types, "__s", distinct=False)
        held, held_names = probe_keys(base, self.keys, types, "__h", distinct=False)
        held = held.join(some, equal(held_names, some_names), "left_semi").distinct()
        added = c.join(held, equal(names, held_names), "left_anti").select(*[F.col(f"`{x}`") for x in own])
        return updated.unionByName(added)

    def latest(self, commit: int | None = None) -> DataFrame:
        """The table as of a commit (the latest)."""
        return self._merged(self.table.commit(commit))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys (a frame with the key columns); reads their buckets alone."""
        at = self.table.commit()
        schema = self.table.read(at.number).schema
        keys = keys.select(*[F.col(f"`{k}`").cast(schema[k].dataType).alias(k) for k in self.keys])
        touched = [r[0] for r in keys.select(self._bucket(keys)).distinct().collect()]  # at most ``buckets`` ints
        types = [schema[k].dataType for k in self.keys]
        rows, names = with_join_keys(self._merged(at, touched), self.keys, types)
        wanted, wanted_names = probe_keys(keys, self.keys, types, "__w")
        return rows.join(wanted, equal(names, wanted_names), "left_semi").drop(*names)
