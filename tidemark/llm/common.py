"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, name: str, batch_rows: int = 1000) -> DataFrame:
    """Write a frame below the shared folder and read it back: cuts lineage so that a
    lost executor costs a re-read, not a recomputation of all earlier steps.

    For the time of the write, Arrow batches have ``batch_rows`` rows: with whole texts in
    them, the default of 10,000 takes tens of MB several times over.
    """
    spark = df.sparkSession
    path, before = stage_dir(spark, name), spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def in_training(column, modulus: int, held: int = 2):
    """True for rows whose crc32 of the id as text, modulo ``modulus``, isn't ``held``;
    a null id counts as the text ''."""
    return F.expr(f"crc32(cast(coalesce(cast({column} as string), '') as binary)) % {modulus}") != held


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller parts, for tasks that copy whole texts; at the end the
    worker gives its free memory back."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
    pa.default_memory_pool().release_unused()


#: Rows and array elements of a side that is broadcast at most (a few dozen bytes each);
#: beyond, the same join is shuffled.
BROADCAST_ITEMS = 1_000_000


def small_side(df: DataFrame, arrays: str | None = None) -> DataFrame:
    """``df`` (a staged frame of numbers) with a broadcast hint if its rows, and the elements
    of its column ``arrays``, are at most BROADCAST_ITEMS."""
    items = F.count(F.lit(1)) if arrays is None else F.coalesce(F.sum(F.size(arrays) + 1), F.lit(0))
    return F.broadcast(df) if df.agg(items).first()[0] <= BROADCAST_ITEMS else df
