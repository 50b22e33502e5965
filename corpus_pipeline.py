"""The corpus pipeline over `documents`: each stage is one operator of `tidemark.llm`.

Each stage works on all rows its predecessor kept. All but the last return the columns of
`documents`; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import hyperminhash, langid, mixing, packing, suffix_dedup
from tidemark.llm.common import in_training, staged

#: Shortest repeated passage that goes, in bytes: about 35 words of the usual length. 50 words of
#: fewer than four bytes each, spaces included, can be shorter and stay.
PASSAGE_BYTES = 200


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language (no text or no letter) go."""
    profiles = langid.train_profiles(docs.where(in_training("doc_id", 4)))
    return langid.keep_identified(docs, profiles)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (5-word shingles, Jaccard 0.8)."""
    return hyperminhash.distinct_documents(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat within or across documents go from the texts; all rows stay."""
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the parts of the result, read one after
    the other, hold the sources in their target weights."""
    return mixing.mixed_documents(docs, mixing.source_weights(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in optimal length buckets and token-budget batches, which form in the order
    of the mix, so that every stretch of a bucket's batches follows the target weights."""
    ordered, place = packing.numbered(docs)
    return packing.pack(ordered, order=place)


STAGES = [("language", language), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("mix", mix), ("pack", pack)]

#: Profile ranks, registers and schedules aren't SQL: tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
