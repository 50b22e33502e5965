"""Catalogue of registered queries and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that reads the
driver's parquet tables, derives the operator's inputs from them with Spark
expressions (so the work grows with the tables) and applies the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``sql`` is its oracle (omit for rows-only checks)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes its columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every query module so that its ``register`` calls run."""
    from . import (  # noqa: F401
        clean_queries,
        drift_queries,
        file_queries,
        gold_queries,
        history_queries,
        ingest_queries,
        load_queries,
        mapping_queries,
        merge_queries,
        quality_queries,
        security_queries,
        stream_queries,
        union_queries,
    )
