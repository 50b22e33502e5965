"""Rule-driven selective ingestion.

A rule names a source, the columns to keep and an optional SQL predicate.
The chain read -> filter -> select stays lazy, so Catalyst pushes the
predicate and the column list into the scan (parquet ``PushedFilters`` /
``ReadSchema``, or the JDBC query's WHERE and column list).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IngestionRule:
    """One ingestion rule."""

    source_type: str
    source_table: str
    target_table: str
    columns: tuple[str, ...]
    filter_condition: str | None = None
    options: dict = field(default_factory=dict, compare=False, hash=False)

    @staticmethod
    def from_dict(d: dict) -> IngestionRule:
        """Accept both rule spellings of the reference: (source_type, source_table)
        and (source, object)."""
        return IngestionRule(
            source_type=d.get("source_type") or d.get("source"),
            source_table=d.get("source_table") or d.get("object"),
            target_table=d["target_table"],
            columns=tuple(d.get("columns") or ()),
            filter_condition=d.get("filter_condition") or None,
            options=dict(d.get("options") or {}),
        )


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns in order, each once."""
    seen: list[str] = []
    for c in columns:
        if c not in seen:
            seen.append(c)
    return df.select([F.col(f"`{c}`") for c in seen]) if seen else df


def apply_filter(df: DataFrame, condition: str | None) -> DataFrame:
    """Optional SQL predicate; empty or None keeps every row."""
    if condition is None or not str(condition).strip():
        return df
    return df.filter(F.expr(condition))


def apply_rule(df: DataFrame, rule: IngestionRule) -> DataFrame:
    """Filter then select. The reference selects first; Spark resolves a filter
    on a column the select dropped by adding it back, so the result is the same,
    and filtering first is the natural order for pushdown."""
    return select_columns(apply_filter(df, rule.filter_condition), rule.columns)


class RuleError(ValueError):
    """A rule that cannot run: unknown source kind, no columns, duplicate target."""


def validate_rules(rules: Sequence[IngestionRule], known_kinds: Sequence[str] | None = None) -> None:
    """Check every rule before any job starts (D1): source kind configured,
    columns given, each landing table written by one rule only."""
    targets: set[str] = set()
    for r in rules:
        if known_kinds is not None and r.source_type not in known_kinds:
            raise RuleError(f"rule for {r.source_table}: no connection configured for {r.source_type!r}")
        if not r.columns:
            raise RuleError(f"rule for {r.source_table}: no columns")
        if r.target_table in targets:
            raise RuleError(f"two rules write {r.target_table}")
        targets.add(r.target_table)


def run_rules(rules: Sequence[IngestionRule], reader: Callable[[IngestionRule], DataFrame],
              writer: Callable[[DataFrame, IngestionRule], object] | None = None,
              known_kinds: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Run every rule: read -> filter -> select -> (optional) write.

    All rules are validated first; each rule is then its own job and no data
    goes through the driver.
    """
    validate_rules(rules, known_kinds)
    out: dict[str, DataFrame] = {}
    for rule in rules:
        df = apply_rule(reader(rule), rule)
        if writer is not None:
            writer(df, rule)
        out[rule.target_table] = df
    return out
