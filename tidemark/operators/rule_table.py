"""Validation rules kept as a table, evaluated in one pass over rows and one over keys (Q4, Q5).

A rules table has the columns ``rule_id, column_name, check, argument`` and, if one table holds
the rules of many, ``table_name``. ``argument`` is JSON text:

    not_null     (none)
    in_set       ["A", "N"]
    range        {"min": 1, "max": 45}, either may be left out
    regex        "^[OF]$"
    unique       ["key", "columns"]; without it, the rule's own column
    referential  {"table": "orders", "column": "o_orderkey"}

All row checks are one projection. All set checks, whatever their columns, are one grouped pass:
each row gives one narrow record for each set of key columns, the parent tables' keys join
the same stack, and one aggregation (partial on the map side, so a hot key or value collapses
before the shuffle) counts children and parents. Only keys that break a rule are written, to
the shared folder; the rows then look them up there, by the planner's choice of join. A table
is scanned once without set rules and twice with them, however many rules there are.

A rule table is configuration: the driver reads its rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from ..session import shared_dir
from .keys import equal, with_join_keys
from .quality import ROW_CHECKS, SUMMARY_SCHEMA, Rule, check_rules, failing

FAILED = "failed_rule_ids"


class RuleError(ValueError):
    """A rule that can't be applied; the message names it."""


def _argument(rule_id: str, check: str, text: str | None):
    """The argument of :class:`..quality.Rule` for one row of the rules table."""
    try:
        value = None if text is None or not text.strip() else json.loads(text)
    except json.JSONDecodeError as e:
        raise RuleError(f"rule {rule_id}: argument is not JSON: {text!r}") from e
    if check == "not_null":
        return None
    if check == "in_set" and isinstance(value, list):
        return tuple(v for v in value if v is not None)  # a null value never breaks a set
    if check == "range" and isinstance(value, dict) and value and set(value) <= {"min", "max"}:
        return value.get("min"), value.get("max")
    if check == "regex" and isinstance(value, str):
        return value
    if check == "unique" and (value is None or isinstance(value, list) and value and all(isinstance(v, str) for v in value)):
        return None if value is None else tuple(value)
    if check == "referential" and isinstance(value, dict) and set(value) == {"table", "column"}:
        return value["table"], value["column"]
    raise RuleError(f"rule {rule_id}: {text!r} is no argument of {check!r}")


def load_rules(table: DataFrame, table_name: str | None = None) -> list[Rule]:
    """The rules of the table (of ``table_name``, if given), by rule id. Rows without a rule id or a
    column, unknown checks, wrong arguments and repeated ids are refused; no rows give no rules."""
    if table_name is not None:
        table = table.filter(F.col("table_name") == table_name)
    rules = []
    for r in table.select("rule_id", "column_name", F.lower(F.trim("check")).alias("check"), "argument").collect():
        if r["rule_id"] is None or not r["rule_id"].strip() or "," in r["rule_id"]:
            raise RuleError(f"rule id {r['rule_id']!r}: it must be a name without a comma")
        if r["check"] is None or r["column_name"] is None:
            raise RuleError(f"rule {r['rule_id']}: no check or no column")
        rules.append(Rule(r["rule_id"], r["column_name"], r["check"], _argument(r["rule_id"], r["check"], r["argument"])))
    check_rules(rules)
    return sorted(rules, key=lambda r: r.rule_id)


def _keys_of(rule: Rule) -> tuple[str, ...]:
    return tuple(rule.argument) if rule.check == "unique" and rule.argument else (rule.column,)


@dataclass
class CompiledRules:
    """Rules resolved against the columns of one table."""

    rules: list[Rule]
    key_sets: list[tuple[str, ...]]  # distinct sets of key columns, in their table's spelling
    slots: list[str]  # all key columns; column i of the stack holds slot i

    @property
    def row_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.check in ROW_CHECKS]

    def set_rules(self, keys: tuple[str, ...]) -> list[tuple[int, Rule]]:
        return [(i, r) for i, r in enumerate(self.rules) if r.check not in ROW_CHECKS and _keys_of(r) == keys]


def compile_rules(schema: StructType, rules: Sequence[Rule], refs: dict[str, DataFrame] | None = None) -> CompiledRules:
    """Resolve columns (case apart) and parent tables; a rule that can't be applied is refused."""
    check_rules(rules)
    names = {f.name.lower(): f.name for f in schema.fields}
    refs = refs or {}

    def own(rule: Rule, column: str) -> str:
        if column.lower() not in names:
            raise RuleError(f"rule {rule.rule_id}: no column {column!r}")
        return names[column.lower()]

    out = []
    for r in rules:
        argument = r.argument
        if r.check == "unique":
            given = [argument] if isinstance(argument, str) else argument or [r.column]
            argument = tuple(sorted({own(r, c) for c in given}))
        elif r.check == "referential":
            parent, column = argument
            if parent not in refs or column.lower() not in [c.lower() for c in refs[parent].columns]:
                raise RuleError(f"rule {r.rule_id}: no parent {parent}.{column}")
        out.append(Rule(r.rule_id, own(r, r.column), r.check, argument))
    key_sets = sorted({_keys_of(r) for r in out if r.check not in ROW_CHECKS})
    return CompiledRules(out, key_sets, sorted({k for ks in key_sets for k in ks}))


def _child(rule_no: int) -> str:
    return f"fail{rule_no}"


def _stack(df: DataFrame, rules: CompiledRules, refs: dict[str, DataFrame]) -> DataFrame:
    """set_no, k0.. , n (1 for a row of ``df``, 0 for a parent), parent (the rule a parent key is for)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [f"k{i}" for i in range(len(rules.slots))]

    def record(set_no: int, values: dict[str, Column], n: int, parent: int) -> Column:
        cells = [values.get(s, F.lit(None)).cast(types[s]).alias(k) for s, k in zip(rules.slots, names)]
        return F.struct(F.lit(set_no).alias("set_no"), *cells, F.lit(n).cast(LongType()).alias("n"), F.lit(parent).alias("parent"))

    records = [record(no, {c: F.col(f"`{c}`") for c in ks}, 1, -1) for no, ks in enumerate(rules.key_sets)]
    frames = [df.select(F.inline(F.array(*records)))]
    for no, ks in enumerate(rules.key_sets):
        for i, r in rules.set_rules(ks):
            if r.check != "referential":
                continue
            parent, column = r.argument
            key = F.col(f"`{column}`")
            as_child = key.try_cast(types[r.column])
            # a parent key that the child's type can't hold matches no child
            frames.append(refs[parent].filter(as_child.isNotNull() & (as_child == key))
                          .select(F.inline(F.array(record(no, {r.column: as_child}, 0, i)))))
    return reduce(DataFrame.unionAll, frames)


def failing_keys(df: DataFrame, rules: CompiledRules, refs: dict[str, DataFrame]) -> DataFrame:
    """The keys that break a set rule: ``set_no, k0..`` and a flag for each set rule.

    ``unique``: keys of more than one row; null keys count as equal. ``referential``: values
    that the parent lacks; a null value breaks nothing.
    """
    names = [f"k{i}" for i in range(len(rules.slots))]
    flags, parents = [], []
    for no, ks in enumerate(rules.key_sets):
        here = F.col("set_no") == no
        for i, r in rules.set_rules(ks):
            if r.check == "unique":
                bad = F.col("n") > 1
            else:
                parents.append(F.max(F.col("parent") == i).alias(f"parent{i}"))
                bad = (F.col("n") > 0) & ~F.col(f"parent{i}") & F.col(names[rules.slots.index(r.column)]).isNotNull()
            flags.append((here & bad).alias(_child(i)))
    counted = _stack(df, rules, refs).groupBy("set_no", *names).agg(F.sum("n").alias("n"), *parents)
    flagged = counted.select("set_no", *names, *flags)
    return flagged.filter(reduce(lambda a, b: a | b, [F.col(n) for n in flagged.columns if n.startswith("fail")]))


def flag_rows(df: DataFrame, rules: Sequence[Rule], refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` with ``failed_rule_ids``, an array of the rules each row breaks, in rule order.

    Set rules run one job here, which writes their failing keys. An own column of that name is
    refused. No rules give empty arrays.
    """
    refs = refs or {}
    if FAILED in [c.lower() for c in df.columns]:
        raise RuleError(f"the table has a column {FAILED}")
    compiled = compile_rules(df.schema, rules, refs)
    original = [F.col(f"`{c}`") for c in df.columns]
    broken = {i: failing(r) for i, r in enumerate(compiled.rules) if r.check in ROW_CHECKS}
    out = df
    if compiled.key_sets:
        path = shared_dir(df.sparkSession, "failing-keys")
        bad = failing_keys(df, compiled, refs)
        bad.write.parquet(path)
        stored = df.sparkSession.read.schema(bad.schema).parquet(path)
        flags: list[str] = []
        for no, ks in enumerate(compiled.key_sets):
            own = [i for i, _ in compiled.set_rules(ks)]
            key_names = [f"__key{j}" for j in range(len(ks))]
            mine = stored.filter((F.col("set_no") == no) & reduce(lambda a, b: a | b, [F.col(_child(i)) for i in own])).select(
                *[F.col(f"k{compiled.slots.index(k)}").alias(a) for k, a in zip(ks, key_names)],
                *[F.col(_child(i)).alias(f"__fail{i}") for i in own])
            types = [df.schema[k].dataType for k in ks]
            left, left_names = with_join_keys(out, list(ks), types, f"__l{no}_")
            right, right_names = with_join_keys(mine, key_names, types, f"__r{no}_")
            out = left.join(right, equal(left_names, right_names), "left").select(
                *original, *flags, *[F.coalesce(f"__fail{i}", F.lit(False)).alias(f"__fail{i}") for i in own])
            flags += [f"__fail{i}" for i in own]
            broken |= {i: F.col(f"__fail{i}") for i in own}
    ids = [F.when(broken[i], F.lit(r.rule_id)) for i, r in enumerate(compiled.rules)]
    failed = F.array_compact(F.array(*ids)) if ids else F.array()
    return out.select(*original, failed.cast(ArrayType(StringType())).alias(FAILED))


def summarize(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failed rows of each rule, from flagged rows (Q4): one global aggregation that reads the flags
    only. A rule that nothing breaks gives zero, an empty table zeros, no rules no rows."""
    if not rules:
        return flagged.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    counts = [F.count(F.when(F.array_contains(FAILED, r.rule_id), 1)).alias(f"f{i}") for i, r in enumerate(rules)]
    rows = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.check).alias("rule_check"),
                              F.lit(r.column).alias("column_name"), F.col(f"f{i}").alias("n_failed"))
                     for i, r in enumerate(rules)])
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"), *counts).select(F.inline(rows), "n_rows")


def rejected(flagged: DataFrame) -> DataFrame:
    """The rows that break a rule, with ``failed_rules`` as one string (Q4)."""
    return (flagged.filter(F.size(FAILED) > 0)
            .withColumn("failed_rules", F.concat_ws(",", FAILED)).drop(FAILED))


@dataclass
class Checked:
    """One evaluation of the rules, written once: what it read is not read again."""

    flagged: DataFrame
    rules: list[Rule]

    @property
    def silver(self) -> DataFrame:
        return self.flagged.filter(F.size(FAILED) == 0).drop(FAILED)

    @property
    def quarantine(self) -> DataFrame:
        return rejected(self.flagged)

    @property
    def summary(self) -> DataFrame:
        return summarize(self.flagged, self.rules)


def check_table(df: DataFrame, rule_table: DataFrame, refs: dict[str, DataFrame] | None = None,
                table_name: str | None = None, required: bool = True) -> Checked:
    """Evaluate a rules table over ``df`` and stage the flagged rows in the shared folder.

    Silver rows, quarantine and summary all come from the staged rows. ``required=False`` evaluates
    nothing: all rows are silver (Q5).
    """
    rules = load_rules(rule_table, table_name) if required else []
    flagged = flag_rows(df, rules, refs)
    path = shared_dir(df.sparkSession, "flagged")
    flagged.write.parquet(path)
    return Checked(df.sparkSession.read.schema(flagged.schema).parquet(path), rules)
