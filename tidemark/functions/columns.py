"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
none of them is a Python UDF.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

# Python's str.strip() removes any Unicode whitespace; Java's \s is ASCII-only
# unless the UNICODE_CHARACTER_CLASS flag (?U) is on.
_STRIP_PATTERN = r"(?U)^\s+|\s+$"


def strip_blanks(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(c, _STRIP_PATTERN, "")


def blank_to_null(c: Column) -> Column:
    """Exactly the empty string becomes null."""
    return F.when(c == F.lit(""), F.lit(None).cast(StringType())).otherwise(c)


def nan_to_null(c: Column, dtype: DataType) -> Column:
    """NaN becomes null on float/double; other types pass unchanged."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.when(F.isnan(c), F.lit(None).cast(dtype)).otherwise(c)
    return c


def overwrite_if_present(new: Column, old: Column, dtype: DataType) -> Column:
    """Incoming value wins unless it is null (or blank, for strings)."""
    if isinstance(dtype, StringType):
        return F.coalesce(blank_to_null(new), old)
    return F.coalesce(new, old)


def changed(a: Column, b: Column) -> Column:
    """Null-safe inequality: null -> value and value -> null count as changes."""
    return ~a.eqNullSafe(b)


def any_changed(pairs: list[tuple[Column, Column]]) -> Column:
    """OR of null-safe inequalities over several tracked attributes (H4)."""
    return reduce(lambda x, y: x | y, [changed(a, b) for a, b in pairs])


def entity_id(type_value: Column, key: Column) -> Column:
    """``<first letter of type, upper case>_<key>`` (F2-F4); null key gives null."""
    return F.concat(F.upper(F.substring(type_value, 1, 1)), F.lit("_"), key.cast("string"))


def strip_extension(name: Column) -> Column:
    """Source name to table name: drop a trailing ``.csv`` or ``.xlsx``."""
    return F.regexp_replace(name, r"\.(csv|xlsx)$", "")


def split_entity(target: Column) -> tuple[Column, Column]:
    """``policy.PolicyId`` -> (``policy``, ``PolicyId``); no dot -> (null, name)."""
    has_dot = F.instr(target, ".") > 0
    entity = F.when(has_dot, F.substring_index(target, ".", 1))
    column = F.when(has_dot, F.regexp_extract(target, r"^[^.]*\.(.*)$", 1)).otherwise(target)
    return entity, column


def date_from_file_name(name: Column) -> Column:
    """Business date embedded as ``_yyyyMMdd`` in a file name."""
    return F.to_date(F.regexp_extract(name, r"(\d{8})", 1), "yyyyMMdd")


def dated_folder(root: Column, d: Column) -> Column:
    """``root/yyyy/MM/dd/`` for a business date."""
    root_slash = F.when(root.endswith("/"), root).otherwise(F.concat(root, F.lit("/")))
    return F.concat(root_slash, F.date_format(d, "yyyy/MM/dd"), F.lit("/"))


def glob_to_regex(pattern: str) -> str:
    """Translate a file glob (``*``, ``?``) into an anchored regular expression."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def glob_match(name: Column, pattern: Column) -> Column:
    """Per-row glob match where the pattern is itself a column (config-driven)."""
    escaped = F.regexp_replace(pattern, r"([.+()\[\]{}^$|\\])", r"\\$1")
    rx = F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(escaped, r"\*", ".*"), r"\?", "."), F.lit("$"))
    return F.regexp_like(name, rx)


def yn_to_bool(c: Column) -> Column:
    """``Y``/``N`` (any case, blanks trimmed) and ``true``/``false`` to boolean."""
    v = F.upper(F.trim(c.cast("string")))
    return (F.when(v.isin("Y", "YES", "TRUE", "1"), F.lit(True))
             .when(v.isin("N", "NO", "FALSE", "0"), F.lit(False)))
