"""Slowly changing dimension, type 2.

Dimension rows carry ``start_date``, ``end_date`` (null while open) and
``is_current``. Applying a source as of a date:

* current row whose tracked attributes changed -> closed: ``end_date = as_of``,
  ``is_current = false`` (H1);
* new key, or changed key -> new open version starting ``as_of`` (H2);
* everything else is untouched.

Change tests are null-safe (a null turning into a value is a change, D15).
Keys match with plain equality as in the reference SQL, so null keys never
match: a null-key source row is always new, a null-key dimension row is never
closed. Those rows are routed around the join, which also keeps a hot null
key from landing in one task. With ``null_keys="once"`` a null-key source row is
new only if no open null-key row has the same values, so that applying the same
source again changes nothing (H5); ``"refuse"`` fails on such a source row.

A source may repeat a row; rows of one key that differ in what the dimension
takes from them are refused, because only one of them can become the current
version. So is a dimension with two current rows for one key.

Plan shape: closed history rows and null-key rows never enter a shuffle.
Current rows and source rows are stacked and grouped by key; partial
aggregation collapses a hot key before the one shuffle, and there is no join.
The apply is a pure ``DataFrame -> DataFrame``. :func:`scd2_store` keeps the dimension
as a snapshot table of open and closed parts: an apply reads and rewrites the open
rows only, the rows it closes become one more closed part, and both are one commit.

Late deliveries (I7) need more than the open row: :func:`scd2_insert` places each
delivery at its own date, between the versions before and after it. There every
delivered state is a version of its own, also one that repeats the state before it, since
a late delivery may still come between the two; :func:`merged_versions` shows runs of
equal states as one. So the history depends on what was delivered, not on the order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StructField, StructType

from ..functions.columns import any_changed
from ..sinks.snapshots import Commit, SnapshotTable

START, END, CURRENT = "start_date", "end_date", "is_current"


def _date(as_of: str | dt.date | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast(DateType())
    return F.lit(str(as_of)).cast(DateType())


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _new_version(src_cols: Sequence[str], dim_cols: Sequence[str], dim_types: dict, as_of: Column) -> list[Column]:
    out = []
    for c in dim_cols:
        if c == START:
            out.append(as_of.alias(START))
        elif c == END:
            out.append(F.lit(None).cast(DateType()).alias(END))
        elif c == CURRENT:
            out.append(F.lit(True).alias(CURRENT))
        elif c in src_cols:
            out.append(_c(c).cast(dim_types[c]).alias(c))
        else:
            out.append(F.lit(None).cast(dim_types[c]).alias(c))
    return out


def _nullable(fields) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in fields])


def _null_key_rows(src: DataFrame, open_: DataFrame, nonnull: Column, null_keys: str) -> DataFrame:
    """The source rows without a key that become new versions; ``open_``: the open rows without one."""
    if null_keys == "append":
        return src.filter(~nonnull)
    if null_keys == "refuse":
        bad = F.raise_error(F.lit("source rows without a key")).cast("boolean")
        return src.filter(F.when(~nonnull, bad).otherwise(F.lit(False)))
    if null_keys != "once":
        raise ValueError("null_keys must be 'append', 'once' or 'refuse'")
    shared = [c for c in src.columns if c in open_.columns]
    rows = src.filter(~nonnull).select([_c(c).cast(open_.schema[c].dataType).alias(c) for c in shared]).distinct()
    # hash first: plain equality deals the rows, the null-safe comparison decides
    have = open_.select(F.xxhash64(*[_c(c) for c in shared]).alias("__h"), F.struct(*[_c(c) for c in shared]).alias("__row"))
    mine = F.struct(*[_c(c) for c in shared])
    return rows.join(have, (F.xxhash64(*[_c(c) for c in shared]) == F.col("__h")) & mine.eqNullSafe(F.col("__row")), "left_anti")


def _versions(dim: DataFrame, src: DataFrame, keys: Sequence[str], tracked: Sequence[str], d: Column, null_keys: str = "append"):
    """(history rows, null-key current rows, one row per key with __old and __new, its
    change test, null-key source rows as new versions)."""
    dim_cols = dim.columns
    dim_types = {f.name: f.dataType for f in dim.schema.fields}
    cur = dim.filter(_c(CURRENT))
    hist = dim.filter(~_c(CURRENT) | _c(CURRENT).isNull())
    nonnull = reduce(lambda a, b: a & b, [_c(k).isNotNull() for k in keys])
    # both versions in one nullable type: a NOT NULL dimension column can be null
    # in neither, but the side that is missing is
    vtype = _nullable(dim.schema.fields)
    old = F.struct(*[_c(c).alias(c) for c in dim_cols]).cast(vtype)
    new = F.struct(*_new_version(src.columns, dim_cols, dim_types, d)).cast(vtype)
    none = F.lit(None).cast(vtype)
    cur_part = cur.filter(nonnull).select(*[_c(k) for k in keys], old.alias("__old"), none.alias("__new"))
    src_part = src.filter(nonnull).select(*[_c(k).cast(dim_types[k]).alias(k) for k in keys],
                                          none.alias("__old"), new.alias("__new"))
    g = (cur_part.unionByName(src_part).groupBy(*[_c(k) for k in keys])
         .agg(F.count("__old").alias("__n_old"), F.max("__old").alias("__old"),
              F.min("__new").alias("__new_min"), F.max("__new").alias("__new")))
    bad = (F.when(F.col("__n_old") > 1, F.lit(f"two current rows for one key of {list(keys)}"))
            .when(F.col("__new_min") != F.col("__new"), F.lit(f"source rows of one key of {list(keys)} differ")))
    g = g.filter(F.when(bad.isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(F.lit(True)))
    chg = any_changed([(F.col("__old")[a], F.col("__new")[a]) for a in tracked])
    unkeyed = _null_key_rows(src, cur.filter(~nonnull), nonnull, null_keys)
    null_new = unkeyed.select(_new_version(unkeyed.columns, dim_cols, dim_types, d))
    return hist.select(dim_cols), cur.filter(~nonnull).select(dim_cols), g, chg, null_new, vtype


def _closed(o: Column, dim_cols: Sequence[str], d: Column, vtype) -> Column:
    return F.struct(*[(d.alias(END) if c == END else F.lit(False).alias(CURRENT) if c == CURRENT
                       else o[c].alias(c)) for c in dim_cols]).cast(vtype)


def scd2_apply(dim: DataFrame, src: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               as_of: str | dt.date | Column | None = None, null_keys: str = "append") -> DataFrame:
    """Full SCD2 apply (H3, H4): the new dimension snapshot."""
    d = _date(as_of)
    hist, nullkey, g, chg, null_new, vtype = _versions(dim, src, keys, tracked, d, null_keys)
    o, n = F.col("__old"), F.col("__new")
    versions = (F.when(o.isNull(), F.array(n)).when(n.isNull(), F.array(o))
                 .when(chg, F.array(_closed(o, dim.columns, d, vtype), n)).otherwise(F.array(o)))
    merged = g.select(F.inline(versions)).select(dim.columns)
    return reduce(lambda a, b: a.unionByName(b), [hist, nullkey, merged, null_new])


def scd2_expire(dim: DataFrame, src: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                as_of: str | dt.date | Column | None = None) -> DataFrame:
    """Step 1 only (H1, J7): the dimension with changed current rows closed."""
    d = _date(as_of)
    hist, nullkey, g, chg, _, vtype = _versions(dim, src, keys, tracked, d)
    o, n = F.col("__old"), F.col("__new")
    kept = g.filter(o.isNotNull()).select(F.inline(F.array(
        F.when(n.isNotNull() & chg, _closed(o, dim.columns, d, vtype)).otherwise(o))))
    return reduce(lambda a, b: a.unionByName(b), [hist, nullkey, kept.select(dim.columns)])


def scd2_new_rows(dim: DataFrame, src: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                  as_of: str | dt.date | Column | None = None, null_keys: str = "append") -> DataFrame:
    """Step 2 only (H2, J6): versions to insert for new or changed keys.

    Evaluated against the pre-expire snapshot, so "changed" is tested directly.
    """
    d = _date(as_of)
    _, _, g, chg, null_new, _ = _versions(dim, src, keys, tracked, d, null_keys)
    o, n = F.col("__old"), F.col("__new")
    fresh = g.filter(n.isNotNull() & (o.isNull() | chg)).select(F.inline(F.array(n))).select(dim.columns)
    return fresh.unionByName(null_new)


def scd2_store(table: SnapshotTable, src: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               as_of: str | dt.date | Column | None = None, null_keys: str = "once") -> Commit:
    """Apply a source to a stored dimension (H3): open rows are rewritten, closed ones appended.

    The first apply opens every source row (once, if it is repeated). What is written grows with
    the open rows and the rows just closed, not with the history.
    """
    if table.exists():
        new = scd2_apply(table.read(kind="open"), src, keys, tracked, as_of, null_keys)
    else:
        new = scd2_apply(initial_load(src, as_of).limit(0), src, keys, tracked, as_of, null_keys)
    part = F.when(_c(CURRENT), F.lit("open")).otherwise(F.lit("closed"))
    return table.restate(new.withColumn("__part", part), "__part", ["open"])


def scd2_insert(dim: DataFrame, src: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """The history with deliveries placed at their own dates (H3 with I7).

    ``src`` holds the keys, the dimension's other columns and ``date_col``, from which day on a
    state holds. A delivery between two versions ends at the later one's start and ends
    the earlier one; one before all others goes in front; the latest version stays
    open. Only the keys that are delivered are worked on; a key's versions are sorted together.
    A state delivered again for the same day changes nothing, a different one for the same day
    is refused, and so is a delivery without a date. Rows without a key are no one's history and
    are refused as well.
    """
    values = [c for c in dim.columns if c not in (START, END, CURRENT)]
    types = {f.name: f.dataType for f in dim.schema.fields}
    lacking = reduce(lambda a, b: a | b, [_c(c).isNull() for c in [*keys, date_col]])
    refused = F.when(lacking, F.raise_error(F.lit("a delivery without key or date")).cast("boolean")).otherwise(F.lit(True))
    new = src.filter(refused).select(*[(_c(c) if c in src.columns else F.lit(None)).cast(types[c]).alias(c) for c in values],
                                     _c(date_col).cast(DateType()).alias(START))
    delivered = new.select(*[_c(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [_c(k) == _c(f"__{k}") for k in keys])
    touched = dim.join(delivered, same, "left_semi").select(*values, START)
    rest = dim.join(delivered, same, "left_anti")
    by = [*[_c(k) for k in keys], _c(START)]
    state = F.struct(*[_c(c) for c in values])
    days = touched.unionByName(new).groupBy(*by).agg(F.min(state).alias("__least"), F.max(state).alias("__most"))
    clash = F.raise_error(F.lit(f"different states of one key of {list(keys)} for one day")).cast("boolean")
    days = days.filter(F.when(F.col("__least").eqNullSafe(F.col("__most")), F.lit(True)).otherwise(clash))
    later = F.lead(START).over(Window.partitionBy(*[_c(k) for k in keys]).orderBy(START))
    days = days.withColumn(END, later).select("__most.*", START, END, F.col(END).isNull().alias(CURRENT))
    return rest.unionByName(days.select(dim.columns))


def merged_versions(dim: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Versions of a key that follow each other without a change, as one: with the first one's
    values and start and the last one's end."""
    in_order = Window.partitionBy(*[_c(k) for k in keys]).orderBy(START)
    state = F.struct(*[_c(c) for c in tracked])
    joins = F.lag(F.struct(state.alias("s"), _c(END).alias("e"))).over(in_order)
    fresh = F.when(joins.isNotNull() & joins["s"].eqNullSafe(state) & (joins["e"] == _c(START)), 0).otherwise(1)
    runs = dim.withColumn("__fresh", fresh).withColumn("__run", F.sum("__fresh").over(in_order))
    rest = [c for c in dim.columns if c not in (*keys, START, END, CURRENT)]
    last = F.max_by(F.struct(_c(END), _c(CURRENT)), _c(START))
    out = runs.groupBy(*[_c(k) for k in keys], F.col("__run")).agg(
        F.min_by(F.struct(*[_c(c) for c in rest]), _c(START)).alias("__first"), F.min(START).alias(START), last.alias("__last"))
    return out.select(*[_c(k) for k in keys], "__first.*", START, f"__last.{END}", f"__last.{CURRENT}").select(dim.columns)


def current_view(dim: DataFrame) -> DataFrame:
    """Open versions only (H6)."""
    return dim.filter(_c(CURRENT))


def as_of_view(dim: DataFrame, day: str | dt.date | Column) -> DataFrame:
    """Versions valid on ``day``: ``start <= day < end`` (open end = forever) (H6)."""
    d = _date(day)
    return dim.filter((_c(START) <= d) & (_c(END).isNull() | (d < _c(END))))


def initial_load(src: DataFrame, as_of: str | dt.date | Column | None = None) -> DataFrame:
    """First snapshot: every source row open from ``as_of``."""
    return src.withColumns({START: _date(as_of), END: F.lit(None).cast(DateType()),
                            CURRENT: F.lit(True).cast(BooleanType())})


def current_rows_per_key(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one open version (should be empty; property check)."""
    return (dim.filter(_c(CURRENT)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_current"))
            .filter(F.col("n_current") > 1))
