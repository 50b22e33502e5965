"""Coalescing merge of a source into a target.

Semantics (the reference's outer merge followed by "new value wins unless it
is missing"):

* rows match on the key columns with **null-safe** equality (null keys match
  each other), key by key in the order given;
* every target row survives; a matched row takes each shared column from the
  source unless the source value is null, or ``''`` for string columns;
* source rows whose key is absent from the target are added; their blank
  strings in shared columns become null;
* columns only the target has pass through, columns only the source has are
  appended after the target's columns;
* a key delivered ``n`` times by the source and held ``m`` times by the target
  gives ``n * m`` rows (join semantics, J5); ``on_duplicate="error"`` refuses
  duplicate source keys instead;
* null keys match each other too (``null_keys="match"``); with many of them on
  both sides that fans out, and ``null_keys="append"`` lets them match nothing:
  null-key rows of both sides then pass by the join;
* column names are compared as Spark resolves them: without regard to case,
  unless ``spark.sql.caseSensitive`` is set. The target's spelling stays.

Plan shape. One full outer join on never-null key columns: two exchanges, the
target is read once, so a fold over many sources grows by the same amount for
each. With unique keys (the usual standard table) :func:`merge_all` needs no
join at all. A full outer join can't be split by AQE when one key is hot.
``hot_keys="auto"``, the default, looks for such keys (see :mod:`.hotkeys`) as
soon as the planner expects a side above the session's limit for a skewed
partition: one job over the key columns while the query is built. Without hot
keys the plan is the plain join; with them it still is one join, in which the
rows of those keys alone are dealt over a grid of cells. ``"plain"`` never
looks. ``hot_keys="split"`` looks for nothing either and computes the same rows
as the union of three joins AQE *can* split:

    target INNER JOIN source           matched rows      (either side split)
    target LEFT ANTI JOIN source keys  target-only rows  (target side split)
    source LEFT ANTI JOIN target keys  source-only rows  (source side split)

There the full-width shuffle of each side is shared by its inner join and its
anti join (Spark reuses the identical exchange), and the anti joins' other side
ships only its distinct keys, pre-aggregated map-side. As it reads the target
three times, a fold of this form writes every step to the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.columns import blank_to_null, overwrite_if_present
from .hotkeys import frequent_keys, grid, in_cells, joint, may_skew
from .keys import equal, probe_keys, with_join_keys


class DuplicateKeyError(ValueError):
    """Raised by ``on_duplicate="error"`` when the source repeats a key."""


def _typed(c: Column, src_type, tgt_type) -> Column:
    return c if src_type == tgt_type else c.cast(tgt_type)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (A5).

    A plain grouped count: partial aggregation runs before the shuffle, so a
    hot key costs one row per map task, not one row per occurrence.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def _check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if duplicate_keys(df, keys).limit(1).count() > 0:
        raise DuplicateKeyError(f"source repeats key {list(keys)}")


def _named_like(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the target's spelling of shared column names."""
    if target.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true":
        return source
    spelling = {c.lower(): c for c in target.columns}
    if all(spelling.get(c.lower(), c) == c for c in source.columns):
        return source
    return source.select([F.col(f"`{c}`").alias(spelling.get(c.lower(), c)) for c in source.columns])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]],
           *, on_duplicate: str = "fanout", unique_keys: bool = False, null_keys: str = "match",
           hot_keys: str = "auto", found: tuple[DataFrame | None, DataFrame | None] | None = None) -> DataFrame:
    """Merge ``source`` into ``target``; see the module docstring.

    ``keys`` holds target key names, or ``(target_key, source_key)`` pairs when
    the source spells its key differently; the output uses the target's name.
    ``unique_keys=True`` states that both sides hold each key at most once; the
    merge then runs as one aggregation (:func:`merge_all`), which checks that.
    ``on_duplicate="error"`` counts the source's keys right away (one job).
    ``found`` hands over hot keys of target and source that are known already.
    """
    if on_duplicate not in ("fanout", "error"):
        raise ValueError("on_duplicate must be 'fanout' or 'error'")
    if null_keys not in ("match", "append"):
        raise ValueError("null_keys must be 'match' or 'append'")
    if hot_keys not in ("auto", "plain", "split"):
        raise ValueError("hot_keys must be 'auto', 'plain' or 'split'")
    pairs = [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys]
    if not pairs:
        raise ValueError("upsert needs at least one key")
    if unique_keys and null_keys == "match":
        return merge_all(target, [(source, keys)])

    # Rename the source's key to the target's spelling; the joins below refer to
    # the two sides through DataFrame aliases, so a source derived from the
    # very table it is merged into resolves unambiguously.
    src_key_rename = {s: t for t, s in pairs if s != t}
    if src_key_rename:
        source = source.select([F.col(f"`{c}`").alias(src_key_rename.get(c, c)) for c in source.columns])
    source = _named_like(source, target)
    key_names = [t for t, _ in pairs]
    if on_duplicate == "error":
        _check_unique(source, key_names)
    if null_keys == "append":
        some = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in key_names])
        merged = upsert(target.filter(some), source.filter(some), key_names, unique_keys=unique_keys,
                        hot_keys=hot_keys, found=found)
        return (merged.unionByName(target.filter(~some), allowMissingColumns=True)
                .unionByName(_added(source.filter(~some), target, key_names)))

    ttypes = {f.name: f.dataType for f in target.schema.fields}
    stypes = {f.name: f.dataType for f in source.schema.fields}
    source_only = [c for c in source.columns if c not in ttypes]

    # Null-safe matching through never-null join columns (see .keys): plain
    # equality on (key IS NULL, coalesce(key, filler)) equals ``<=>`` on the key.
    ktypes = [ttypes[k] for k in key_names]
    tn, names = with_join_keys(target, key_names, ktypes)
    sn, _ = with_join_keys(source, key_names, ktypes)
    cells = None
    if hot_keys == "auto":
        if found is None and (may_skew(target) or may_skew(source)):
            found = _hot(tn, target, names), _hot(sn, source, names)
        cells = grid(*found, names) if found is not None else None
    if cells is not None:
        tn, sn = in_cells(tn, names, cells, True), in_cells(sn, names, cells, False)
    t, s = tn.alias("__t"), sn.alias("__s")

    def tcol(c: str) -> Column:
        return F.col(f"__t.`{c}`")

    def scol(c: str) -> Column:
        return F.col(f"__s.`{c}`")

    # The same columns serve matched, target-only and source-only rows: what a
    # side lacks is null there.
    cols = []
    for c in target.columns:
        if c in key_names:
            cols.append(F.coalesce(tcol(c), _typed(scol(c), stypes[c], ttypes[c])).alias(c))
        elif c in stypes:
            new = _typed(scol(c), stypes[c], ttypes[c])
            cols.append(overwrite_if_present(new, tcol(c), ttypes[c]).alias(c))
        else:
            cols.append(tcol(c).alias(c))
    cols += [scol(c).alias(c) for c in source_only]
    cond = equal([tcol(n) for n in names], [scol(n) for n in names])
    if cells is not None:
        # A row sent to several cells is unmatched in some; its key is hot, hence present, on the
        # other side, so it is matched in another and these are no rows of the result.
        cond = cond & equal([tcol("__line"), tcol("__col")], [scol("__line"), scol("__col")])
        spare = ((scol("__met").isNull() & F.coalesce(tcol("__met"), F.lit(False)))
                 | (tcol("__met").isNull() & F.coalesce(scol("__met"), F.lit(False))))
        return t.join(s, cond, "full_outer").filter(~spare).select(cols)
    if hot_keys != "split":
        return t.join(s, cond, "full_outer").select(cols)

    matched = t.join(s, cond, "inner").select(cols)
    # Anti joins probe the other side's distinct keys (see .keys): a hot key
    # on the probe side is split by AQE, one on the other side collapses.
    s_keys, s_key_cols = probe_keys(source, key_names, ktypes, "__sk")
    kept = tn.join(s_keys, equal(names, s_key_cols), "left_anti")
    kept = kept.select([F.col(f"`{c}`").alias(c) for c in target.columns]
                       + [F.lit(None).cast(stypes[c]).alias(c) for c in source_only])
    t_keys, t_key_cols = probe_keys(target, key_names, ktypes, "__tk")
    only = sn.join(t_keys, equal(names, t_key_cols), "left_anti")
    return matched.unionByName(kept).unionByName(_added(only, target, key_names, source.columns))


def _added(rows: DataFrame, target: DataFrame, keys: Sequence[str], own: Sequence[str] | None = None) -> DataFrame:
    """Source rows as new rows of the target: blank strings of shared columns become null."""
    own = list(own if own is not None else rows.columns)
    stypes = {f.name: f.dataType for f in rows.schema.fields}
    cols = []
    for f in target.schema.fields:
        if f.name not in own:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        v = _typed(F.col(f"`{f.name}`"), stypes[f.name], f.dataType)
        cols.append((blank_to_null(v) if f.name not in keys and isinstance(f.dataType, StringType) else v).alias(f.name))
    have = set(target.columns)
    return rows.select(cols + [F.col(f"`{c}`") for c in own if c not in have])


def fold(target: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]], *,
         stage_every: int | None = None, on_duplicate: str = "fanout", null_keys: str = "match",
         hot_keys: str = "auto") -> DataFrame:
    """Merge several sources in order, later wins.

    The plan grows by one join for each source. Every ``stage_every`` sources
    the intermediate result is checkpointed to the shared checkpoint folder,
    which cuts lineage and survives lost executors (a reliable checkpoint,
    never a local one): by default never, and at each step with
    ``hot_keys="split"``, whose joins read the target three times.

    With ``hot_keys="auto"`` each input is looked at once: a key survives every
    step, so what is hot in an earlier input is there in the merged table.
    Sources that merge on different keys give no such knowledge; their joins are plain.
    """
    if stage_every is None:
        stage_every = 1 if hot_keys == "split" else 0
    known = _hot_by_input(target, sources) if hot_keys == "auto" else None
    if hot_keys == "auto" and known is None:
        hot_keys = "plain"
    so_far = known[0] if known else None
    out = target
    for i, (src, keys) in enumerate(sources, start=1):
        found = (so_far, known[i]) if known else None
        out = upsert(out, src, keys, on_duplicate=on_duplicate, null_keys=null_keys, hot_keys=hot_keys, found=found)
        if known:
            so_far = joint(so_far, known[i], [f"__k{j}" for j in range(2 * len(keys))])
        if stage_every and i % stage_every == 0 and i < len(sources):
            out = out.checkpoint(eager=True)
    return out


def _hot_by_input(target: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> list | None:
    """Hot keys of the target and of each source; ``None`` if no input is large enough to have
    any that matter, or the sources merge on different keys."""
    named = [[(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys] for _, keys in sources]
    if len({tuple(t for t, _ in pairs) for pairs in named}) != 1:
        return None
    inputs = [(target, [t for t, _ in named[0]])] + [(s, [k for _, k in pairs]) for (s, _), pairs in zip(sources, named)]
    if not any(may_skew(df) for df, _ in inputs):
        return None
    types = [target.schema[t].dataType for t, _ in named[0]]
    out = []
    for df, keys in inputs:
        keyed, names = with_join_keys(df.select(*[F.col(f"`{k}`") for k in keys]), keys, types)
        out.append(_hot(keyed, df, names))
    return out


def _hot(keyed: DataFrame, side: DataFrame, names: Sequence[str]) -> DataFrame | None:
    """Hot keys of a side that is large enough for them to matter: a small one isn't worth
    dealing out, as that repeats the other side's rows."""
    return frequent_keys(keyed, names) if may_skew(side) else None


def first_run(contract: StructType, source: DataFrame, keys: Sequence[str], spark=None) -> DataFrame:
    """Load into an absent target: merge into an empty frame of the contract (S6 + J1)."""
    spark = spark or source.sparkSession
    empty = spark.createDataFrame([], contract)
    return upsert(empty, source, keys)


def key_pairs(mapping_rows: Sequence[dict]) -> list[tuple[str, str]]:
    """Ordered distinct (target_key, source_key) pairs of one source's mapping.

    The reference builds these from Python sets, so composite-key order is
    arbitrary there (D12); here first appearance in the spec decides.
    """
    seen: list[tuple[str, str]] = []
    for m in mapping_rows:
        p = (m["target_key"], m["source_key"])
        if p not in seen:
            seen.append(p)
    return seen



def merge_all(target: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The result of :func:`fold` in one aggregation, for inputs with unique keys.

    When every input holds each key at most once, "later non-blank value wins"
    needs no join: the target (order 0) and the sources (order 1, 2, ...) are
    stacked, grouped by key (null keys form one group, as ``<=>`` matches
    them), and every column keeps the valid value with the highest order
    (``max`` of ``struct(order, value)``, combined map-side). One shuffle in
    total, whatever the number of sources. A value is valid when it is not
    null and, for a string column the table already had before that source,
    not ``''`` (the upsert's rule). Column order and types follow
    :func:`fold`. The same aggregation counts each input's rows per key: a key
    that repeats makes the query fail instead of losing rows.
    """
    if not sources:
        return target
    keys = [k if isinstance(k, str) else k[0] for k in sources[0][1]]
    inputs = [target]
    for src, ks in sources:
        pairs = [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in ks]
        if [t for t, _ in pairs] != keys:
            raise ValueError("merge_all needs the same target keys for every source")
        rn = {s: t for t, s in pairs if s != t}
        src = src.select([F.col(f"`{c}`").alias(rn.get(c, c)) for c in src.columns]) if rn else src
        for earlier in inputs:
            src = _named_like(src, earlier)
        inputs.append(src)

    out_types: dict = {}
    introduced: dict[str, int] = {}
    for i, df in enumerate(inputs):
        for f in df.schema.fields:
            out_types.setdefault(f.name, f.dataType)
            introduced.setdefault(f.name, i)
    order = list(out_types)
    payload = [c for c in order if c not in keys]

    stacked = []
    for i, df in enumerate(inputs):
        own = {f.name: f.dataType for f in df.schema.fields}
        cols = [_typed(F.col(f"`{k}`"), own[k], out_types[k]).alias(k) for k in keys]
        for c in payload:
            t = out_types[c]
            if c in own:
                v = _typed(F.col(f"`{c}`"), own[c], t)
                valid = v.isNotNull()
                if isinstance(t, StringType) and introduced[c] < i:
                    valid = valid & (v != F.lit(""))
                cell = F.when(valid, F.struct(F.lit(i).alias("o"), v.alias("v")))
            else:
                cell = F.lit(None).cast(f"struct<o:int,v:{t.simpleString()}>")
            cols.append(cell.alias(c))
        stacked.append(df.select(*cols, F.lit(i).alias("__input")))
    union = reduce(lambda a, b: a.unionByName(b), stacked)
    rows = [F.sum(F.when(F.col("__input") == i, 1).otherwise(0)).alias(f"__n{i}") for i in range(len(inputs))]
    agg = union.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in payload], *rows)
    most = F.greatest(*[F.col(f"__n{i}") for i in range(len(inputs))])
    message = F.lit(f"unique_keys was stated, but a key of {keys} repeats in one input")
    agg = agg.filter(F.when(most > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    out = agg.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`.v").alias(c) for c in payload])
    return out.select(*[F.col(f"`{c}`") for c in order])
