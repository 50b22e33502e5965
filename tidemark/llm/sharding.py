"""Sharding by histogram sort, in DataFrame functions only.

Rows have a key of several non-negative longs, compared one after the other. A splitter is a
key, and the bytes below it are counted exactly: every round lays equally spaced probes into
the key intervals that still hold an unsettled target, counts bytes and rows between them
over all partitions, and narrows each interval to the gap its target falls into. A gap
whose rows agree in one part of the key goes on with the next part, so a key that a third
of all rows share is split as well. A target is settled when a probe is within the
tolerance, or when its gap is one row, whose nearer side is taken. Then the rows are
exchanged once, by the splitters, and sorted inside each piece; the counts below the
splitters are known, so every row's place in its shard follows without another pass.

A shard is cut into pieces of about ``piece_rows`` rows, all by the same splitters, so
no task sorts a whole shard. The driver gets at most ``PROBES`` counts a round.

Law `bytes`: a shard's bytes differ from total/shards by the tolerance and the rows that lie
across its two ends at most. The key is a hash of (doc_id, text), so the shards are random
samples, and last the row's number in the staged table, which tells repeated rows apart;
these are interchangeable, so the result doesn't depend on that number.

Defined cases: a null text has no bytes (size 16) and the checksum of the empty text; a
null doc_id is an id of its own; repeated rows stay repeated and get a slot each; with fewer
rows than shards some shards are empty; the empty table gives no rows; other
columns are ignored by `shard_documents` and kept by `write_shards`.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, staged

PROBES = 16_384
WIDTH = 62  # bits of a part of the key


@dataclass
class Interval:
    """Keys that begin with ``prefix`` and whose next part is from ``low`` to ``high``."""
    prefix: tuple[int, ...]
    low: int
    high: int
    below_bytes: int
    below_rows: int
    targets: list[int]


@dataclass
class Splitters:
    """Keys in order, with the exact bytes and rows below each of them."""
    keys: list[tuple[int, ...]]
    below_bytes: list[int]
    below_rows: list[int]
    rounds: int


def _at_least(parts: list[str], key: tuple[int, ...]) -> str:
    """SQL: the row's key is at or after ``key`` (missing parts count as 0)."""
    name, value = parts[0], key[0]
    if len(key) == 1:
        return f"{name} >= {value}L"
    return f"({name} > {value}L or ({name} = {value}L and {_at_least(parts[1:], key[1:])}))"


def locate(parts: list[str], keys: list[tuple[int, ...]]) -> Column:
    """How many of the ordered ``keys`` are at or before the row's key: a binary search as
    a tree of conditions."""
    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"if({_at_least(parts, keys[middle])}, {tree(middle + 1, high)}, {tree(low, middle)})"

    return F.expr(tree(0, len(keys))).cast("int")


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.lit(values).cast("array<bigint>"), at + 1)


def _count(rows: DataFrame, parts: list[str], size: str, open_: list[Interval], bits: int) -> dict[int, list[tuple]]:
    """(first value, last value, bytes, rows) of the gaps between probes that hold rows, in
    order, for each interval: one pass with partial sums."""
    edges = [k for i in open_ for k in ((*i.prefix, i.low), (*i.prefix, i.high + 1))]
    spot = locate(parts, edges)
    inside = rows.select(*parts, size, spot.alias("spot")).where("spot % 2 = 1").withColumn("i", F.expr("spot div 2").cast("int"))
    value = F.element_at(F.array(*parts), _pick([len(i.prefix) for i in open_], F.col("i")).cast("int") + 1)
    shift = _pick([max(0, (i.high - i.low).bit_length() - bits) for i in open_], F.col("i")).cast("int")
    inside = inside.withColumn("value", value)
    gap = F.call_function("shiftrightunsigned", F.col("value") - _pick([i.low for i in open_], F.col("i")), shift)
    found = inside.groupBy("i", gap.alias("gap")).agg(
        F.min("value").alias("first"), F.max("value").alias("last"), F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    out: dict[int, list[tuple]] = {}
    for r in found.collect():  # PROBES rows at most
        out.setdefault(r["i"], []).append((r["first"], r["last"], r["bytes"], r["rows"]))
    return {i: sorted(g) for i, g in out.items()}


def find_splitters(rows: DataFrame, parts: list[str], size: str, pieces: int, tolerance: float = 0.001) -> Splitters:
    """``pieces`` - 1 keys that cut the rows into pieces of nearly equal sums of ``size``.

    ``rows`` should be a written table: it is read once a round. The tolerance is a share
    of a piece, below one half. Keys (all ``parts`` together) must be unique.
    """
    if not 0 <= tolerance < 0.5:
        raise ValueError("the tolerance is a share of a piece, below one half")
    got = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    total, near = int(got["bytes"]), tolerance * int(got["bytes"]) / pieces
    targets = [i * total // pieces for i in range(1, pieces)]
    settled: dict[int, tuple] = {}
    open_ = [Interval((), 0, (1 << WIDTH) - 1, 0, 0, list(range(len(targets))))] if total and targets else []
    rounds = 0
    while open_:
        rounds += 1
        bits = max(1, (PROBES // len(open_)).bit_length() - 1)
        counted = _count(rows, parts, size, open_, bits)
        narrower: dict[tuple, Interval] = {}
        for i, interval in enumerate(open_):
            gaps = counted[i]
            starts, heads, at_bytes, at_rows = [], [], interval.below_bytes, interval.below_rows
            for first, last, size_, n in gaps:
                starts.append(at_bytes)
                heads.append(at_rows)
                at_bytes, at_rows = at_bytes + size_, at_rows + n
            for t in interval.targets:
                g = bisect_right(starts, targets[t]) - 1
                first, last, size_, n = gaps[g]
                before, after = targets[t] - starts[g], starts[g] + size_ - targets[t]
                if min(before, after) <= near or n == 1:
                    settled[t] = (((*interval.prefix, first), starts[g], heads[g]) if before <= after
                                  else ((*interval.prefix, last + 1), starts[g] + size_, heads[g] + n))
                    continue
                # rows that agree in this part of the key: on to the next one
                inner = ((*interval.prefix, first), 0, (1 << WIDTH) - 1) if first == last else (interval.prefix, first, last)
                if len(inner[0]) == len(parts):
                    raise ValueError("the parts of the key don't tell all rows apart")
                narrower.setdefault(inner, Interval(*inner, starts[g], heads[g], [])).targets.append(t)
        open_ = [narrower[k] for k in sorted(narrower, key=lambda k: (*k[0], k[1]))]
    found = [settled.get(t, ((0,), 0, 0)) for t in range(len(targets))]
    return Splitters([k for k, _, _ in found], [b for _, b, _ in found], [r for _, _, r in found], rounds)


def place(rows: DataFrame, parts: list[str], size: str, shards: int, tolerance: float = 0.001,
          piece_rows: int = 1_000_000) -> DataFrame:
    """The rows with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard, in key
    order). ``rows`` should be a written table with unique keys."""
    each = max(1, -(-rows.count() // (shards * piece_rows)))
    cut = find_splitters(rows, parts, size, shards * each, tolerance)
    piece, = free_names(rows, "piece")
    below = [0, *cut.below_rows]
    within = Window.partitionBy(piece).orderBy(*parts)
    # a piece's rows before it in its shard
    ahead = [b - below[p // each * each] for p, b in enumerate(below)]
    return rows.withColumn(piece, locate(parts, cut.keys)).withColumn(
        "slot", _pick(ahead, F.col(piece)) + F.row_number().over(within) - 1).withColumn(
        "shard", F.expr(f"{piece} div {each}").cast("int")).drop(piece)


def _keyed(docs: DataFrame, columns: list[Column], doc_id: str, text: str, names: list[str]) -> DataFrame:
    """``columns`` with size, key hashes and the row's number, written once."""
    id_, body = F.col(doc_id), F.coalesce(F.col(text), F.lit(""))
    hashed = [F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_, body), 64 - WIDTH).alias(n) for seed, n in zip((11, 12), names[1:3], strict=True)]
    keyed = docs.select(*columns, (F.octet_length(body) + 16).cast("long").alias(names[0]), *hashed,
                        F.monotonically_increasing_id().alias(names[3]))
    return staged(keyed, "shard-keys")


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = 0.001, piece_rows: int = 1_000_000,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    columns = [F.col(doc_id).alias("doc_id"), F.crc32(body.cast("binary")).alias("text_crc32")]
    rows = _keyed(docs, columns, doc_id, text, ["size", "k1", "k2", "row"])
    return place(rows, ["k1", "k2", "row"], "size", shards, tolerance, piece_rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, tolerance: float = 0.001, piece_rows: int = 1_000_000,
                 doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """Write the documents, all columns, as Parquet below ``path``, one folder a shard.

    Each file holds a run of slots in order. Returns the names of the two columns that
    were added (the folder's and the slot's), which avoid the documents' own.
    """
    names = free_names(docs, "size", "k1", "k2", "row", "slot", "shard")
    taken = ["slot", "shard"]
    clash = {n: f for n, f in zip(taken, names[4:], strict=True)}
    inner = docs.toDF(*[f"d{i}" for i in range(len(docs.columns))])
    at = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    rows = _keyed(inner, [F.col(c) for c in inner.columns], at[doc_id], at[text], ["size", "k1", "k2", "row"])
    placed = place(rows, ["k1", "k2", "row"], "size", shards, tolerance, piece_rows)
    out = placed.select(*[F.col(at[c]).alias(c) for c in docs.columns], F.col("slot").alias(clash["slot"]), F.col("shard").alias(clash["shard"]))
    out.write.partitionBy(clash["shard"]).parquet(path)
    return [clash["shard"], clash["slot"]]
