"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

1. A text's distinct word shingles fill ``rows * bands`` registers (fast similarity
   sketching: rounds of hashing into buckets until none is empty, then each shingle into
   each bucket that is still empty; the same for all sizes, so sets of any two sizes
   compare). A register keeps the leading-zero count of its smallest hash (5
   bits), the next 8 bits as mantissa and the round (3 bits): 16 bits.
2. Equal sets are one class, found by a 128-bit set hash with map-side combining.
3. The classes' compressed registers are banded; range buckets of the band keys bring
   those of one key together. Inside a band bucket no pairs are listed: a few leaders
   gather the others by the collision-corrected Jaccard estimate (canopies). A member
   close to a leader stops leading; everything within reach of a leader joins it. By the
   triangle inequality of the Jaccard distance both ends of a link meet at a leader.
4. Components of these loose ties are clusters. In a cluster all links are tested on
   the full sets through an inverted index; members of a component that already holds
   most of the cluster need no test of their own. Clusters beyond ``BLOCK_SHINGLES`` are
   dealt into blocks, and each two blocks meet in one task.
5. Components of the confirmed links give each document the smallest doc_id it reaches.

Two sets at the threshold share a band with probability 1 - (1 - t**rows)**bands, for
0.85 and 6 x 32 all but 3e-7.

Defined cases: a null or empty text, or one without words, has no shingle, is linked
with nothing and is its own component; fewer words than a shingle are one shingle;
rows that repeat a doc_id count as one document for links; a null doc_id takes part as
the smallest id and is returned as null; other columns are ignored; the empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, staged
from .components import components
from .hashing import chunks, combine, flat_texts, mix, shingles, token_hashes
from .ranges import repeats
from .suffix_dedup import NO_ID, small_side

ROUNDS = 32
BLOCK_SHINGLES = 2_000_000
BUCKET_ROWS = 40_000
#: Chance that registers of different minima are equal: 8 mantissa bits, zeros and round alike.
COLLISION = 1 / 700


def _seed(i: int) -> np.uint64:
    return mix(np.array([(0xA24BAED4963EE407 + 0x9FB21C651E98DF25 * (i + 1)) % 2**64], dtype=np.uint64))[0]


def _compress(value: np.ndarray, turn: np.ndarray | int) -> np.ndarray:
    """32-bit minima as leading zeros, 8 bits after the leading one, and the round."""
    exact = value.astype(np.float64)
    length = np.where(value > 0, np.floor(np.log2(np.maximum(exact, 1))).astype(np.int64) + 1, 0)
    zeros = 32 - length
    below = np.maximum(length - 1, 0)
    rest = value.astype(np.int64) - np.where(length > 0, np.int64(1) << below, 0)
    mantissa = np.where(below >= 8, rest >> np.maximum(below - 8, 0), rest << np.maximum(8 - below, 0))
    return ((np.minimum(zeros, 31) << 11) | (mantissa << 3) | (turn & 7)).astype(np.uint16)


def sketch(hashes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Registers (texts x k, uint16) of shingle sets; texts without shingles get zeros."""
    n = len(counts)
    regs = np.zeros((n, k), dtype=np.uint16)
    heads = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(n), counts)
    empty = np.iinfo(np.uint64).max
    best = np.full(n * k, empty, dtype=np.uint64)
    left = np.where(counts > 0, k, 0)  # registers still empty
    for turn in range(ROUNDS):
        at = np.flatnonzero(left[owner])
        if not len(at):
            break
        x = mix(hashes[at] ^ _seed(turn))
        slot = owner[at] * k + ((x >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
        free = np.flatnonzero(best[slot] == empty)
        np.minimum.at(best, slot[free], x[free] & np.uint64(0xFFFFFFFF))
        fresh = np.unique(slot[free])
        regs.reshape(-1)[fresh] = _compress(best[fresh], turn)
        left -= np.bincount(fresh // k, minlength=n)
    slots = np.array([_seed(1000 + j) for j in range(k)], dtype=np.uint64)
    holes = best.reshape(n, k) == empty
    for d in np.flatnonzero(holes.any(axis=1) & (counts > 0)):
        gap = np.flatnonzero(holes[d])
        mine = hashes[heads[d]:heads[d + 1]]
        low = mix((mine[:, None] ^ slots[gap][None, :]).ravel()).reshape(len(mine), len(gap)) >> np.uint64(32)
        regs[d, gap] = _compress(low.min(axis=0), 7)
    return regs


def jaccard_estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Collision-corrected estimate from equal registers."""
    equal = (many == one).mean(axis=1)
    return (equal - COLLISION) / (1 - COLLISION)


def band_keys(regs: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each text and band of neighbouring registers."""
    n, k = regs.shape
    parts = regs.astype(np.uint64).reshape(n, bands, k // bands)
    number = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands))
    return combine(mix(number + np.uint64(77)), *(parts[:, :, i] for i in range(k // bands)))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of equal leading ``keys`` columns from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy() for i in range(keys)]
        cut = np.ones(b.num_rows, dtype=bool)
        cut[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        first = tuple(c[0] for c in cols)
        cut[0] = last is not None and first != last
        at = [0, *np.flatnonzero(cut).tolist(), b.num_rows]
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            if (lo > 0 or cut[0]) and held:
                yield pa.Table.from_batches(held)
                held = []
            if hi > lo:
                held.append(b.slice(lo, hi - lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def sketches(docs: DataFrame, words: int, k: int, doc_id: str, text: str) -> DataFrame:
    """id, n (set size), s1 and s2 (set hash), regs of every text."""
    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = flat_texts(b.column(1))
            for lo, hi, part, off in chunks(data, offsets):
                sets, counts = shingles(*token_hashes(part, off), words)
                heads = np.concatenate([[0], np.cumsum(counts)])
                names = []
                for salt in (11, 13):  # sums of hashes name a set whatever its order
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets + np.uint64(salt)), dtype=np.uint64)])
                    names.append((total[heads[1:]] - total[heads[:-1]]).view(np.int64))
                regs = sketch(sets, counts, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(counts), *map(pa.array, names),
                     pa.array([r.tobytes() for r in regs], pa.binary())], names=["id", "n", "s1", "s2", "regs"])

    return src.mapInArrow(run, "id long, n long, s1 long, s2 long, regs binary")


def _band_rows(classes: DataFrame, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            regs = np.stack([np.frombuffer(x, dtype=np.uint16) for x in b.column(1).to_pylist()])
            keys = band_keys(regs, bands).view(np.int64).ravel()
            ids = np.repeat(b.column(0).to_numpy(), bands)
            for lo in range(0, len(keys), 200_000):
                key, i = pa.array(keys[lo:lo + 200_000]), pa.array(ids[lo:lo + 200_000])
                yield pa.RecordBatch.from_arrays([key, i, i, key, i], names=["core", "u1", "u2", "key", "id"])

    return classes.select("id", "regs").mapInArrow(run, "core long, u1 long, u2 long, key long, id long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node it reaches) that connect what the edges (a, b) connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], least)
        np.minimum.at(label, label[j], least)
        label = label[label]
        if (label == before).all():
            break
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _ties(shared: DataFrame, buckets: int, tight: float, loose: float) -> DataFrame:
    """Loose ties of members to leaders in each band bucket (kind 0), as a forest for each
    task: never more rows than members. The leaders of keys that may go on in a neighbouring
    range bucket come as (key, leader), kind 1."""
    ranged = shared.repartitionByRange(buckets, "key", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        key, ids = t.column(0).to_numpy(), t.column(1).to_numpy()
        regs = np.stack([np.frombuffer(x, dtype=np.uint16) for x in t.column(2).to_pylist()])
        order = np.lexsort((ids, key))
        key, ids, regs = key[order], ids[order], regs[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.concatenate([starts[1:], [len(key)]])
        ties, border = ([], []), ([], [])
        for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
            outer = lo == 0 or hi == len(key)
            left = np.ones(hi - lo, dtype=bool)
            while left.any():
                leader = int(np.argmax(left))
                near = jaccard_estimate(regs[lo + leader], regs[lo:hi])
                tied = np.flatnonzero(near >= loose)
                ties[0].append(ids[lo + tied])
                ties[1].append(np.full(len(tied), ids[lo + leader]))
                if outer:
                    border[0].append(key[lo])
                    border[1].append(ids[lo + leader])
                left &= near < tight
                left[leader] = False
        a, b = forest(np.concatenate(ties[0]), np.concatenate(ties[1]))
        for x, y, kind in ((a, b, 0), (np.array(border[0], np.int64), np.array(border[1], np.int64), 1)):
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(np.full(len(x), kind))], names=["a", "b", "kind"])

    return ranged.mapInArrow(run, "a long, b long, kind long")


def linked(sets: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """Component number of each set where sets with 100 * |and| >= percent * |or| are linked.

    An inverted index gives a set's exact intersections with all others at once. Sets
    of a component that holds over half of all need no turn: another set that links to
    it has a turn itself.
    """
    m = len(counts)
    parent = np.arange(m)
    heads = np.concatenate([[0], np.cumsum(counts)])
    _, name = np.unique(sets, return_inverse=True)
    owner = np.repeat(np.arange(m), counts)
    by_name = np.argsort(name, kind="stable")
    owners = owner[by_name]
    first = np.searchsorted(name[by_name], np.arange(name.max() + 2 if len(name) else 1))
    size = np.ones(m, dtype=np.int64)
    for x in range(m):
        if 2 * size[parent[x]] > m:
            continue
        mine = name[heads[x]:heads[x + 1]]
        lo, n = first[mine], first[mine + 1] - first[mine]
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(owners[at], minlength=m)
        hit = np.flatnonzero(100 * both >= percent * (counts[x] + counts - both))
        roots = np.unique(parent[hit])
        if len(roots) > 1:
            parent[np.isin(parent, roots)] = roots[0]
            size[roots[0]] = np.count_nonzero(parent == roots[0])
    return parent


def _confirmed(docs: DataFrame, clusters: DataFrame, words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Links (a, b) that span the exact components within clusters (id, cluster, blocks)."""
    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    members = clusters.select(F.col("id").alias("k"), "cluster", "blocks")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    work = src.join(small_side(members), F.col("id") == F.col("k")).withColumn("own", own)
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1),
                       lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))
    work = work.withColumn("meet", F.explode(meet)).where("blocks = 1 or meet.i < meet.j").select(
        "cluster", F.col("meet.i").alias("i"), F.col("meet.j").alias("j"), "id", "text")
    work = work.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, 3):
            ids = t.column("id").to_numpy()
            data, offsets = flat_texts(t.column("text"))
            sets, counts = [], []
            for _, _, part, off in chunks(data, offsets):
                s, c = shingles(*token_hashes(part, off), words)
                sets.append(s)
                counts.append(c)
            root = linked(np.concatenate(sets), np.concatenate(counts), percent)
            far = np.flatnonzero(root != np.arange(len(root)))
            if len(far):
                yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[root[far]])], names=["a", "b"])

    return work.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, rows: int = 6, bands: int = 32,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    spark = docs.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = percent / 100
    drawn = staged(sketches(docs, words, rows * bands, doc_id, text), "sketches")
    classes = staged(drawn.where("n > 0").groupBy("s1", "s2").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.first("regs").alias("regs")), "classes")
    n_classes = classes.count()
    shared = staged(repeats(_band_rows(classes, bands), ["key", "id"], max(floor, n_classes * bands // 2_000_000 + 1))
                    .select("key", "id"), "shared")
    n_shared = shared.count()
    with_regs = shared.join(classes.select("id", "regs"), "id").select("key", "id", "regs")
    ties = staged(_ties(with_regs, max(floor, n_shared // BUCKET_ROWS + 1), t - 0.05, 2 * t - 1.28), "ties")
    border = ties.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("leader"))
    head = border.groupBy("key").agg(F.min("leader").alias("b"))
    across = border.join(head, "key").where("leader <> b").select(F.col("leader").alias("a"), "b")
    clusters = components(ties.where("kind = 0").select("a", "b").unionByName(across))
    clusters = clusters.join(classes.select(F.col("id").alias("node"), "n"), "node")
    sizes = clusters.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).alias("blocks"))
    clusters = staged(clusters.join(sizes, "component").select(
        F.col("node").alias("id"), F.col("component").alias("cluster"), F.col("blocks").cast("long").alias("blocks")), "clusters")
    found = components(_confirmed(docs, clusters, words, percent, doc_id, text))
    of_class = classes.select("s1", "s2", F.col("id").alias("node")).join(found, "node", "left").select(
        "s1", "s2", F.coalesce("component", "node").alias("component"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    out = drawn.select("id", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left").select(
        "id", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))
    return out.select(real("id").alias("doc_id"), F.col("n").alias("n_shingles"), real("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


def distinct_documents(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = 5, bands: int = 40,
                       doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, one of each group of near-duplicates (rows that repeat
    the kept doc_id stay)."""
    (name,) = free_names(docs, "gone_id")
    gone = staged(near_duplicates(docs, words, percent, rows, bands, doc_id, text).where(
        "not kept").select(F.col("doc_id").alias(name)).distinct(), "gone")
    return docs.join(small_side(gone), docs[doc_id].cast("long") == F.col(name), "left_anti")
