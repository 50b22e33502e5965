"""Nearest neighbours by NN-descent and greedy search of the neighbour graph.

1. Equal vectors are one node (named by its smallest vec_id), so a vector that holds a
   third of all rows is one node of the graph.
2. First neighbours come from several sorted orders: range partitions of random-hyperplane
   codes, cut into blocks whose nodes are compared with each other. Long runs of one
   code fall into many blocks, so no code fills a task.
3. NN-descent: each node meets the vectors of its neighbours and of those that list it (the
   nearest ``reverse`` of these), compares them with each other and tells each of them
   which others are nearer than its present neighbours. Each round is a join of the
   graph with itself and one top-k merge.
   Rounds go on until few edges change.
4. Search: a query starts at its own node's neighbours and keeps its ``pool`` nearest nodes;
   each hop joins the not yet expanded ones with the graph and their neighbours'
   vectors, until every node of every pool is expanded.

The index holds every row. The graph is built on single-precision copies, divided by a
power of two if the values are beyond that range; the search and the results use the
original vectors, in double precision. Recall is measured against brute force in the tests.

Defined cases: vectors that are null or all zero, or hold null, NaN or infinite
components, take no part, nor do rows without vec_id, nor vectors of another length than
the most frequent one (the smaller of equally frequent ones); of rows that repeat a
vec_id one vector stays, the smallest by hash; with fewer candidates than asked for, all
are returned; other columns are ignored; the empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .hyperminhash import sorted_groups

TABLES = 12
BLOCK = 512
BLOCK_KEEP = 10
RANGE_ROWS = 50_000


def _matrix(column: pa.Array, kind: type = np.float32) -> np.ndarray:
    """Rows of a column of equally long lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id (long), h, vec (array of double): one row for each id with a usable vector."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    big = F.lit(float("inf"))
    v = v.where("vec_id is not null and vec is not null and size(vec) > 0").where(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("vec", lambda x: x != 0))
    size = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    v = v.where(F.size("vec") == (size["d"] if size else 0))
    # -0.0 equals 0.0
    v = v.withColumn("vec", F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    return v.groupBy("vec_id").agg(F.min(F.struct(F.xxhash64("vec").alias("h"), "vec")).alias("x")).select(
        "vec_id", "x.h", "x.vec")


def _top(owner: np.ndarray, other: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest different others of each owner, by (distance, id)."""
    order = np.lexsort((dist, other, owner))
    owner, other, dist = owner[order], other[order], dist[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, dist = owner[keep], other[keep], dist[keep]
    order = np.lexsort((other, dist, owner))
    owner, other, dist = owner[order], other[order], dist[order]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.concatenate([first, [len(owner)]])))
    keep = rank < k
    return owner[keep], other[keep], dist[keep]


def _edges(owner: np.ndarray, other: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
    dist = np.minimum(dist, np.finfo(np.float32).max).astype(np.float32)
    return pa.RecordBatch.from_arrays([pa.array(owner), pa.array(other), pa.array(dist)], names=["v", "u", "d"])


def _merged(edges: DataFrame, k: int, parts: int) -> DataFrame:
    """Graph rows (v, us, ds): the k nearest of each node's candidate edges (v, u, d)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        v, u, d = _top(*(t.column(i).to_numpy() for i in range(3)), k)
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        heads = pa.array(np.concatenate([first, [len(v)]]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(v[first]), pa.ListArray.from_arrays(heads, pa.array(u)),
                                          pa.ListArray.from_arrays(heads, pa.array(d))], names=["v", "us", "ds"])

    return edges.repartition(parts, "v").mapInArrow(run, "v long, us array<long>, ds array<float>")


def _first_edges(nodes: DataFrame, dim: int, count: int, parts: int, seed: int) -> DataFrame:
    """Candidate edges from blocks of nodes that are neighbours in sorted hyperplane codes."""
    bits = max(1, min(48, int(np.ceil(np.log2(max(2, count / (BLOCK / 2)))))))
    rng = np.random.Generator(np.random.PCG64(seed))
    planes = rng.standard_normal((TABLES, bits + 1, dim)).astype(np.float32)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            if not len(x):
                continue
            for t in range(TABLES):
                side = x @ planes[t].T
                code = (side[:, :bits] > 0).astype(np.int64) @ (np.int64(1) << np.arange(bits))
                code ^= code >> 1  # neighbouring codes differ in few planes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(code), pa.array(side[:, bits]), b.column(0), b.column(1)],
                    names=["t", "code", "along", "v", "vec"])

    rows = nodes.mapInArrow(codes, "t int, code long, along float, v long, vec array<float>")
    ranged = rows.repartitionByRange(max(parts, count * TABLES // RANGE_ROWS + 1), "t", "code", "along", "v")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        v, x = t.column("v").to_numpy(), _matrix(t.column("vec"))
        order = np.lexsort((v, *(t.column(c).to_numpy() for c in ("along", "code", "t"))))
        v, x = v[order], x[order]
        for lo in range(0, max(1, len(v) - BLOCK // 2), BLOCK // 2):  # blocks overlap by half
            a, y = v[lo:lo + BLOCK], x[lo:lo + BLOCK].astype(np.float64)
            sq = (y * y).sum(axis=1)
            dist = np.maximum(0, sq[:, None] + sq[None, :] - 2 * (y @ y.T))
            dist[a[:, None] == a[None, :]] = np.inf
            k = min(BLOCK_KEEP, len(a) - 1)
            if k < 1:
                continue
            near = np.argpartition(dist, k - 1, axis=1)[:, :k]
            d = np.sqrt(np.take_along_axis(dist, near, axis=1))
            fine = np.isfinite(d).ravel()
            yield _edges(np.repeat(a, k)[fine], a[near].ravel()[fine], d.ravel()[fine])

    return ranged.mapInArrow(blocks, "v long, u long, d float")


def _descend(graph: DataFrame, nodes: DataFrame, k: int, reverse: int, parts: int) -> DataFrame:
    """One round: neighbours of neighbours that are nearer than present neighbours."""
    pairs = graph.select("v", F.explode(F.arrays_zip("us", "ds")).alias("e")).select("v", F.col("e.us").alias("u"), F.col("e.ds").alias("d"))
    listed = pairs.select(F.col("u").alias("v"), F.col("v").alias("u"), "d")
    near = Window.partitionBy("v").orderBy("d", "u")
    listed = listed.withColumn("r", F.row_number().over(near)).where(F.col("r") <= reverse).select("v", "u")
    meet = pairs.select("v", "u").unionByName(listed).distinct()
    reach = graph.select(F.col("v").alias("u"), F.element_at("ds", -1).alias("reach"), F.size("ds").alias("n"))
    told = nodes.select(F.col("v").alias("u"), "vec").join(reach, "u")
    rows = meet.join(told, "u").select("v", "u", "vec", F.when(F.col("n") < k, F.lit(float("inf"))).otherwise(F.col("reach")).alias("reach"))
    rows = rows.repartition(parts, "v").sortWithinPartitions("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for t in sorted_groups(batches, 1):
            u = t.column("u").to_numpy()
            if len(u) < 2:
                continue
            x = _matrix(t.column("vec")).astype(np.float64)
            sq = (x * x).sum(axis=1)
            dist = np.sqrt(np.maximum(0, sq[:, None] + sq[None, :] - 2 * (x @ x.T)))
            np.fill_diagonal(dist, np.inf)
            i, j = np.nonzero(dist < t.column("reach").to_numpy()[:, None])
            if len(i):
                out.append((u[i], u[j], dist[i, j]))
                held += len(i)
            if held > 500_000:  # several hosts propose the same edge
                yield _edges(*_top(*(np.concatenate(c) for c in zip(*out, strict=True)), k))
                out, held = [], 0
        if out:
            yield _edges(*_top(*(np.concatenate(c) for c in zip(*out, strict=True)), k))

    found = rows.mapInArrow(run, "v long, u long, d float")
    return _merged(pairs.unionByName(found), k, parts)


def single(nodes: DataFrame) -> DataFrame:
    """v and vec in single precision, all divided by one power of two if need be."""
    top = nodes.agg(F.max(F.array_max(F.transform("vec", F.abs))).alias("m")).first()["m"] or 1.0
    exponent = math.frexp(top)[1]
    by = F.lit(1.0) if -60 < exponent < 60 else F.pow(F.lit(2.0), F.lit(float(-exponent // 2)))
    return nodes.select("v", F.transform("vec", lambda x: (x * by * by).cast("float")).alias("vec"))


def _changed(new: DataFrame, old: DataFrame) -> float:
    """Share of the edges of a graph that an older one lacks."""
    both = new.select("v", "us").join(old.select("v", F.col("us").alias("before")), "v", "left")
    lacks = F.size(F.array_except("us", F.coalesce("before", F.array().cast("array<long>"))))
    got = both.agg(F.sum(lacks).alias("new"), F.sum(F.size("us")).alias("all")).first()
    return (got["new"] or 0) / max(1, got["all"] or 0)


def build_graph(nodes: DataFrame, k: int = 20, reverse: int = 12, settled: float = 0.05, rounds: int = 12, seed: int = 1) -> DataFrame:
    """Graph (v, us, ds) of nodes (v, vec): the k nearest known neighbours of each, refined until
    a round changes less than a share ``settled`` of the edges, in ``rounds`` rounds at most."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    head = nodes.select(F.size("vec").alias("d")).first()
    count = nodes.count()
    dim = head["d"] if head else 1
    first = _first_edges(nodes.select("v", "vec"), dim, count, parts, seed)
    graph = staged(_merged(first, k, parts), "graph")
    for _ in range(rounds):
        before, graph = graph, staged(_descend(graph, nodes, k, reverse, parts), "graph")
        if _changed(graph, before) < settled:
            break
    return graph


def distances(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, the squares added component by component."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        apart = rows[:, j] - one[j]
        total += apart * apart
    return np.sqrt(total)


def _pooled(rows: DataFrame, pool: int) -> DataFrame:
    """New state of each query from rows (q, kind, u, vec, us, ds, done): kind 0 is the state
    so far with the query's vector, kind 1 a candidate with its vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, 1):
            kind = t.column("kind").to_numpy()
            state = t.filter(pa.array(kind == 0)).to_pylist()[0]
            asked = t.filter(pa.array(kind == 1))
            u = np.asarray(state["us"], dtype=np.int64)
            d = np.asarray(state["ds"], dtype=np.float64)
            done = np.asarray(state["done"], dtype=bool)
            if asked.num_rows:
                c = asked.column("u").to_numpy()
                x = _matrix(asked.column("vec"), np.float64)
                c, first = np.unique(c, return_index=True)
                x = x[first]
                fresh = ~np.isin(c, u) & (c != state["q"])
                c, x = c[fresh], x[fresh]
                apart = distances(x, np.asarray(state["vec"], dtype=np.float64))
                u, d, done = np.concatenate([u, c]), np.concatenate([d, apart]), np.concatenate([done, np.zeros(len(c), bool)])
                order = np.lexsort((u, d))[:pool]
                u, d, done = u[order], d[order], done[order]
            yield pa.RecordBatch.from_arrays(
                [pa.array([state["q"]], pa.int64()), pa.array([state["vec"]], pa.list_(pa.float64())),
                 pa.array([u.tolist()], pa.list_(pa.int64())), pa.array([d.tolist()], pa.list_(pa.float64())),
                 pa.array([done.tolist()], pa.list_(pa.bool_()))], names=["q", "vec", "us", "ds", "done"])

    return rows.mapInArrow(run, "q long, vec array<double>, us array<long>, ds array<double>, done array<boolean>")


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, pool: int = 48) -> DataFrame:
    """State (q, vec, us, ds) of query nodes (column q) after greedy search: the ``pool``
    nearest nodes found, nearest first, without the node itself. It ends, since pools only
    get nearer and a node is expanded once."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.array().cast("array<long>")
    state = queries.join(nodes, F.col("q") == F.col("v")).select(
        "q", "vec", none.alias("us"), F.array().cast("array<double>").alias("ds"), F.array().cast("array<boolean>").alias("done"))
    ask = queries.select("q", F.col("q").alias("v"))
    state = staged(state, "search")
    while True:
        seen = ask.join(graph.select("v", "us"), "v").select("q", F.explode("us").alias("u")).distinct()
        seen = seen.join(nodes.select(F.col("v").alias("u"), "vec"), "u")
        rows = state.select("q", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("u"), "vec", "us", "ds", F.transform(
            "done", lambda x: F.lit(True)).alias("done"))
        rows = rows.unionByName(seen.select("q", F.lit(1).alias("kind"), "u", "vec", none.alias("us"), F.array().cast(
            "array<double>").alias("ds"), F.array().cast("array<boolean>").alias("done")))
        state = staged(_pooled(rows.repartition(parts, "q").sortWithinPartitions("q", "kind"), pool), "search")
        ask = state.select("q", F.explode(F.arrays_zip("us", "done")).alias("e")).where("not e.done").select("q", F.col("e.us").alias("v"))
        if ask.isEmpty():
            return state


def nearest(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
            **graph_options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query row (``is_query``: a
    condition on column vec_id), nearest first, ties to the smaller id."""
    rows = staged(usable(vectors, vec_id, embedding), "usable")
    twins = rows.groupBy("h", "vec").agg(F.min("vec_id").alias("v"))
    nodes = staged(twins.select("v", "vec", "h"), "nodes")
    member = rows.join(nodes.select("v", "vec", "h"), ["h", "vec"]).select("vec_id", "v")
    member = staged(member, "members")
    # the k + 1 smallest ids of a node are enough for any query; salting keeps a hot node apart
    salted = Window.partitionBy("v", "salt").orderBy("vec_id")
    some = member.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn(
        "r", F.row_number().over(salted)).where(F.col("r") <= k + 1)
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    some = some.select(F.col("v").alias("u"), "vec_id")

    graph = build_graph(staged(single(nodes), "single"), **graph_options)
    asked = member.where(is_query)
    state = search(graph, nodes.select("v", "vec"), asked.select(F.col("v").alias("q")).distinct())
    near = state.select("q", F.explode(F.slice(F.arrays_zip("us", "ds"), 1, k)).alias("e")).select(
        "q", F.col("e.us").alias("u"), F.col("e.ds").alias("score"))
    own = state.select("q", F.col("q").alias("u"), F.lit(0.0).cast("double").alias("score"))
    # a node's own copies are at distance 0; k + 1 results leave room for the query itself
    best = near.unionByName(own).join(some, "u").withColumn(
        "r", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))).where(F.col("r") <= k + 1).select(
        "q", "score", "vec_id")
    out = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).join(best, "q").where("query_id <> vec_id")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return out.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
