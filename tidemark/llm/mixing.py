"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are dealt into blocks. For a source whose exact share of the weights
is w, block j has the release time floor(j / w) and the deadline ceil((j + 1) / w); the
earliest deadline among released blocks takes the next slot. As the shares add up to one,
every block meets its window, so at any time each source is less than one block away
from its exact share, however long the schedule. Shares are exact fractions (weights are
floats, hence whole multiples of a power of two); nothing is rounded.

The schedule is laid out in time ranges side by side. What a range needs to know of its
borders is which of the blocks whose windows cross a border are taken before it, at most one
a source. Both neighbours work that out alike: they run the same rule over the stretch
before the border that is as long as the longest window, beginning with the crossing
blocks of the earliest deadlines as taken. Any such beginning can be continued without
a miss, and all blocks that cross the border are released within the stretch, so the two
ranges fit together. A range is at least as long as that stretch; the smallest share thus
bounds how finely the schedule is cut, not its result.

The driver holds the weight and the number of rows of each source.

Defined cases: a null source is a source of its own (``None`` in ``weights``); sources
that ``weights`` doesn't name, or whose weight isn't a positive number, follow after all others,
in blocks by turns; a source that runs out leaves its later slots empty; an empty table
gives no rows; rows that repeat stay repeated; other columns of the input are ignored,
whatever their names. Slots are below 2**60; weights so far apart that they don't suffice
are refused.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names

LATEST = 1 << 60


def exact_weights(weights: dict) -> dict:
    """The positive weights as whole numbers in the same proportions."""
    exact = {k: Fraction(w) for k, w in weights.items() if w and w > 0 and math.isfinite(w)}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {k: int(x * scale) for k, x in exact.items()}
    common = math.gcd(*whole.values())
    return {k: n // common for k, n in whole.items()}


class Pfair:
    """Windows and schedule of sources with whole ``weights`` (a list of numbers)."""

    def __init__(self, weights: list[int]):
        self.weights = weights
        self.total = sum(weights)
        self.longest = -(-self.total // min(weights)) + 1

    def window(self, s: int, j: int) -> tuple[int, int]:
        w = self.weights[s]
        return j * self.total // w, -(-(j + 1) * self.total // w)

    def crossing(self, t: int) -> list[tuple[int, int]]:
        """(deadline, source) of the blocks whose windows cross time t, earliest first."""
        got = [(s, *divmod(t * w, self.total)) for s, w in enumerate(self.weights)]
        return sorted((self.window(s, j)[1], s) for s, j, rest in got if rest)

    def taken(self, t: int) -> set[int]:
        """Sources whose block across time t has its slot before t."""
        start = max(0, t - self.longest)
        due = start - sum(start * w // self.total for w in self.weights)
        before = {s for _, s in self.crossing(start)[:due]}
        return {s for s, j, _ in self.run(start, t, before, None, None) if self.window(s, j)[1] > t}

    def run(self, start: int, end: int, before: set[int], late: set[int] | None, blocks: list[int] | None) -> Iterator[tuple[int, int, int]]:
        """(source, block, slot) of the slots from ``start`` to ``end``. ``before``: sources whose
        block across the start is done; ``late``: those whose block across the end must be
        (None: whichever get a slot); ``blocks``: how many each source has (None: no end)."""
        waiting: list[tuple[int, int, int, int]] = []  # (release, source, block, deadline)

        def offer(s: int, j: int) -> None:
            if blocks is not None and j >= blocks[s]:
                return
            release, deadline = self.window(s, j)
            if release >= end or late is not None and deadline > end and s not in late:
                return
            heapq.heappush(waiting, (max(release, start), s, j, deadline if late is None else min(deadline, end)))

        for s, w in enumerate(self.weights):
            j, rest = divmod(start * w, self.total)
            offer(s, j + (rest > 0 and s in before))
        ready: list[tuple[int, int, int]] = []  # (deadline, source, block)
        t = start
        while t < end and (ready or waiting):
            if not ready:
                t = max(t, waiting[0][0])
            while waiting and waiting[0][0] <= t:
                _, s, j, deadline = heapq.heappop(waiting)
                heapq.heappush(ready, (deadline, s, j))
            if not ready or t >= end:
                continue
            deadline, s, j = heapq.heappop(ready)
            if t >= deadline:
                raise AssertionError(f"block {j} of source {s} misses its deadline")
            yield s, j, t
            offer(s, j + 1)
            t += 1


def ranges(weights: list[int], blocks: list[int], most: int) -> list[int]:
    """Ascending times, from 0 to the end of all windows, with about ``most`` blocks between
    two of them, and no less than the longest window."""
    pfair = Pfair(weights)
    end = max(pfair.window(s, n - 1)[1] if n else 0 for s, n in enumerate(blocks))
    if end > LATEST:
        raise ValueError("the weights are too far apart: give the smallest ones weight 0")
    share = np.array([w / pfair.total for w in weights])
    out_at = np.array(blocks) / share  # when each source runs out
    order = np.argsort(out_at)
    times = np.concatenate([[0.0], out_at[order]])
    rate = np.concatenate([np.cumsum(share[order][::-1])[::-1], [0.0]])
    done = np.concatenate([[0.0], np.cumsum(np.diff(times) * rate[:-1])])
    times_out = [0]
    for n in range(1, -(-sum(blocks) // most)):
        t = int(np.interp(n * most, done, times))
        if t - times_out[-1] >= pfair.longest and end - t >= pfair.longest:
            times_out.append(t)
    return [*times_out, end]


def schedule(spark: SparkSession, weights: dict, blocks: dict, range_blocks: int = 200_000) -> DataFrame:
    """source, block, slot of every block: ``blocks`` has each source's number of them."""
    whole = exact_weights(weights)
    names = sorted((k for k in whole if blocks.get(k)), key=lambda k: (k is None, str(k)))
    if not names:
        return spark.createDataFrame([], "source string, block long, slot long")
    # sources without rows count with their share, like one that has run out
    names += sorted(set(whole) - set(names), key=lambda k: (k is None, str(k)))
    pfair, counts = Pfair([whole[k] for k in names]), [int(blocks.get(k) or 0) for k in names]
    times = ranges(pfair.weights, counts, range_blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                before = pfair.taken(start) if start else set()
                late = pfair.taken(end) if end != times[-1] else set()
                got = list(pfair.run(start, end, before, late, counts))
                for lo in range(0, len(got), 10_000):
                    s, j, t = zip(*got[lo:lo + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in s], pa.string()), pa.array(j, pa.int64()), pa.array(t, pa.int64())],
                                                     names=["source", "block", "slot"])

    spans = [(i, a, b) for i, (a, b) in enumerate(zip(times[:-1], times[1:], strict=True))]
    return spark.createDataFrame(spans, "i int, start long, end long").repartition(len(spans), "i").mapInArrow(
        run, "source string, block long, slot long")


def source_sizes(docs: DataFrame, source: str = "source") -> dict:
    """Rows of each source; one number a source goes to the driver."""
    return {r["s"]: r["count"] for r in docs.groupBy(F.col(source).cast("string").alias("s")).count().collect()}


def source_weights(docs: DataFrame, power: float = 0.7, source: str = "source") -> dict:
    """Target weights from the sources' sizes, n**power: below 1 it lifts small sources."""
    return {k: n ** power for k, n in source_sizes(docs, source).items()}


def mix(docs: DataFrame, weights: dict, block_docs: int = 16, seed: int = 0, range_blocks: int = 200_000,
        salts: int | None = None, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Schedule every document: doc_id, source, block, slot, place.

    ``block`` is the block's number within its source, ``slot`` the time it is taken,
    ``place`` the document's place in its block; (slot, place, doc_id) orders the mix.
    Documents are numbered in two steps: within (source, salt), then by the
    salts' counts, so that a source with a third of all rows is dealt over many
    tasks. ``salts`` defaults to the session's shuffle partitions.
    """
    spark = docs.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = {k: -(-n // block_docs) for k, n in source_sizes(docs, source).items()}
    plan = schedule(spark, weights, blocks, range_blocks).select(
        F.col("source").alias("s3"), F.col("block").alias("b3"), "slot")

    salted = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source")).withColumn(
        "h", F.xxhash64(F.lit(seed), F.col("doc_id"))).withColumn("salt", F.pmod(F.col("h"), F.lit(salts)).cast("int"))
    # Hash, not id, orders a source: its blocks are a random sample of it.
    within = Window.partitionBy("source", "salt").orderBy("h", "doc_id")
    dealt = salted.withColumn("rn", F.row_number().over(within) - 1)
    sizes = salted.groupBy("source", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("source").alias("s2"), F.col("salt").alias("salt2"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    dealt = dealt.join(sizes, F.col("source").eqNullSafe(F.col("s2")) & (F.col("salt") == F.col("salt2"))).select(
        "doc_id", "source", (F.col("earlier") + F.col("rn")).alias("nth")).select(
        "doc_id", "source", F.floor(F.col("nth") / block_docs).cast("long").alias("block"),
        (F.col("nth") % block_docs).cast("int").alias("place"))
    dealt = dealt.join(plan, F.col("source").eqNullSafe(F.col("s3")) & (F.col("block") == F.col("b3")), "left")
    # without a weight: after all slots
    return dealt.select("doc_id", "source", "block", F.coalesce("slot", F.lit(2 * LATEST) + F.col("block")).alias("slot"), "place")


def mixed_documents(docs: DataFrame, weights: dict, **options) -> DataFrame:
    """The documents themselves, all columns, in the order of the mix (range partitions
    written in order). Rows join their schedule by (doc_id, source)."""
    doc_id, source = options.get("doc_id", "doc_id"), options.get("source", "source")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = mix(docs, weights, **options).groupBy("doc_id", "source").agg(
        F.min(F.struct("slot", "place")).alias("at"))  # repeated rows share the first place
    id_, source_, at = free_names(docs, "mix_id", "mix_source", "mix_at")
    plan = plan.select(F.col("doc_id").alias(id_), F.col("source").alias(source_), F.col("at").alias(at))
    joined = docs.join(plan, docs[doc_id].eqNullSafe(plan[id_]) & docs[source].cast("string").eqNullSafe(plan[source_]))
    return joined.repartitionByRange(n, at, id_).sortWithinPartitions(at, id_).drop(id_, source_, at)
