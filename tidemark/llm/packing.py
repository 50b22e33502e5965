"""Packing into optimal length buckets.

Every document becomes sequences of at most ``max_len`` tokens (longer ones are cut
into whole parts; nothing is dropped). The global histogram of sequence lengths has at
most ``max_len`` entries, so the driver holds it whole; dynamic programming over it
finds the ``buckets`` upper bounds that minimise all padding. Batches of at most
``budget`` padded tokens then form inside each bucket.

Defined cases: a null or empty text has no token and gives one sequence of length 0 in
the first bucket; an empty table gives no rows; repeated rows give repeated sequences;
other columns are ignored. Tokens are words `[^\\x20\\x09-\\x0D]+`.

The documents may have an order (a column, as from `numbered`): then batches form in that
order inside each bucket, a stretch of the order at a time. Else the order is a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, small_side, staged
from .hashing import chunks, flat_texts, token_spans


def optimal_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of the buckets that minimise sum(count * (bound - length)).

    Dynamic programming: best[k][i] is the least padding of the first i lengths in k
    buckets; a bucket's bound is its longest length. Ties take the earlier cut.
    """
    order = np.argsort(lengths)
    length = np.asarray(lengths, dtype=np.int64)[order]
    count = np.asarray(counts, dtype=np.int64)[order]
    n = len(length)
    if n == 0:
        return []
    buckets = min(buckets, n)
    c = np.concatenate([[0], np.cumsum(count)]).astype(np.float64)
    w = np.concatenate([[0], np.cumsum(count * length)]).astype(np.float64)
    best = np.concatenate([[0.0], length * c[1:] - w[1:]])  # one bucket
    cuts = []
    for _ in range(1, buckets):
        new, cut = best.copy(), np.zeros(n + 1, dtype=np.int64)
        for i in range(1, n + 1):
            cost = best[:i] + length[i - 1] * (c[i] - c[:i]) - (w[i] - w[:i])
            j = int(np.argmin(cost))
            new[i], cut[i] = cost[j], j
        cuts.append(cut)
        best = new
    out, i = [], n
    for cut in reversed(cuts):
        if i == 0:
            break
        out.append(int(length[i - 1]))
        i = int(cut[i])
    if i > 0:
        out.append(int(length[i - 1]))
    return sorted(set(out))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column of their place (from 0) in the written table they were read
    from, its files taken one after the other; and that column's name.

    A frame that isn't a plain read of files is written first, partition after partition.
    """
    file, row, part, ahead, n, place = free_names(docs, "file", "row", "part", "ahead", "n", "place")
    meta = "_metadata"
    if not docs.inputFiles() or "LogicalRelation" != docs._jdf.queryExecution().analyzed().nodeName():
        docs = staged(docs, "ordered")
    at = docs.metadataColumn(meta)
    read = docs.select("*", at["file_name"].alias(file), at["row_index"].alias(row))
    number = F.coalesce(F.regexp_extract(file, r"part-(\d+)", 1).try_cast("long"), F.lit(0))
    files = read.groupBy(file).agg(F.count(F.lit(1)).alias(n)).withColumn(part, number)
    # one row for each file
    earlier = Window.orderBy(part, file).rowsBetween(Window.unboundedPreceding, -1)
    files = staged(files.select(F.col(file).alias(part), F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(ahead)), "files")
    return read.join(small_side(files), F.col(file) == F.col(part)).withColumn(place, F.col(ahead) + F.col(row)).drop(
        file, row, part, ahead), place


def token_lengths(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: str | None = None) -> DataFrame:
    """doc_id, the place in the order and the number of words of each whole text."""
    place = F.lit(None) if order is None else F.col(order)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), place.cast("long").alias("place"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = flat_texts(b.column(1))
            out = np.zeros(b.num_rows, dtype=np.int64)
            for lo, hi, part, off in chunks(data, offsets):
                out[lo:hi] = token_spans(part, off)[2]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out)], names=["doc_id", "place", "n_tokens"])

    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType), T.StructField("place", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    return src.mapInArrow(count, schema)


def pack(docs: DataFrame, max_len: int = 4096, buckets: int = 16, budget: int = 65_536,
         group_rows: int = 100_000, doc_id: str = "doc_id", text: str = "text", order: str | None = None) -> DataFrame:
    """One row for each sequence: doc_id, part, n_tokens, bound, batch_group, batch, slot, padding.

    ``bound`` is the bucket's padded length; (bound, batch_group, batch) names a batch of
    ``budget // bound`` sequences (one at least), the last of a group may be shorter. A
    bucket is dealt by hash into groups of about ``group_rows`` sequences, so no task
    holds a whole bucket, however common its lengths are. With ``order``, a column of
    places from 0, a group is a stretch of ``group_rows`` documents instead, and its batches
    follow that order: (batch_group, batch) goes on where the one before ends.
    """
    lengths = staged(token_lengths(docs, doc_id, text, order), "lengths")  # two numbers a row; texts are read once
    full = F.floor(F.col("n_tokens") / max_len)
    # the whole parts of a long text are counted, not exploded, for the histogram
    rest = F.col("n_tokens") % max_len
    hist = lengths.select(F.explode(F.array(
        F.struct(rest.alias("len"), F.when((rest > 0) | (full == 0), 1).otherwise(0).alias("n")),
        F.struct(F.lit(max_len).cast("long").alias("len"), full.alias("n")))).alias("x")).groupBy("x.len").agg(
        F.sum("x.n").alias("n")).where("n > 0").collect()  # at most max_len + 1 rows
    bounds = optimal_bounds([r["len"] for r in hist], [r["n"] for r in hist], buckets)
    total = sum(r["n"] for r in hist)
    groups = max(1, -(-total // group_rows))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / max_len)).cast("int")
    seqs = lengths.select("doc_id", "place", "n_tokens", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")).select(
        "doc_id", "place", "part", F.least(F.lit(max_len).cast("long"),
                                  F.col("n_tokens") - F.col("part") * F.lit(max_len).cast("long")).alias("n_tokens"))
    bound = F.lit(None).cast("long")
    for b in reversed(bounds):
        bound = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bound)
    seqs = seqs.withColumn("bound", bound).withColumn("h", F.xxhash64("doc_id", "part"))
    dealt = F.pmod(F.col("h"), F.lit(groups)) if order is None else F.floor(F.col("place") / group_rows)
    seqs = seqs.withColumn("batch_group", dealt.cast("int"))
    w = Window.partitionBy("bound", "batch_group").orderBy(*(["h", "doc_id", "part"] if order is None else ["place", "part"]))
    rn = F.row_number().over(w) - 1
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bound"), F.lit(1))))
    return seqs.withColumn("rn", rn).select(
        "doc_id", "part", "n_tokens", "bound", "batch_group", F.floor(F.col("rn") / per).cast("long").alias("batch"),
        (F.col("rn") % per).cast("int").alias("slot"), (F.col("bound") - F.col("n_tokens")).alias("padding"))
