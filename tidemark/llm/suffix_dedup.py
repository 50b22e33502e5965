"""Removal of repeated byte strings by sorting suffixes in range buckets.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in
the same text or another. Strings are judged on the input. Sorting the suffixes at all
positions would move each text's bytes many times; a sparse set of suffixes gives the
same result in three rounds of one step (`ranges.repeats`):

* The windows (strings of ``length`` bytes) of a text that share their anchor, the leftmost
  smallest hashed gram of half the length, form a run. The suffixes at the anchors are
  range-partitioned by sampled splitters on the fingerprint of their leading gram, then
  on that of the run's whole text; buckets sort locally and compare across borders.
* A run whose whole text stands elsewhere is repeated throughout. A run whose gram no
  other suffix begins with has no repeated window, because equal windows have equal
  anchors. In between, runs (and one of each repeated run beside them) are cut into blocks of 16 windows, aligned at the
  anchor, and then into single windows; a block's leading gram is what all the windows
  of its place in the grid have in common.

Fingerprints have 192 bits (64 of the leading gram, 128 of the text).

Defined cases: a null or empty text, or one shorter than ``length``, loses nothing;
rows that repeat (doc_id, text) are each other's copies; rows that share a doc_id with
other texts stay apart; a null doc_id is an id of its own; other columns are ignored;
the empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, slices, small_side, staged
from .hashing import BASES, BYTE_VALUES, flat_texts, inverse_powers, mix, powers
from .ranges import repeats

PIECE = 1 << 18  # bytes of text a task hashes at a time (about 100 bytes of arrays for each)
BLOCK = 16  # windows of a block
NO_ID = -(2 ** 63)  # stands for a null doc_id


def _pieces(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """(row, start, end) of text pieces, about PIECE bytes a group. A longer text is cut
    into pieces that overlap by length - 1 bytes, so each window is in one piece."""
    group, size = [], 0
    for row in np.flatnonzero(np.diff(offsets) >= length).tolist():
        lo, hi = int(offsets[row]), int(offsets[row + 1])
        for at in range(lo, hi - length + 1, PIECE):
            end = min(hi, at + PIECE + length - 1)
            group.append((row, at, end))
            size += end - at
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


class _Hasher:
    """Hashes of spans of a buffer, with two independent bases."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = []
        for which in (0, 1):
            s = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUES[which][data] * powers(which, n), out=s[1:])
            self.sums.append(s)

    def span(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        raw = (self.sums[which][end] - self.sums[which][start]) * inverse_powers(which, len(self.sums[0]))[start]
        return mix(raw ^ (end - start).astype(np.uint64) * BASES[1 - which]).view(np.int64)


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from block-wise running minima."""
    n = len(key)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _runs(data: np.ndarray, borders: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: (first window, number of windows, anchor)."""
    gram = length // 2
    h = _Hasher(data)
    at = np.arange(len(data) - gram + 1)
    raw = (h.sums[0][gram:] - h.sums[0][:len(at)]) * inverse_powers(0, len(data) + 1)[:len(at)]
    key = (mix(raw) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (_sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = np.arange(len(anchor))
    piece = np.searchsorted(borders, window, side="right") - 1
    inside = window + length <= borders[np.minimum(piece + 1, len(borders) - 1)]
    window, anchor, piece = window[inside], anchor[inside], piece[inside]
    first = np.ones(len(window), dtype=bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    starts = np.flatnonzero(first)
    count = np.diff(np.concatenate([starts, [len(window)]]))
    return window[starts], count, anchor[starts]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, mark, text: (id, mark) tells texts apart, also under one doc_id."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.hash(F.col(text)).cast("long").alias("mark"), F.col(text).alias("text"))


SPAN = "core long, u1 long, u2 long, id long, mark long, start long, n long, anchor long"


def _batch(h: _Hasher, first, n, anchor, core, width, rows, ids, marks, shift) -> pa.RecordBatch:
    """Rows of spans: ``core`` is the (start, end) that all windows of a span share."""
    u = [h.span(first, first + n - 1 + width, w) for w in (0, 1)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (h.span(*core, 0), *u, ids[rows], marks[rows], first + shift, n, anchor + shift)],
        names=["core", "u1", "u2", "id", "mark", "start", "n", "anchor"])


def _anchored(keyed: DataFrame, length: int) -> DataFrame:
    """All runs of all texts, as spans whose core is the anchor's gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks = b.column(0).to_numpy(), b.column(1).to_numpy()
            data, offsets = flat_texts(b.column(2))
            for group in _pieces(offsets, length):
                part = np.concatenate([data[lo:hi] for _, lo, hi in group])
                borders = np.concatenate([[0], np.cumsum([hi - lo for _, lo, hi in group])])
                first, n, anchor = _runs(part, borders, length)
                piece = np.searchsorted(borders, first, side="right") - 1
                rows = np.array([g[0] for g in group])[piece]
                shift = (np.array([g[1] for g in group]) - borders[:-1])[piece] - offsets[rows]
                yield _batch(_Hasher(part), first, n, anchor, (anchor, anchor + length // 2), length, rows, ids, marks, shift)
        pa.default_memory_pool().release_unused()

    return keyed.mapInArrow(run, SPAN)


def _cut(keyed: DataFrame, spans: DataFrame, size: int, length: int) -> DataFrame:
    """Unsettled spans cut into spans of ``size`` windows, aligned at their anchors."""
    per_text = staged(spans.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("spans")), "unsettled")
    k = per_text.select(F.col("id").alias("k_id"), F.col("mark").alias("k_mark"), "spans")
    work = keyed.join(small_side(k, "spans"), (F.col("id") == F.col("k_id")) & (F.col("mark") == F.col("k_mark"))).select(
        "id", "mark", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks, spans_of = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            data, offsets = flat_texts(b.column(2))
            for i in range(b.num_rows):
                flat = spans_of.slice(i, 1).flatten()
                start, n, anchor = (flat.field(f).to_numpy() for f in ("start", "n", "anchor"))
                # spans are cut where (window - anchor) is a multiple of the size
                lead = (start - anchor) % size
                count = -(-(lead + n) // size)
                span = np.repeat(np.arange(len(start)), count)
                nth = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
                grid = start[span] - lead[span] + nth * size
                lo, hi = np.maximum(start[span], grid), np.minimum(start[span] + n[span], grid + size)
                text = data[offsets[i]:offsets[i + 1]]
                for first in range(0, len(lo), 1 << 16):
                    some = slice(first, first + (1 << 16))
                    a, z, anc, whole = lo[some], hi[some], anchor[span[some]], grid[some]
                    base = int(a.min())
                    h = _Hasher(text[base:int(z.max()) - 1 + length])
                    a, z, whole = a - base, z - base, whole - base
                    rows = np.full(len(a), i)
                    yield _batch(h, a, z - a, anc - base, (whole + size - 1, whole + length), length, rows, ids, marks, base)

    return work.mapInArrow(run, SPAN)


def repeated_spans(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, mark, spans (array of [start, end) in bytes, maximal, ascending) of each text
    with repeated strings of ``length`` bytes."""
    if length < 2 * BLOCK + 2:
        raise ValueError(f"length must be at least {2 * BLOCK + 2}")
    keyed = _keyed(docs, doc_id, text)
    floor = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    payload = ["id", "mark", "start", "n", "anchor"]
    settled = []
    size_mb = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] / 1e6
    # a bucket holds about a million suffixes, whatever the input's size
    level, buckets = _anchored(keyed, length), max(floor, int(size_mb * 1e6 / (length / 4) / 1e6) + 1)
    for size in (BLOCK, 1, 0):
        found = repeats(level, payload, buckets)
        settled.append(found.where("whole").select("id", "mark", "start", (F.col("start") + F.col("n") - 1 + length).alias("end")))
        if size:
            rest = staged(found.where("open").drop("whole", "open"), "rest")
            windows = rest.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            level, buckets = _cut(keyed, rest, size, length), max(floor, windows // size // 1_000_000 + 1)
    spans = settled[0].unionByName(settled[1]).unionByName(settled[2])
    before = Window.partitionBy("id", "mark").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("start") > reach, 1).when(reach.isNull(), 1).otherwise(0))
    spans = spans.withColumn("span", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy("id", "mark", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy("id", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _with_spans(docs: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """The documents, all columns, and the spans as last column (null: nothing repeated)."""
    id_, mark, spans_ = free_names(docs, "span_id", "span_mark", "span_list")
    spans = staged(repeated_spans(docs, length, doc_id, text), "spans").select(
        F.col("id").alias(id_), F.col("mark").alias(mark), F.col("spans").alias(spans_))
    on = (F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)) == F.col(id_)) & (F.hash(docs[text]).cast("long") == F.col(mark))
    return docs.join(small_side(spans, spans_), on, "left").drop(id_, mark)


def _kept(text: memoryview, spans: list[dict] | None) -> bytes:
    if not spans:
        return bytes(text)
    out, at = [], 0
    for s in spans:
        out.append(text[at:s["start"]])
        at = s["end"]
    out.append(text[at:])
    return b"".join(out)


def remove_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary) of every text."""
    work = _with_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), length, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = flat_texts(b.column(1))
            spans = b.column(2).to_pylist()
            kept = [_kept(memoryview(data[lo:hi]), s) for lo, hi, s in zip(offsets[:-1], offsets[1:], spans, strict=True)]
            n = np.diff(offsets)
            left = np.array([len(k) for k in kept], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(n - left), pa.array([len(s) if s else 0 for s in spans], pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = T.StructType([T.StructField("doc_id", work.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])
    return work.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, length: int, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents, all columns, their texts without repeated strings (a character that
    loses one of its bytes goes whole) and ``n_chars`` counted anew. Null texts stay null."""
    work = _with_spans(docs, length, doc_id, text)
    names = docs.columns
    at, count, last = names.index(text), names.index(n_chars), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols = list(b.columns)
            texts = b.column(at).to_pylist()
            for i, spans in enumerate(b.column(last).to_pylist()):
                if spans:
                    texts[i] = _kept(memoryview(texts[i].encode()), spans).decode("utf-8", "ignore")
            changed = pa.array([bool(s) for s in b.column(last).to_pylist()])
            lengths = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(cols[count].type)
            cols[at] = pa.array(texts, cols[at].type)
            cols[count] = pc.if_else(changed, lengths, cols[count])
            yield pa.RecordBatch.from_arrays(cols[:last], names=names)

    return work.mapInArrow(run, docs.schema)
