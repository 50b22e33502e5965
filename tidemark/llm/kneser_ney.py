"""Interpolated modified Kneser-Ney bigram model over whole texts.

Tokens are the words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, then one end. Counting runs in
Spark: a task counts its texts and hands over sorted, compressed runs of (key, count),
split by key range; one task merges each range and writes it as sorted arrays into the
shared folder. Workers map these files and look tokens up by binary search, so neither
the driver nor a worker holds the model. Each range is a task of its own. What says where a
range begins, which words are spread and which ranges hold anything is mapped too: the driver
computes these arrays (some 70 bytes a range), and no task's closure grows with the text.

* vocabulary: 64-bit token hashes, ascending, in ranges of their top bits, with counts;
  a token's number is its rank;
* bigrams: (number of the word before) * 2**32 + (number of the word), ascending, with
  counts, in ranges of the word before. Words before that make up more than a range's
  share (at most 4 times as many as there are ranges) are spread over further ranges;
* by token number: continuation count, sum of counts as context and weight left to the
  lower order.

P(w|u) = max(c(uw) - D, 0) / c(u) + g(u) P(w), P(w) = max(n(w) - D', 0) / n + g' / (V + 1), where
n(w) is the number of different words before w, and D, D' are the three discounts from
the counts of counts at each order. A token outside the vocabulary has n(w) = 0; after a
context that training hasn't seen, P(w|u) = P(w).

Defined cases: a null or empty text is one end token; a text that repeats counts as
often; without training texts every probability is 1 / (V + 1) = 1; other columns are
ignored; the empty table gives no rows. More than 2**32 - 1 different tokens raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_dir, staged
from .hashing import chunks, flat_texts, token_hashes
from .shared_files import mapped, pack, put, unpack

END = np.uint64(1)
RANGE_BYTES = 32 << 20  # text bytes whose tokens one range takes, about
FLUSH = 6_000_000  # counted keys that a task holds at most


@dataclass(frozen=True)
class Model:
    """Where the arrays lie and the few numbers that every task needs."""

    folder: str
    bits: int  # 2**bits ranges
    size: int  # V
    tokens: int  # N
    discounts: tuple[float, float, float]
    lower_discounts: tuple[float, float, float]
    lower_total: int  # different bigrams
    lower_rest: float  # g'
    start_total: int
    start_rest: float

    @property
    def hot(self) -> np.ndarray:
        return _spread(self.folder)


def _offsets(folder: str) -> np.ndarray:
    """First token number of each vocabulary range, then V."""
    return mapped(f"{folder}/offsets", np.int64)


def _spread(folder: str) -> np.ndarray:
    """Numbers of the words before that are spread, ascending; the start is one of them."""
    return mapped(f"{folder}/spread", np.int64)


def _runs_of(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(range, first, end) of each run of equal range numbers."""
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])).tolist() if len(part) else []
    for lo, hi in zip(cut, cut[1:], strict=False):
        yield int(part[lo]), lo, hi


def _range_of_number(offsets: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Vocabulary range of each token number; the start, V, is beyond the last one."""
    return np.searchsorted(offsets, numbers, side="right") - 1


def _numbered(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, token hashes with the ends put in, tokens per text)."""
    data, offsets = flat_texts(texts)
    for lo, hi, part, off in chunks(data, offsets):
        words, n = token_hashes(part, off)
        out = np.empty(len(words) + len(n), dtype=np.uint64)
        last = np.cumsum(n + 1) - 1
        inner = np.ones(len(out), dtype=bool)
        inner[last] = False
        out[inner] = words
        out[last] = END
        yield lo, hi, out, n + 1


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _counted(batches: Iterator[pa.RecordBatch], keys_of: Callable, range_of: Callable) -> Iterator[pa.RecordBatch]:
    """Counts keys of all texts of a task and yields one packed run for each range."""
    keys, counts, held = [], [], 0

    def runs() -> Iterator[pa.RecordBatch]:
        k, c = _merge(keys, counts)
        part = range_of(k)
        order = np.argsort(part, kind="stable")
        k, c, part = k[order], c[order], part[order]
        for p, lo, hi in _runs_of(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([pack(k[lo:hi], True)], pa.binary()),
                 pa.array([pack(c[lo:hi])], pa.binary())], names=["part", "keys", "counts"])

    for b in batches:
        for _, _, tokens, n in _numbered(b.column(0)):
            k, c = np.unique(keys_of(tokens, n), return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > FLUSH:
                k, c = _merge(keys, counts)
                keys, counts, held = [k], [c], len(k)
                if held > FLUSH // 2:
                    yield from runs()
                    keys, counts, held = [], [], 0
    if held:
        yield from runs()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, keys, counts) of each range whose runs this task was dealt."""
    parts: dict[int, tuple[list, list]] = {}
    for b in batches:
        for part, k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            got = parts.setdefault(part, ([], []))
            got[0].append(unpack(k, True))
            got[1].append(unpack(c))
    for part in sorted(parts):
        keys, counts = parts.pop(part)
        yield (part, *_merge(keys, counts))


RUN = "part int, keys binary, counts binary"


class _Vocabulary:
    """Token numbers from the mapped ranges."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits, self.offsets = folder, bits, _offsets(folder)

    def numbers(self, ascending: np.ndarray) -> np.ndarray:
        """Numbers of ascending token hashes; -1 for unknown ones."""
        out = np.full(len(ascending), -1, dtype=np.int64)
        part = (ascending >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(ascending), np.int64)
        for p, lo, hi in _runs_of(part):
            if self.offsets[p + 1] == self.offsets[p]:
                continue
            have, ask = mapped(f"{self.folder}/vocabulary-{p}", np.uint64), ascending[lo:hi]
            at = np.searchsorted(have, ask)
            at[at == len(have)] = 0
            out[lo:hi] = np.where(have[at] == ask, at + self.offsets[p], -1)
        return out

    def column(self, name: str, dtype, numbers: np.ndarray) -> np.ndarray:
        """Values by token number (ascending, none negative)."""
        out = np.zeros(len(numbers), dtype=dtype)
        for p, lo, hi in _runs_of(_range_of_number(self.offsets, numbers)):
            out[lo:hi] = mapped(f"{self.folder}/{name}-{p}", dtype)[numbers[lo:hi] - self.offsets[p]]
        return out


def _bigram_range(before: np.ndarray, keys: np.ndarray, bits: int, size: int, hot: np.ndarray) -> np.ndarray:
    """Range of a bigram: by the word before, or by its own hash if that word is spread."""
    ranges = 1 << bits
    out = (before * ranges // (size + 1)).astype(np.int64)
    spread = hot[np.minimum(np.searchsorted(hot, before), len(hot) - 1)] == before
    if spread.any():
        mixed = keys[spread] * np.uint64(0x9E3779B97F4A7C15)
        out[spread] = ranges + (mixed >> np.uint64(64 - bits)).astype(np.int64) if bits else ranges
    return out


def _before(numbers: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The word before each token; at a text's begin the start, numbered V."""
    before = np.concatenate([[size], numbers[:-1]]) if len(numbers) else numbers
    before[np.cumsum(n)[:-1]] = size
    return before


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; where one is missing, or an
    estimate leaves (0, count), 0.5, 1 and 1.5."""
    plain = (0.5, 1.0, 1.5)
    if min(n1, n2, n3, n4) <= 0:
        return plain
    y = n1 / (n1 + 2 * n2)
    got = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return got if all(0 < d < i + 1 for i, d in enumerate(got)) else plain


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all rows of ``docs`` and write the model into the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("text"))
    folder = stage_dir(spark, "kneser-ney")
    size_bytes, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    bits = max(0, int(np.ceil(np.log2(max(1, size_bytes / RANGE_BYTES)))))
    ranges = 1 << bits
    much = max(1000, (size_bytes + rows) // (8 * ranges))  # at most N / much <= 4 * ranges tokens are that frequent

    def hashes(batches):
        def part(k):
            return (k >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64)
        yield from _counted(batches, lambda tokens, n: tokens, part)

    def write_vocabulary(batches):
        for part, keys, counts in _gathered(batches):
            put(f"{folder}/vocabulary-{part}", keys)
            put(f"{folder}/count-{part}", counts)
            hot = np.flatnonzero(counts > much)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
                 pa.array([hot.tolist()], pa.list_(pa.int64()))], names=["part", "size", "tokens", "hot"])

    runs = texts.mapInArrow(hashes, RUN).repartitionById(ranges, F.col("part"))
    made = staged(runs.mapInArrow(write_vocabulary, "part long, size long, tokens long, hot array<long>"), "vocabulary")
    one = made.select("part", "size", "tokens").toArrow()  # a row for each range
    many = made.select("part", F.explode("hot").alias("at")).toArrow()  # at most 4 for each
    sizes = np.zeros(ranges, np.int64)
    sizes[one["part"].to_numpy()] = one["size"].to_numpy()
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    size, tokens = int(offsets[-1]), int(one["tokens"].to_numpy().sum())
    if size >= 2**32 - 1:
        raise ValueError("more than 2**32 - 1 different tokens")
    put(f"{folder}/offsets", offsets)
    put(f"{folder}/spread", np.sort(np.append(offsets[many["part"].to_numpy()] + many["at"].to_numpy(), size)).astype(np.int64))
    del sizes, offsets, one, many  # tasks map the files

    def bigrams(batches):
        known, spread = _Vocabulary(folder, bits), _spread(folder)

        def keys_of(found, n):
            distinct, back = np.unique(found, return_inverse=True)
            numbers = known.numbers(distinct)[back]
            return (_before(numbers, n, size).astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64)

        def range_of(keys):
            return _bigram_range((keys >> np.uint64(32)).astype(np.int64), keys, bits, size, spread)

        yield from _counted(batches, keys_of, range_of)

    def by_number(kind: str, numbers: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for p, lo, hi in _runs_of(_range_of_number(_offsets(folder), numbers)):
            if p == ranges:  # the start
                yield stat("start", 0, [], [int(c[-1]) for c in columns])
            else:
                yield stat(kind, p, [pack(numbers[lo:hi], True), *(pack(c[lo:hi]) for c in columns)], [0] * 4)

    def stat(kind: str, part: int, blobs: list[bytes], n: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.string()), pa.array([part], pa.int32()), pa.array([blobs], pa.list_(pa.binary())),
             *(pa.array([x], pa.int64()) for x in n)], names=["kind", "part", "blobs", "n1", "n2", "n3", "n4"])

    def write_bigrams(batches):
        for part, keys, counts in _gathered(batches):
            put(f"{folder}/bigram-{part}", keys)
            put(f"{folder}/bigram-count-{part}", counts.astype(np.uint32))
            yield stat("total", part, [], [int((counts == i).sum()) for i in (1, 2, 3, 4)])
            before, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
            add = [np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts > 2)]
            yield from by_number("context", before[first], add)
            word, n = np.unique(word, return_counts=True)
            yield from by_number("word", word, [n])

    found = texts.mapInArrow(bigrams, RUN).repartitionById(2 * ranges, F.col("part"))
    stats = staged(found.mapInArrow(
        write_bigrams, "kind string, part int, blobs array<binary>, n1 long, n2 long, n3 long, n4 long"), "bigrams")
    cc = {r["kind"]: r for r in stats.where("kind in ('total', 'start')").groupBy("kind").agg(
        *(F.sum(f"n{i}").alias(f"n{i}") for i in (1, 2, 3, 4))).collect()}
    filled = np.zeros(2 * ranges, bool)
    filled[stats.where("kind = 'total'").select("part").toArrow()["part"].to_numpy()] = True  # one row a range
    put(f"{folder}/filled", filled)
    del filled
    d = discounts(*(cc["total"][f"n{i}"] for i in (1, 2, 3, 4))) if "total" in cc else (0.5, 1.0, 1.5)

    def rest(total, n1, n2, n3):
        return np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / np.maximum(total, 1), 1.0)

    def write_numbers(batches):
        offsets, parts = _offsets(folder), {}
        for b in batches:
            for kind, part, blobs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                have = parts.setdefault(part, [np.zeros(offsets[part + 1] - offsets[part], np.int64) for _ in range(5)])
                at = unpack(blobs[0], True).astype(np.int64) - offsets[part]
                for i, blob in enumerate(blobs[1:]):
                    np.add.at(have[4 if kind == "word" else i], at, unpack(blob).astype(np.int64))
        for part, (total, n1, n2, n3, word) in sorted(parts.items()):
            put(f"{folder}/total-{part}", total)
            put(f"{folder}/rest-{part}", rest(total, n1, n2, n3))
            put(f"{folder}/follows-{part}", word)
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (
                word.sum(), *((word == i).sum() for i in (1, 2, 3, 4)), (word > 2).sum())],
                names=["total", "n1", "n2", "n3", "n4", "more"])

    low = staged(stats.where("kind in ('context', 'word')").select("kind", "part", "blobs").repartitionById(ranges, F.col("part")).mapInArrow(
        write_numbers, "total long, n1 long, n2 long, n3 long, n4 long, more long"), "numbers").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "n1", "n2", "n3", "n4", "more"))).first()
    e = discounts(low["n1"], low["n2"], low["n3"], low["n4"])
    lower_rest = (e[0] * low["n1"] + e[1] * low["n2"] + e[2] * low["more"]) / low["total"] if low["total"] else 1.0
    start = [cc["start"][f"n{i}"] for i in (1, 2, 3, 4)] if "start" in cc else [0, 0, 0, 0]
    return Model(folder, bits, size, tokens, d, e, low["total"], lower_rest,
                 start[0], float(rest(*(np.asarray(x) for x in start))))


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.asarray([0.0, *d])[np.minimum(counts, 3)]


def _scores(m: Model, tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known tokens, base score, model score) of each text."""
    known, filled = _Vocabulary(m.folder, m.bits), mapped(f"{m.folder}/filled", np.bool_)
    distinct, back = np.unique(tokens, return_inverse=True)
    numbers = known.numbers(distinct)
    got = numbers >= 0
    count, follows, total = (np.zeros(len(distinct), np.int64) for _ in range(3))
    rest = np.ones(len(distinct))
    # numbers ascend with the hashes
    count[got] = known.column("count", np.int64, numbers[got])
    follows[got] = known.column("follows", np.int64, numbers[got])
    total[got] = known.column("total", np.int64, numbers[got])
    rest[got] = known.column("rest", np.float64, numbers[got])
    base = np.log10((count + 1) / (m.tokens + 1 * (m.size + 1)))
    low = (follows - _discount(follows, m.lower_discounts)) / max(1, m.lower_total) + m.lower_rest / (m.size + 1)

    number = numbers[back]
    before = _before(number, n, m.size)
    pair = np.flatnonzero((number >= 0) & (before >= 0))
    keys, where = np.unique((before[pair].astype(np.uint64) << np.uint64(32)) | number[pair].astype(np.uint64), return_inverse=True)
    seen = np.zeros(len(keys), dtype=np.int64)
    part = _bigram_range((keys >> np.uint64(32)).astype(np.int64), keys, m.bits, m.size, _spread(m.folder))
    order = np.argsort(part, kind="stable")
    for p, lo, hi in _runs_of(part[order]):
        at = order[lo:hi]
        if not filled[p]:
            continue
        have = mapped(f"{m.folder}/bigram-{p}", np.uint64)
        spot = np.searchsorted(have, keys[at])
        spot[spot == len(have)] = 0
        hit = have[spot] == keys[at]
        seen[at[hit]] = mapped(f"{m.folder}/bigram-count-{p}", np.uint32)[spot[hit]]
    both = np.zeros(len(tokens), dtype=np.int64)
    both[pair] = seen[where]
    ctx_total = np.concatenate([[0], total[back][:-1]])
    ctx_rest = np.concatenate([[1.0], rest[back][:-1]])
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    ctx_total[first], ctx_rest[first] = m.start_total, m.start_rest
    p = ctx_rest * low[back]
    p = np.where(ctx_total > 0, (both - _discount(both, m.discounts)) / np.maximum(ctx_total, 1) + p, low[back])
    owner = np.repeat(np.arange(len(n)), n)
    k = len(n)
    return (np.bincount(owner, weights=got[back], minlength=k).astype(np.int64),
            np.bincount(owner, weights=base[back], minlength=k), np.bincount(owner, weights=np.log10(p), minlength=k))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity of every text."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, tokens, n in _numbered(b.column(1)):
                got, base, full = _scores(model, tokens, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n), pa.array(got), pa.array(np.full(len(n), model.tokens)),
                     pa.array(base), pa.array(full), pa.array(10.0 ** (-full / n))],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType), *(
        T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")), *(
        T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "perplexity"))])
    return src.mapInArrow(run, schema)
