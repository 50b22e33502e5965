"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (1 to 3 bytes of
the lower-cased UTF-8 text; everything that isn't a letter is one blank). A text's own
most frequent n-grams are compared with each profile: an n-gram's distance is the
difference of its two ranks, or ``profile`` if the language doesn't list it. The
language with the smallest sum wins; ties go to the smaller name. The score is 1 minus
the sum over its largest possible value.

Profiles are counted over all training rows: each task counts its rows by language,
Spark adds the counts and ranks them. A profile has at most ``profile`` entries, so
what is broadcast is bounded by languages times ``profile``.

Defined cases: a null text, or one without a letter, gets ``und`` and score 0; training
rows without language don't train; without any training row all predictions are
``und``; repeated rows count and appear as often as they occur; other columns are
ignored; the empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, staged
from .hashing import chunks, flat_texts

BLANK = 0
#: Letters a-z are 1 to 26, bytes of other letters 27 to 154, all else is blank.
SYMBOL = np.zeros(256, dtype=np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:256] = np.arange(27, 155)
RADIX = 155
GRAMS = RADIX ** 3
PIECE = 1 << 18  # bytes of text handled at a time (about 100 bytes of arrays for each)


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of each text as codes below RADIX**3, with the text's number.

    A code's length shows in its size: no n-gram begins with a blank unless a letter
    follows, and blanks alone are left out.
    """
    n = len(offsets) - 1
    sym = SYMBOL[data]
    # one blank between texts, runs of blanks are one
    border = np.zeros(len(sym) + n + 1, dtype=np.int64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    at = np.arange(len(sym)) + owner + 1
    border[at] = sym
    who = np.zeros(len(border), dtype=np.int64)
    who[at] = owner
    blank = border == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the blank after a letter
    s, w = border[keep], who[keep]
    s = np.concatenate([[BLANK], s])
    w = np.concatenate([w[:1] if len(w) else [0], w])
    # a blank belongs to the text of the letter before it
    blanks = np.flatnonzero(s == BLANK)
    w[blanks[blanks > 0]] = w[blanks[blanks > 0] - 1]
    letter = s != BLANK
    one = letter
    two = np.zeros(len(s), dtype=bool)
    two[1:] = letter[1:] | letter[:-1]
    three = np.zeros(len(s), dtype=bool)
    three[2:] = letter[1:-1]
    c1 = s
    c2 = np.zeros(len(s), dtype=np.int64)
    c2[1:] = s[:-1] * RADIX + s[1:]
    c3 = np.zeros(len(s), dtype=np.int64)
    c3[2:] = s[:-2] * RADIX * RADIX + s[1:-1] * RADIX + s[2:]
    # the text of an n-gram is that of its letter
    own2 = w.copy()
    own3 = np.zeros(len(s), dtype=np.int64)
    own3[2:] = w[1:-1]
    return (np.concatenate([c1[one], c2[two], c3[three]]),
            np.concatenate([w[one], own2[two], own3[three]]))


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return flat_texts(pc.utf8_lower(column.cast(pa.large_string())))


def train_profiles(docs: DataFrame, profile: int = 400, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, code, rank (from 0) of each language's most frequent n-grams."""
    src = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in slices(batches):
            langs = np.asarray(b.column(0).to_pylist(), dtype=object)
            data, offsets = _lowered(b.column(1))
            for lo, hi, part, off in chunks(data, offsets, PIECE):
                codes, owners = gram_codes(part, off)
                for name in sorted(set(langs[lo:hi])):
                    mine = (langs[lo:hi] == name)[owners]
                    if name not in totals:
                        totals[name] = np.zeros(GRAMS, dtype=np.int32)
                    got, n = np.unique(codes[mine], return_counts=True)
                    totals[name][got] += n.astype(np.int32)
            if len(totals) > 16:  # many languages: hand over what is counted so far
                yield from rows(totals)
                totals = {}
        yield from rows(totals)

    def rows(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at].astype(np.int64))],
                names=["lang", "code", "n"])

    counted = src.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counted = staged(counted, "grams")
    # at most RADIX**3 codes for a language, whatever the size of the data
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return counted.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < profile).select("lang", "code", "rank")


class Profiles:
    """The ranks of all languages in one table by n-gram code; -1 is not listed."""

    def __init__(self, rows: list[tuple[str, int, int]], profile: int):
        self.names = sorted({r[0] for r in rows})
        self.profile = profile
        self.ranks = np.full((GRAMS, max(1, len(self.names))), -1, dtype=np.int16)
        index = {n: i for i, n in enumerate(self.names)}
        for name, code, rank in rows:
            self.ranks[code, index[name]] = rank

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language (-1: none) and score of each lower-cased text."""
        n = len(offsets) - 1
        best, score = np.full(n, -1, dtype=np.int64), np.zeros(n)
        codes, owners = gram_codes(data, offsets)
        if not len(codes) or not self.names:
            return best, score
        keys, count = np.unique(owners * GRAMS + codes, return_counts=True)
        owner, code = keys // GRAMS, keys % GRAMS
        order = np.lexsort((code, -count, owner))  # most frequent first, then by code
        owner, code = owner[order], code[order]
        first = np.searchsorted(owner, np.arange(n))
        rank = np.arange(len(owner)) - first[owner]
        top = rank < self.profile
        owner, code, rank = owner[top], code[top], rank[top]
        listed = self.ranks[code]
        apart = np.where(listed < 0, self.profile, np.abs(listed - rank[:, None]))
        heads = np.searchsorted(owner, np.arange(n))
        some = np.bincount(owner, minlength=n) > 0
        sums = np.zeros((n, listed.shape[1]))
        sums[some] = np.add.reduceat(apart, heads[some], axis=0)
        got = np.bincount(owner, minlength=n)
        best[some] = np.argmin(sums[some], axis=1)
        score[some] = 1 - sums[some].min(axis=1) / (got[some] * self.profile)
        return best, score


def predict_batch(model: Profiles, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """lang_pred and score of one Arrow column of texts."""
    text = column.cast(pa.large_string())
    has = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
    data, offsets = _lowered(text)
    best, score = np.full(len(text), -1, dtype=np.int64), np.zeros(len(text))
    for lo, hi, part, off in chunks(data, offsets, PIECE):
        best[lo:hi], score[lo:hi] = model.predict(part, off)
    best[~has], score[best < 0] = -1, 0.0
    score[~has] = 0.0
    return [model.names[i] if i >= 0 else "und" for i in best.tolist()], np.clip(score, 0.0, 1.0)


def broadcast_profiles(profiles: DataFrame, profile: int = 400, max_langs: int = 2000):
    """Profiles as a broadcast of at most ``max_langs * profile`` entries."""
    rows = profiles.limit(max_langs * profile + 1).collect()
    if len(rows) > max_langs * profile:
        raise ValueError(f"more than {max_langs} languages")
    return profiles.sparkSession.sparkContext.broadcast([(r["lang"], int(r["code"]), int(r["rank"])) for r in rows])



def identify(docs: DataFrame, profiles: DataFrame, profile: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""
    shared = broadcast_profiles(profiles, profile)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(shared.value, profile)
        for b in slices(batches):
            names, score = predict_batch(model, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return src.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, profiles: DataFrame, least_score: float = 0.0, profile: int = 400,
                    text: str = "text") -> DataFrame:
    """Documents, all columns, whose language is identified with at least ``least_score``."""
    shared = broadcast_profiles(profiles, profile)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(shared.value, profile)
        for b in slices(batches):
            names, score = predict_batch(model, b.column(at))
            keep = [x != "und" and s >= least_score for x, s in zip(names, score, strict=True)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
