"""Audit of how far the sources of a language are from each other, by in-mapper stripes.

A partition folds whole documents into hash stripes, term -> (document frequency, count in
each source), and emits them whenever they hold ``CELLS`` counts and at its end. Spark merges
the stripes by key: first each (language, term, source), so that a term every partition
has is split over the sources' tasks and no task meets more than one partial count of each
partition, then each (language, term), which has one entry a source at most. Terms in too few
documents go. The merged stripes emit the divergences:

* for each pair of sources the sum over all kept terms. A stripe adds the cells it has, against
  all sources; what a pair has for a term that neither source uses is the same for all
  such terms and is added once for all of them. A task keeps sums, not terms;
* for each source the terms that it uses more than its language does, by a join with the
  totals, ranked per source after a limit in every task before the shuffle.

With n occurrences of N, and V kept terms, a probability is the whole number
``1 + floor(10**9 * (n + 1) / (N + V))``, taken by long division in base 1000, exact while
N + V is below 9 * 10**15.

Defined cases: null text, language and source are ''; a text without a term gives its
(language, source) a group without counts; a language without a kept term gives pairs of value 0
and no term rows; a single source has no pairs; repeated rows count as often as they
stand; the empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, small_side, staged
from .hashing import flat_texts

ONE = 1_000_000_000
CELLS = 400_000  # counts a task folds before it emits them
SPACE = 1 << 20  # numbers a task computes at a time, and twice as many it sums up

#: Bytes of a term (letters A to Z in lower case, and everything beyond ASCII); others part terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _stripes(lang: str, folded: dict[str, tuple[Counter, Counter]]) -> pa.RecordBatch:
    """One row for each term of a language: df and its counts by source."""
    sources = list(folded)
    sizes = [len(n) for n, _ in folded.values()]
    terms = pa.concat_arrays([pa.array(list(n), pa.binary()) for n, _ in folded.values()])
    counts = np.concatenate([np.fromiter(n.values(), np.int64, len(n)) for n, _ in folded.values()])
    docs = np.concatenate([np.fromiter(map(d.__getitem__, n), np.int64, len(n)) for n, d in folded.values()])
    coded = terms.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    heads = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))]).astype(np.int32)
    source = pa.array(sources, pa.string()).take(pa.array(np.repeat(np.arange(len(sources)), sizes)[order]))
    cells = pa.StructArray.from_arrays([source, pa.array(counts[order])], ["source", "n"])
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(heads) - 1, np.int64))), coded.dictionary,
         pa.array(np.add.reduceat(docs[order], heads[:-1])), pa.ListArray.from_arrays(pa.array(heads), cells)],
        names=["lang", "term", "df", "cells"])


def fold_stripes(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """lang, term, df, cells: the partial stripes of all partitions (columns lang, source, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, tuple[Counter, Counter]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, folded in held.items():
                b = _stripes(lang, folded)
                yield from (b.slice(lo, 20_000) for lo in range(0, b.num_rows, 20_000))
            held.clear()

        for b in slices(batches):
            data, offsets = flat_texts(b.column(2))
            plain = data.tobytes().translate(TERM_BYTES)
            for i, (lang, source) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                words = plain[offsets[i]:offsets[i + 1]].split()
                if not words:
                    continue
                n, d = held.setdefault(lang, {}).setdefault(source, (Counter(), Counter()))
                before = len(n)
                n.update(words)
                d.update(set(words))
                size += len(n) - before
                if size >= cells:
                    yield from out()
                    size = 0
        yield from out()

    return docs.mapInArrow(run, "lang string, term binary, df long, cells array<struct<source: string, n: long>>")


def merge_stripes(partial: DataFrame, least_docs: int) -> DataFrame:
    """The merged stripes of the terms that stand in ``least_docs`` documents or more."""
    flat = partial.select("lang", "term", "df", F.posexplode("cells").alias("at", "cell")).groupBy(
        "lang", "term", "cell.source").agg(F.sum("cell.n").alias("n"), F.sum(F.when(F.col("at") == 0, F.col("df")).otherwise(0)).alias("df"))
    return flat.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("cells")).where(
        F.col("df") >= least_docs)


def probability(n: str, total: str, terms: str) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + terms)) of three columns, by long division."""
    rest, value = f"({n} + 1)", f"(({n} + 1) div ({total} + {terms}))"
    for _ in range(3):
        rest = f"(({rest} % ({total} + {terms})) * 1000)"
        value = f"({value} * 1000 + {rest} div ({total} + {terms}))"
    return F.expr(f"1 + {value}")


def apart(p: str, q: str) -> Column:
    """floor((p - q)**2 / q) of two columns of probabilities."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _probabilities(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (n + 1) / total), ``total`` with the kept terms in it."""
    value, rest = np.divmod(n + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        value = value * 1000 + digit
    return value + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _add(sums: dict, key: tuple, owner: np.ndarray, values: np.ndarray) -> None:
    """Add the rows of ``values`` to the sums of their owners."""
    order = np.argsort(owner, kind="stable")
    at = np.flatnonzero(np.diff(owner[order], prepend=-1))
    for i, row in zip(owner[order][at].tolist(), np.add.reduceat(values[order], at, axis=0), strict=True):
        k = (*key, i)
        sums[k] = sums[k] + row if k in sums else row


def _pair_sums(work: DataFrame) -> DataFrame:
    """lang, flipped, source number, sums: over the stripes of a task, how far the pairs are
    apart beyond what two unused terms are. From (lang, v, totals, at, n) of each stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = list(sums.items())
            for lo in range(0, len(rows), 1000):
                part = rows[lo:lo + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.bool_()),
                     pa.array([k[2] for k, _ in part], pa.int32()), pa.array([v for _, v in part], pa.list_(pa.int64()))],
                    names=["lang", "flipped", "i", "sums"])
            sums.clear()

        for b in batches:
            langs = b.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = b.take(pa.array(np.flatnonzero(langs.indices.to_numpy() == code)))
                totals = mine.column(2)[0].values.to_numpy(zero_copy_only=False) + mine.column(1)[0].as_py()
                sources = len(totals)
                unused = _probabilities(np.zeros(sources, np.int64), totals)
                step = max(1, SPACE // sources)
                for lo in range(0, mine.num_rows, step):
                    part = mine.slice(lo, step)
                    at = part.column(3).flatten().to_numpy(zero_copy_only=False)
                    n = part.column(4).flatten().to_numpy(zero_copy_only=False)
                    term = np.repeat(np.arange(part.num_rows), part.column(3).value_lengths().to_numpy(zero_copy_only=False))
                    p = _probabilities(n, totals[at])
                    every = np.tile(unused, (part.num_rows, 1))
                    every[term, at] = p
                    used = np.zeros((part.num_rows, sources), bool)
                    used[term, at] = True
                    for c in range(0, len(at), step):
                        a, t, own = at[c:c + step], term[c:c + step], p[c:c + step, None]
                        rest = unused[a][:, None]
                        _add(sums, (lang, False), a, _apart(own, every[t]) - _apart(rest, unused[None, :]))
                        # the other way round where the other source doesn't use the term
                        back = _apart(unused[None, :], own) - _apart(unused[None, :], rest)
                        _add(sums, (lang, True), a, np.where(used[t], 0, back))
                    if sum(map(len, sums.values())) > 2 * SPACE:
                        yield from out()
        yield from out()

    return work.mapInArrow(run, "lang string, flipped boolean, i int, sums array<long>")


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, lang: str = "lang", source: str = "source",
          text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` has all other sources of the language,
    part `term` the ``top`` terms of the source that it uses more than its language."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = staged(merge_stripes(fold_stripes(plain), least_docs), "stripes")
    cells = kept.select("lang", "term", F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c["n"]).alias("n_lang"),
                        F.explode("cells").alias("cell")).select("lang", "term", "n_lang", "cell.source", "cell.n")
    # groups: their number is below that of the result's rows
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
    groups = staged(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    by_lang = groups.groupBy("lang", "v").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("of"))
    by_lang = staged(by_lang.select("lang", "v", F.col("of.source").alias("sources"), F.col("of.total").alias("totals"),
                                    F.aggregate("of", F.lit(0).cast("long"), lambda s, x: s + x["total"]).alias("total_lang")), "langs")

    work = kept.join(small_side(by_lang, "sources"), "lang").select(
        "lang", "v", "totals", F.transform("cells", lambda c: F.array_position("sources", c["source"]).cast("int") - 1).alias("at"),
        F.transform("cells", lambda c: c["n"]).alias("n"))
    sums = staged(_pair_sums(work), "pair-sums")
    sums = sums.select("lang", "flipped", "i", F.posexplode("sums").alias("j", "x")).groupBy(
        "lang", F.when(F.col("flipped"), F.col("j")).otherwise(F.col("i")).alias("a"),
        F.when(F.col("flipped"), F.col("i")).otherwise(F.col("j")).alias("b")).agg(F.sum("x").alias("x"))

    def numbered(name: str) -> DataFrame:
        return by_lang.select("lang", "v", F.posexplode(F.arrays_zip("sources", "totals")).alias(name, "g")).select(
            "lang", "v", name, F.col("g.sources").alias(f"source_{name}"), F.col("g.totals").alias(f"total_{name}"))

    pairs = numbered("a").join(numbered("b").drop("v"), "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    # without a kept term v is 0 and so is the value
    pairs = pairs.withColumn("zero", F.lit(0).cast("long")).withColumn("v1", F.greatest("v", F.lit(1)))
    pairs = pairs.withColumn("p", probability("zero", "total_a", "v1")).withColumn("q", probability("zero", "total_b", "v1")).withColumn(
        "value", F.col("v") * apart("p", "q") + F.coalesce("x", F.lit(0)))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", F.col("source_a").alias("source"), F.lit("pair").alias("part"), F.col("source_b").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    known = staged(groups.join(by_lang.select("lang", "total_lang"), "lang"), "known")
    used = cells.join(small_side(known), ["lang", "source"])
    used = used.withColumn("p", probability("n", "total", "v")).withColumn("q", probability("n_lang", "total_lang", "v")).where("p > q")
    used = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), apart("p", "q").alias("value"))
    used = used.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(used)
