"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

Each paragraph (line) is hashed into a wide vector of integers; a text's fingerprint is the
sum of its paragraphs' vectors modulo powers of two. So the order of paragraphs doesn't
matter, and a paragraph is put in or taken out by adding or subtracting its vector
(`add`, `subtract`). A paragraph's vector has two parts:

* ``EQUAL`` lanes modulo 2**32 from a 128-bit hash of the whole paragraph: they tell
  whether two multisets of paragraphs are equal;
* ``LIKE`` lanes that count, over the 3-word shingles of the paragraph, how often a random
  bit is set, two counts to a 64-bit word. Read as sums of +1 and -1 they are a
  tug-of-war sketch: the mean squared difference of two sketches estimates the size of the
  multiset difference, whence `likeness`.

Defined cases: a null text is empty, and an empty text is one empty paragraph; rows that
repeat (doc_id, text) are one document, whose result each of them gets; rows that share a doc_id with other texts are
documents of their own, ordered by text hash; a null doc_id comes last in descending
order; a single document follows itself; the empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

EQUAL = 8
LIKE = 62  # 64-bit words, two counters each
NO_ID = -(2 ** 63)
LOW = 0xFFFFFFFF


def _like_words(h: Column, g: Column) -> list[Column]:
    """62 words with one bit of the hashes h and g in the lowest place of each half."""
    return [F.shiftrightunsigned(x, i).bitwiseAND(F.lit((1 << 32) | 1)) for x in (h, g) for i in range(31)]


def text_vectors(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n (shingles), e0.. and l0..: the sums over the paragraphs of column ``text``.

    One row for each distinct key. If the frame is partitioned by the keys (a join before),
    the sums need no exchange.
    """
    paragraphs = texts.select(*keys, F.explode(F.split("text", "\n")).alias("p"))
    # a shingle at each word; at a paragraph's end it is shorter (get() gives null there)
    words = paragraphs.select(
        *keys, F.xxhash64("p").alias("p1"), F.xxhash64(F.lit(7), F.col("p")).alias("p2"), F.split("p", " ").alias("w"))
    shingle = F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    units = words.select(*keys, "p1", "p2", F.posexplode(shingle).alias("at", "unit"))
    equal = [F.sum(F.when(F.col("at") == 0, F.xxhash64("p1", "p2", F.lit(i)).bitwiseAND(F.lit(LOW))).otherwise(F.lit(0)))
             .bitwiseAND(F.lit(LOW)).alias(f"e{i}") for i in range(EQUAL)]
    second = F.xxhash64("unit", F.lit(3))
    like = [F.sum(x).alias(f"l{i}") for i, x in enumerate(_like_words(F.col("unit"), second))]
    return units.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *equal, *like)


def vector(prefix: str = "") -> Column:
    """The columns of `text_vectors` as one struct n, e, l."""
    return F.struct(F.col(f"{prefix}n").alias("n"), F.array(*(F.col(f"{prefix}e{i}") for i in range(EQUAL))).alias("e"),
                    F.array(*(F.col(f"{prefix}l{i}") for i in range(LIKE))).alias("l"))


def add(a: Column, b: Column) -> Column:
    """Fingerprint vector of two multisets put together."""
    return F.struct((a["n"] + b["n"]).alias("n"),
                    F.zip_with(a["e"], b["e"], lambda x, y: (x + y).bitwiseAND(F.lit(LOW))).alias("e"),
                    F.zip_with(a["l"], b["l"], lambda x, y: x + y).alias("l"))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint vector with the paragraphs of ``b`` taken out of ``a``."""
    return F.struct((a["n"] - b["n"]).alias("n"),
                    F.zip_with(a["e"], b["e"], lambda x, y: (x - y).bitwiseAND(F.lit(LOW))).alias("e"),
                    F.zip_with(a["l"], b["l"], lambda x, y: x - y).alias("l"))


def as_text(v: Column) -> Column:
    """Fingerprint as hexadecimal text: the equality lanes, a colon, the counters."""
    return F.concat(F.concat_ws("", F.transform(v["e"], lambda x: F.lpad(F.hex(x), 8, "0"))), F.lit(":"),
                    F.concat_ws("", F.transform(v["l"], lambda x: F.lpad(F.hex(x), 16, "0"))))


def _signed_square(n: Column, word: Column) -> Column:
    """Sum of the squares of a word's two counters, read as sums of +1 and -1."""
    low = F.lit(2) * word.bitwiseAND(F.lit(LOW)) - n
    high = F.lit(2) * F.shiftrightunsigned(word, 32) - n
    return (low * low + high * high).cast("double")


def likeness(a: Column, b: Column) -> Column:
    """1 - |a - b|**2 / (|a|**2 + |b|**2) of two fingerprint vectors, within 0 and 1;
    exactly 1 for equal vectors."""
    def total(n: Column, words: Column) -> Column:
        return F.aggregate(words, F.lit(0.0), lambda s, w: s + _signed_square(n, w))

    def apart() -> Column:
        def square(x: Column, y: Column) -> Column:
            low = F.lit(2) * (x.bitwiseAND(F.lit(LOW)) - y.bitwiseAND(F.lit(LOW))) - (a["n"] - b["n"])
            high = F.lit(2) * (F.shiftrightunsigned(x, 32) - F.shiftrightunsigned(y, 32)) - (a["n"] - b["n"])
            return (low * low + high * high).cast("double")
        return F.aggregate(F.zip_with(a["l"], b["l"], square), F.lit(0.0), lambda s, w: s + w)

    both = total(a["n"], a["l"]) + total(b["n"], b["l"])
    value = F.when(both > 0, F.lit(1.0) - apart() / both).otherwise(F.lit(1.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def followers(docs: DataFrame) -> DataFrame:
    """id, h, n, copies (rows) and the document that follows in descending (id, h): next_id, next_h.

    Range partitions give the order; a partition's last document is followed by the first
    of the next partition (one row for each partition meets in one task), the last of all
    by the first.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.groupBy("id", "h").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    ranged = staged(ids.repartitionByRange(n, F.desc("id"), F.desc("h")).withColumn("part", F.spark_partition_id()), "order")
    down = Window.partitionBy("part").orderBy(F.desc("id"), F.desc("h"))
    inner = ranged.withColumn("next", F.lead(F.struct("id", "h")).over(down))
    first = ranged.groupBy("part").agg(F.max(F.struct("id", "h")).alias("first"))
    by_part = Window.orderBy("part")
    border = first.select(F.col("part").alias("p"), F.coalesce(
        F.lead("first").over(by_part), F.first("first").over(by_part.rowsBetween(Window.unboundedPreceding, 0))).alias("border"))
    return inner.join(F.broadcast(border), F.col("part") == F.col("p")).withColumn(
        "next", F.coalesce("next", "border")).select(
        "id", "h", "n", "copies", F.col("next.id").alias("next_id"), F.col("next.h").alias("next_h"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as
    many (or all) of the document that follows.
    """
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("h"), "text")
    order = staged(followers(texts.select("id", "h", F.char_length("text").alias("n"))), "followers")

    # only the part of the next text that is needed travels to the document it edits
    asked = order.select(F.col("next_id").alias("id"), F.col("next_h").alias("h"), F.col("id").alias("to_id"),
                         F.col("h").alias("to_h"), F.floor(F.col("n") / 3).cast("int").alias("cut"))
    sent = texts.join(asked, ["id", "h"]).select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), F.substring("text", F.lit(1), F.col("cut")).alias("tail"))
    sent = sent.groupBy("id", "h").agg(F.first("tail").alias("tail"))
    n = F.char_length("text")
    # repeated rows are one document: their paragraphs count once (the join has dealt and sorted by the keys)
    once = texts.join(sent, ["id", "h"]).groupBy("id", "h").agg(F.first("text").alias("text"), F.first("tail").alias("tail"))
    edited = once.withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), F.col("tail")))

    both = edited.select("id", "h", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text"), F.lit(None).cast("string").alias("sha")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text"), F.sha2("edited", 256).alias("sha")))).alias("v"))
    both = both.select("id", "h", "v.which", "v.sha", "v.text")
    sums = text_vectors(both, ["id", "h", "which", "sha"]).select("id", "h", "which", "sha", vector().alias("v"))
    pairs = sums.groupBy("id", "h").agg(F.max(F.when(F.col("which") == 0, F.struct("v"))).alias("a"),
                                        F.max(F.when(F.col("which") == 1, F.struct("v", "sha"))).alias("b"))
    own = staged(pairs.select("id", "h", F.col("a.v").alias("v"), F.col("b.sha").alias("edited_sha256"),
                              as_text(F.col("b.v")).alias("edited_fingerprint"),
                              likeness(F.col("a.v"), F.col("b.v")).alias("near_edited")), "vectors")
    follow = own.join(order, ["id", "h"])
    after = own.select(F.col("id").alias("next_id"), F.col("h").alias("next_h"), F.col("v").alias("next_v"))
    # a row for each copy, a thousand at a time, so that no array holds them all
    whole = follow.join(after, ["next_id", "next_h"]).withColumn("thousand", F.explode(F.sequence(F.lit(0), F.expr("cast((copies - 1) div 1000 as int)"))))
    whole = whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(1000), F.col("copies") - F.col("thousand") * 1000).cast("int"))))
    return whole.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        as_text(F.col("v")).alias("fingerprint"), "edited_fingerprint", "near_edited",
        likeness(F.col("v"), F.col("next_v")).alias("near_next"))
