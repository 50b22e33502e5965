"""Fingerprints, token counts, language ID and language-model scores against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import frame, words
from tidemark.llm import fingerprint, hashing, kneser_ney, langid, token_count
from tidemark.llm.common import in_training
from tidemark.llm.queries import QUERIES, VOCABULARY

SMALL = "/root/testdata/sf0.001"


def test_token_hashes_follow_the_word_pattern():
    texts = ["A b\tC\x0bd", "", None, "  x  ", "É é É", "ab", "a b"]
    data, offsets = hashing.flat_texts(pa.array(texts))
    tokens, counts = hashing.token_hashes(data, offsets)
    assert counts.tolist() == [len(words(t)) for t in texts]
    by_word = {}
    for h, w in zip(tokens.tolist(), [w for t in texts for w in words(t)], strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


# ---------------------------------------------------------------- fingerprints

def shingle_counts(text):
    c = Counter()
    for p in text.split("\n"):
        w = p.split(" ")
        c.update(tuple(w[i:i + 3]) for i in range(len(w)))
    return c


def likeness(a, b):
    a, b = shingle_counts(a), shingle_counts(b)
    both = sum(v * v for v in a.values()) + sum(v * v for v in b.values())
    return 1 - sum((a[k] - b[k]) ** 2 for k in set(a) | set(b)) / both


def edited_texts(rows):
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        out[d] = (len(t), t[:len(t) - len(t) // 3] + nxt[:len(t) // 3], nxt)
    return out


def test_fingerprints_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = edited_texts(rows)
    got = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SMALL).collect()}
    assert set(got) == set(want)
    text_of, names, errors = dict(rows), defaultdict(set), []
    for d, (n, edited, nxt) in want.items():
        assert got[d].n_chars == n and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        names[text_of[d]].add(got[d].fingerprint)
        errors += [abs(got[d].near_edited - likeness(text_of[d], edited)),
                   abs(got[d].near_next - max(0, likeness(text_of[d], nxt)))]
    assert all(len(v) == 1 for v in names.values())
    assert len({v for s in names.values() for v in s}) == len(names)
    assert sum(errors) / len(errors) < 0.06


def test_fingerprints_of_messy_rows(spark, messy):
    rows = [r for r in messy if not (r[0] == 2 and "other" in r[1])]  # order under one id is by hash
    got = fingerprint.fingerprints(frame(spark, rows)).collect()
    want = edited_texts([r[:2] for r in rows])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == {
        d: (n, hashlib.sha256(e.encode()).hexdigest()) for d, (n, e, _) in want.items()}
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)  # one for each row
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.fingerprints(frame(spark, messy)).count() == len(messy)
    assert fingerprint.fingerprints(frame(spark, messy).limit(0)).count() == 0
    alone = fingerprint.fingerprints(frame(spark, [(1, "abc def")])).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()


def test_fingerprints_of_repeated_rows_count_once(spark):
    text, other = "one line of words\nand another line", "some other text here"
    rows = [(1, text), (2, text), (3, other)]
    want = sorted(map(tuple, fingerprint.fingerprints(frame(spark, rows)).collect()))
    got = fingerprint.fingerprints(frame(spark, [(1, text)] * 2 + [(2, text)] * 2001 + [(3, other)])).collect()
    assert sorted(set(map(tuple, got))) == want
    assert Counter(r.doc_id for r in got) == {1: 2, 2: 2001, 3: 1}
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[2].near_next == 1.0


def test_fingerprints_add_and_subtract(spark):
    a, b = "first line here\nsecond one", "third line\nsecond one"
    df = spark.createDataFrame([(0, a), (1, b), (2, a + "\n" + b), (3, "second one\nthird line\nsecond one\nfirst line here")],
                               "k int, text string")
    v = fingerprint.text_vectors(df, ["k"]).select("k", fingerprint.vector().alias("v"))
    m = v.groupBy().pivot("k", [0, 1, 2, 3]).agg(F.first("v"))
    m = m.select(*(F.col(str(i)).alias(f"v{i}") for i in range(4)))
    put = fingerprint.add(F.col("v0"), F.col("v1"))
    r = m.select((fingerprint.as_text(put) == fingerprint.as_text(F.col("v2"))).alias("added"),
                 (fingerprint.as_text(F.col("v2")) == fingerprint.as_text(F.col("v3"))).alias("order"),
                 (fingerprint.as_text(fingerprint.subtract(F.col("v2"), F.col("v1"))) == fingerprint.as_text(F.col("v0"))).alias("taken"),
                 (fingerprint.as_text(F.col("v0")) == fingerprint.as_text(F.col("v1"))).alias("same")).first()
    assert (r.added, r.order, r.taken, r.same) == (True, True, True, False)


def test_fingerprints_run_without_python(spark):
    plan = QUERIES["op1_fingerprints"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- token counts

@pytest.mark.parametrize("fallback", [False, True])
def test_token_counts_equal_the_tokenizer(spark, messy, fallback):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    vocabulary = token_count.zipf_vocabulary(VOCABULARY)
    low = min(s for _, s in vocabulary)
    extra = [(f"<0x{i:02X}>", low) for i in range(256)] if fallback else []
    t = Tokenizer(models.Unigram([("<unk>", low), *vocabulary, *extra], 0, fallback))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex("[\\x20\\x09-\\x0D]+"), "removed"),
                                               pre_tokenizers.Metaspace(prepend_scheme="always")])
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(1000 + i, r[1]) for i, r in enumerate(messy)] + [(2000, "ab▁cd ▁▁x 🙂ab aaaaaaaaaaaaaaaa")]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_count.count_tokens(
        spark.createDataFrame(rows, "doc_id long, text string"), vocabulary, fallback).collect()}
    for d, text in rows:
        assert got[d] == (len(words(text)), len(t.encode(text or "").ids)), (d, text)


def test_token_count_ties_and_empty_table(spark, messy):
    c = token_count.UnigramCounter([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)], byte_fallback=False)
    assert c.count("▁aa") == (2, -3.0)  # the path that is met first stays at equal scores
    assert c.count("▁bb") == (2, -1.0 + 2 * c.unknown)  # neighbouring unknown pieces are one
    out = token_count.count_tokens(frame(spark, messy).limit(0), [("a", -1.0)])
    assert out.columns == ["doc_id", "n_words", "n_tokens", "score"] and out.count() == 0


# ---------------------------------------------------------------- language ID

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    found = QUERIES["op6_language_id"](spark, SMALL).join(docs, "doc_id").where("held_out").collect()
    assert len(found) > 30 and sum(r.lang_pred == r.truth for r in found) / len(found) > 0.97
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1


def ranked(text, k):
    import re
    spaced = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    c = Counter()
    for run in re.findall(r"\S+", spaced):
        b = b" " + run.encode() + b" "
        for i in range(1, len(b) - 1):
            c[b[i:i + 1]] += 1
            c[b[i - 1:i + 2]] += 1
        for i in range(1, len(b)):
            c[b[i - 1:i + 1]] += 1
    return c


def test_ngram_counts_against_plain_python():
    texts = ["abc de", "", "é1f  g", "xy", "... a"]
    data, offsets = langid._lowered(pa.array(texts))
    codes, owners = langid.gram_codes(data, offsets)
    for i, t in enumerate(texts):
        got = Counter(codes[owners == i].tolist())
        want = Counter()
        for gram, n in ranked(t, 0).items():
            code = 0
            for b in gram:
                code = code * langid.RADIX + int(langid.SYMBOL[b])
            want[code] += n
        assert got == want, t


def test_language_of_messy_rows(spark, messy):
    docs = frame(spark, messy)
    found = langid.identify(docs, langid.train_profiles(docs)).collect()
    assert len(found) == len(messy)
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {5, 3, 9, 13} and all(r.score == 0 for r in found if r.lang_pred == "und")
    assert {r.lang_pred for r in found if r.doc_id == 7} == {"ja"}
    assert langid.identify(docs, langid.train_profiles(docs.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(docs.limit(0), langid.train_profiles(docs)).count() == 0
    kept = langid.keep_identified(docs, langid.train_profiles(docs))
    assert kept.columns == docs.columns and kept.count() == len(messy) - 4


# ---------------------------------------------------------------- language model

def kneser_ney_scores(rows, modulus=7):
    docs = [(d, words(t) + ["</s>"]) for d, t in rows]
    train = [t for d, t in docs if zlib.crc32(("" if d is None else str(d)).encode()) % modulus != 2]
    c = Counter(w for t in train for w in t)
    total, size = sum(c.values()), len(c)
    pairs = Counter(p for t in train for p in zip(["<s>", *t], t))
    context, before = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (u, w), n in pairs.items():
        context[u][0] += n
        context[u][min(n, 3)] += 1
        before[w] += 1

    def estimates(counts):
        return (0, *kneser_ney.discounts(*(sum(v == i for v in counts.values()) for i in (1, 2, 3, 4))))

    d, e, types = estimates(pairs), estimates(before), sum(before.values())
    rest = sum(e[min(v, 3)] for v in before.values()) / types if types else 1.0

    def low(w):
        n = before.get(w, 0)
        return (n - e[min(n, 3)]) / max(1, types) + rest / (size + 1)

    def p(u, w):
        if u not in context:
            return low(w)
        x, n = context[u], pairs.get((u, w), 0)
        return (n - d[min(n, 3)]) / x[0] + sum(d[i] * x[i] for i in (1, 2, 3)) / x[0] * low(w)

    out = []
    for i, t in docs:
        out.append((i, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10((c[w] + 1) / (total + size + 1)) for w in t),
                    sum(math.log10(p(u, w)) for u, w in zip(["<s>", *t], t))))
    return out, p, c


def close(a, b):
    return a[:4] == b[:4] and all(abs(x - y) <= 1e-6 * max(1, abs(y)) for x, y in zip(a[4:], b[4:], strict=True))


def test_kneser_ney_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want, p, c = kneser_ney_scores(rows)
    got = {r.doc_id: r for r in QUERIES["op7_kneser_ney"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for w in want:
        r = got[w[0]]
        assert close((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), w)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better than add-one unigrams


@pytest.mark.parametrize("small_ranges", [False, True])
def test_kneser_ney_of_messy_rows(spark, messy, monkeypatch, small_ranges):
    if small_ranges:
        monkeypatch.setattr(kneser_ney, "RANGE_BYTES", 20_000)
    docs = frame(spark, messy)
    rows = [r[:2] for r in messy]
    train = docs.where(in_training("doc_id", 7))
    got = [tuple(r)[:6] for r in kneser_ney.score(docs, kneser_ney.train(train)).collect()]
    want = kneser_ney_scores(rows)[0]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    assert len(got) == len(want) and all(close(a, b) for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True))


def test_kneser_ney_without_training_rows(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    got = {r.doc_id: r for r in kneser_ney.score(docs, kneser_ney.train(docs.limit(0))).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score, got[1].score) == (3, 0, 0, 0.0, 0.0)
    assert got[2].n_tokens == 1
    assert kneser_ney.score(docs.limit(0), kneser_ney.train(docs)).count() == 0


def test_hot_words_before_are_spread(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "RANGE_BYTES", 2_000)
    rnd = random.Random(4)
    rows = [(i, " ".join(["the " + rnd.choice(["cat", "dog", f"x{rnd.randrange(50)}"]) for _ in range(60)])) for i in range(120)]
    docs = frame(spark, rows)
    model = kneser_ney.train(docs.where(in_training("doc_id", 7)))
    assert len(model.hot) > 1 and model.bits > 2
    got = {r.doc_id: tuple(r)[:6] for r in kneser_ney.score(docs, model).collect()}
    assert all(close(got[w[0]], w) for w in kneser_ney_scores(rows)[0])


def test_model_that_tasks_carry_does_not_grow_with_the_ranges(spark, monkeypatch):
    import pickle

    rows = [(i, " ".join(f"w{i}-{j}" for j in range(200))) for i in range(100)]
    docs, sizes, bits, scores = frame(spark, rows), [], [], []
    for range_bytes in (1 << 25, 1_000):
        monkeypatch.setattr(kneser_ney, "RANGE_BYTES", range_bytes)
        model = kneser_ney.train(docs)
        sizes.append(len(pickle.dumps(model)))
        bits.append(model.bits)
        scores.append(sorted(tuple(r) for r in kneser_ney.score(docs, model).collect()))
        for name, length in (("offsets", (1 << model.bits) + 1), ("filled", 2 << model.bits)):
            kind = np.int64 if name == "offsets" else np.bool_
            assert len(kneser_ney.mapped(f"{model.folder}/{name}", kind)) == length
    assert bits[0] == 0 and bits[1] >= 7 and abs(sizes[0] - sizes[1]) < 100
    assert all(close(x[:6], y[:6]) for x, y in zip(*scores, strict=True))


def test_each_range_is_a_task_of_its_own(spark):
    df = spark.range(64).select((F.col("id") % 16).cast("int").alias("part")).repartitionById(16, F.col("part"))
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("part").alias("n")).collect()
    assert len(per_task) == 16 and all(r.n == 1 for r in per_task)


def test_packed_runs_round_trip():
    from tidemark.llm.shared_files import pack, unpack

    rng = np.random.default_rng(1)
    v = np.unique(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert (unpack(pack(v, True), True) == v).all() and (unpack(pack(v)) == v).all()
    assert len(unpack(pack(v[:0], True), True)) == 0
