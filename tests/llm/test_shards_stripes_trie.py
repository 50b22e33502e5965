"""Sharding, source divergence and the prefix trie against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm.conftest import LOWER, frame
from tidemark.llm import divergence, prefix_trie, sharding
from tidemark.llm.common import staged

SMALL = "/root/testdata/sf0.001"


# --- op11 -----------------------------------------------------------------------------------

def check_shards(rows, docs, shards):
    """Every row once with its size and checksum, slots gapless, bytes near their share."""
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for got in by.values():
        assert sorted(r.slot for r in got) == list(range(len(got)))
    total, largest = sum(r.size for r in rows), max((r.size for r in rows), default=0)
    for s in range(shards):
        assert abs(sum(r.size for r in by.get(s, [])) - total / shards) <= largest + 0.01 * total / shards


@pytest.mark.parametrize("piece_rows", [1_000_000, 3])
def test_shards_of_messy_rows(spark, messy, piece_rows):
    docs = [(r[0], r[1]) for r in messy]
    check_shards(sharding.shard_documents(frame(spark, messy), shards=4, piece_rows=piece_rows).collect(), docs, 4)


def test_shards_with_a_hot_repeated_row_and_large_rows(spark):
    rng = random.Random(3)
    docs = [(i, "x" * rng.choice([1, 20, 300, 5000])) for i in range(900)] + [(7, "the same row")] * 600 + [(None, None)] * 50
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = sharding.shard_documents(df, shards=9, piece_rows=40).collect()
    check_shards(rows, docs, 9)
    again = sharding.shard_documents(df.repartition(3), shards=9, piece_rows=40).collect()
    assert Counter(rows) == Counter(again)  # however the table was dealt


def test_more_shards_than_rows_and_the_empty_table(spark):
    docs = [(1, "a"), (2, "b" * 50)]
    check_shards(sharding.shard_documents(spark.createDataFrame(docs, "doc_id long, text string"), shards=40).collect(), docs, 40)
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_splitters_are_exact_and_within_the_tolerance(spark):
    rng = random.Random(5)
    # values close together at both ends of the range, one value for a third of the rows
    keys = [rng.choice([rng.randrange(100), 2 ** 61 + rng.randrange(100), 77]) for _ in range(3000)]
    rows = [(k, i, rng.randrange(1, 9)) for i, k in enumerate(keys)]
    df = staged(spark.createDataFrame(rows, "k long, row long, size long"), "t")
    cut = sharding.find_splitters(df, ["k", "row"], "size", 12, tolerance=0.01)
    assert cut.keys == sorted(cut.keys) and len(cut.keys) == 11
    total = sum(r[2] for r in rows)
    for i, (key, below, n) in enumerate(zip(cut.keys, cut.below_bytes, cut.below_rows, strict=True), 1):
        under = [r for r in rows if r[:2] < (*key, 0)[:2]]
        assert (sum(r[2] for r in under), len(under)) == (below, n)
        assert abs(below - total * i / 12) <= max(0.01 * total / 12, 9) + 1  # targets are whole


def test_written_shards_hold_the_documents_in_order(spark, messy, tmp_path):
    df = frame(spark, messy).withColumn("shard", F.lit("mine"))
    shard, slot = sharding.write_shards(df, str(tmp_path / "out"), shards=3)
    assert (shard, slot) == ("shard_", "slot_")
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(back.select(*df.columns).collect()) == Counter(df.collect())
    for s in range(3):
        slots = [r[slot] for r in spark.read.parquet(str(tmp_path / "out" / f"{shard}={s}")).coalesce(1).collect()]
        assert slots == list(range(len(slots)))


def test_sharding_runs_no_python(spark):
    plan = sharding.shard_documents(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- op12 -----------------------------------------------------------------------------------

def audit_brute(rows, least=3, top=200):
    docs = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for t, la, so in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(w for d in mine for w in set(d[2]))
        kept = [w for w in df if df[w] >= least]
        sources = sorted({d[1] for d in mine})
        n = {s: Counter(w for d in mine if d[1] == s for w in d[2] if df[w] >= least) for s in sources}
        whole = sum(n.values(), Counter())

        def p(c, w, v=len(kept)):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + v)

        for a in sources:
            pairs = [(b, sum((p(n[a], w) - p(n[b], w)) ** 2 // p(n[b], w) for w in kept)) for b in sources if b != a]
            terms = [(w, (p(n[a], w) - p(whole, w)) ** 2 // p(whole, w)) for w in n[a] if p(n[a], w) > p(whole, w)]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                order = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, a, part, w, f, i) for i, (w, f) in enumerate(order, 1)]
    return sorted(out)


def audited(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


@pytest.mark.parametrize("cells", [divergence.CELLS, 7])
def test_divergence_against_plain_python(spark, monkeypatch, cells):
    rng = random.Random(11)
    vocabulary = ["the", "The", "été", "ÉTÉ", "日本", "x", "y-z", "a1b", "🙂"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randrange(30))), rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "é", "", None]))
            for _ in range(120)] + [("the the the", "en", "s1")] * 60 + [("12 34", "de", "s1"), (None, "de", "s2"), ("one of its kind", "xx", "s9")]
    monkeypatch.setattr(divergence.fold_stripes, "__defaults__", (cells,))
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert audited(df) == audit_brute(rows)
    assert audited(df, top=2, least_docs=5) == audit_brute(rows, 5, 2)


def test_divergence_of_messy_rows_and_the_empty_table(spark, messy):
    full = [(*r, None, None)[:4] for r in messy]
    assert audited(frame(spark, messy)) == audit_brute([(t, la, so) for _, t, la, so in full])
    assert audited(spark.createDataFrame([], "text string, lang string, source string")) == []


def test_probabilities_are_exact_for_large_counts(spark):
    rows = [(n, t, v) for n in (0, 1, 10**11, 5 * 10**13) for t in (n, 7 * 10**14) for v in (1, 10**9) if t >= n]
    df = spark.createDataFrame(rows, "n long, t long, v long").withColumn("p", divergence.probability("n", "t", "v"))
    for r in df.collect():
        assert r.p == 1 + 10**9 * (r.n + 1) // (r.t + r.v)


# --- op13 -----------------------------------------------------------------------------------

def trie_brute(rows):
    """rows: (conv_id, turn, role, text), turns of a conversation distinct."""
    turns = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            turns[c].append(((n is not None, n or 0), (role or "", text or "")))
    own = {c: [x[1] for x in sorted(t)] for c, t in turns.items()}

    def base(c):
        return c - (c % 20 if c >= 0 else -(-c % 20))

    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(base(c), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        ends = sorted(c for c in convs if whole[c] == node)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(m) == len(node) + 1 for m in below),
                    sum(not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in below) for m in below),
                    sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n, hot=0):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "a b", "", None, "long one here"])) for _ in range(rng.choice([1, 2, 3, 5, 9]))]
        rows += [(c, i if i or rng.random() < 0.5 else None, role, text) for i, (role, text) in enumerate(turns)]
    for c in range(10_000, 10_000 + hot):  # a hot conversation and a hot first turn
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "same too")] + ([(c, 2, "user", f"own {c}")] if c % 3 == 0 else [])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "n", "hot", "rows", "fan"), [
    (1, 40, 0, 100_000, 512), (2, 60, 0, 3, 2), (3, 60, 90, 4, 3), (4, 0, 80, 5, 2), (5, 150, 40, 2, 4), (6, 30, 10, 1, 2)])
def test_trie_against_plain_python(spark, seed, n, hot, rows, fan):
    data = conversations(seed, n, hot)
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("x")).withColumn("key", F.lit(1))
    got = prefix_trie.trie(prefix_trie.rebuilt(df), rows, fan)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_brute(data)


def test_trie_of_chunked_ids_repeated_rows_null_ids_and_the_empty_table(spark, monkeypatch):
    schema = "conv_id long, turn long, role string, text string"
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    data = [(c, 0, "user", "x") for c in range(100, 140)]
    assert sorted((tuple(r) for r in prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(data, schema)), 9, 2).collect()), key=str) == trie_brute(data)
    twice = [(4, 1, "user", "x"), (4, 1, "user", "x"), (None, 0, "user", "y")]
    nodes = prefix_trie.prefix_trie(spark.createDataFrame(twice, schema)).collect()
    assert sorted((r.depth, r.conv_id, r.n_convs, r.n_leaves) for r in nodes) == [(0, 4, 1, 1), (1, 4, 1, 1), (2, 4, 1, 1)]
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).collect() == []


def test_trie_of_one_long_conversation(spark):
    data = [(c, i, "user", f"turn {i}") for c in (1000, 1020, 2000) for i in range(3000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    rows = prefix_trie.prefix_trie(df).collect()
    assert len(rows) == 3001 and all(r.n_convs == 3 and r.n_leaves == 1 for r in rows)
    assert max(r.saved_tokens for r in rows) == 2 * 2 * 3000
