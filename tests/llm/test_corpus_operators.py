"""Near duplicates, repeated strings, neighbours, chats, packing, mixing and the pipeline."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import random
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import frame, words
from tidemark.llm import chat, hyperminhash, mixing, nn_descent, packing, ranges, suffix_dedup
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def shingle_set(text, n):
    w = words(text)
    return ({tuple(w)} if len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}) if w else set()


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near_brute(rows, n, percent):
    """Rows of one doc_id count as one document for links; a null id is the smallest."""
    sets = [shingle_set(t, n) for _, t in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sets[i] and sets[j]
             and (100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) or rows[i][0] == rows[j][0])]
    comp = groups(len(rows), links)
    least = {}
    for (d, _), c in zip(rows, comp, strict=True):
        least[c] = min(least.get(c, (9, 0)), (d is not None, d or 0))
    return sorted(((d is not None, d or 0), len(s), least[c] if s else (d is not None, d or 0))
                  for (d, _), s, c in zip(rows, sets, comp, strict=True))


def near_rows(df):
    out = []
    for r in df.collect():
        i, c = (r.doc_id is not None, r.doc_id or 0), (r.component_id is not None, r.component_id or 0)
        assert r.kept == (i == c)
        out.append((i, r.n_shingles, c))
    return sorted(out)


def variants(rnd, bases=6, copies=14):
    out = []
    for b in range(bases):
        base = [f"{rnd.choice('abcdefgh')}{rnd.randrange(400)}" for _ in range(rnd.choice([4, 9, 20, 60, 200]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randrange(0, 4)):
                w[rnd.randrange(len(w))] = f"z{rnd.randrange(999)}"
            out.append(" ".join(w))
    rnd.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("blocked", [False, True])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, blocked):
    if blocked:
        monkeypatch.setattr(hyperminhash, "BLOCK_SHINGLES", 300)
    rows = variants(random.Random(3))
    assert near_rows(hyperminhash.near_duplicates(frame(spark, rows))) == near_brute(rows, 3, 85)


def test_near_duplicates_of_messy_rows(spark, messy):
    rows = [r[:2] for r in messy]
    assert near_rows(hyperminhash.near_duplicates(frame(spark, messy))) == near_brute(rows, 3, 85)
    assert hyperminhash.near_duplicates(frame(spark, messy).limit(0)).count() == 0
    kept = hyperminhash.distinct_documents(frame(spark, messy))
    want = near_brute(rows, 5, 80)
    assert Counter((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == Counter(i for i, _, c in want if i == c)


def test_near_duplicates_of_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert near_rows(QUERIES["op3_hyperminhash"](spark, SMALL)) == near_brute(rows, 3, 85)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(ORACLE["op3_hyperminhash"]).fetchall()
    assert sorted(((True, d), n, (True, c)) for d, n, c, _ in want) == near_brute(rows, 3, 85)


@pytest.mark.parametrize(("n", "percent", "rows", "bands"), [(3, 85, 6, 32), (5, 80, 5, 40)])
def test_near_duplicates_one_word_apart_at_every_size(spark, n, percent, rows, bands):
    texts = []
    for size in range(16, 34):
        for copy in range(4):
            w = [f"t{size}x{copy}x{i}" for i in range(size)]
            texts += [" ".join(w), " ".join([*w, "more"]) if copy % 2 else " ".join(w[:-1])]
    docs = list(enumerate(texts))
    want = near_brute(docs, n, percent)
    assert len({c for _, _, c in want}) == len(docs) // 2
    assert near_rows(hyperminhash.near_duplicates(frame(spark, docs), n, percent, rows, bands)) == want


def test_registers_of_neighbouring_sizes_agree():
    rng = np.random.default_rng(11)
    for n in (1, 5, 12, 20, 23, 24, 30):
        equal = []
        for _ in range(40):
            pool = rng.integers(0, 2**64, n + 1, dtype=np.uint64)
            regs = hyperminhash.sketch(np.concatenate([np.sort(pool[:n]), np.sort(pool)]), np.array([n, n + 1]), 192)
            equal.append(hyperminhash.jaccard_estimate(regs[0], regs[1:])[0])
        assert abs(np.mean(equal) - n / (n + 1)) < 0.03


def test_jaccard_estimate_is_close():
    rng = np.random.default_rng(5)
    for n, shared in ((40, 36), (400, 300), (3000, 1000)):
        errors = []
        for _ in range(20):
            pool = np.unique(rng.integers(0, 2**64, 3 * n, dtype=np.uint64))
            a, b = pool[:n], np.concatenate([pool[:shared], pool[n:2 * n - shared]])
            regs = hyperminhash.sketch(np.concatenate([np.sort(a), np.sort(b)]), np.array([n, n]), 192)
            errors.append(hyperminhash.jaccard_estimate(regs[0], regs[1:])[0] - shared / (2 * n - shared))
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.16


def test_components_against_union_find(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(0, i) for i in range(300, 340)] + [
        (i, i + 1) for i in range(400, 460)] + [(7, 7)]
    comp = groups(500, edges)
    least = defaultdict(lambda: 999)
    for i, c in enumerate(comp):
        least[c] = min(least[c], i)
    want = {i: least[comp[i]] for e in edges if e[0] != e[1] for i in e}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- repeated strings

def repeats_brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    starts = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if starts[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rnd = random.Random(seed)

    def text(n):
        return " ".join(rnd.choice(["al", "be", "gé", "xxx", "yz"]) + str(rnd.randrange(99)) for _ in range(n))

    shared, out = [text(60) for _ in range(5)], []
    for _ in range(50):
        t = text(rnd.randrange(0, 80))
        for _ in range(rnd.randrange(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randrange(0, len(p) // 2)
            t += p[a:a + rnd.randrange(20, len(p))] + text(rnd.randrange(0, 40))
        out.append(t)
    return out + [None, "", "a" * 900, "a" * 100 + "b" * 400, "ab" * 300, "xab" * 50 + "ab" * 200, out[3], out[3], out[7][50:]]


@pytest.mark.parametrize("length,piece", [(64, 1 << 19), (100, 700)])
def test_repeated_strings_against_all_windows(spark, monkeypatch, length, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    texts = passages(length)
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(frame(spark, list(enumerate(texts))), length).collect()}
    assert got == dict(enumerate(repeats_brute(texts, length)))


def test_repeated_strings_of_messy_rows(spark, messy):
    got = suffix_dedup.remove_repeats(frame(spark, messy), 80).collect()
    want = repeats_brute([r[1] for r in messy], 80)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(((m[0], *w) for m, w in zip(messy, want, strict=True)), key=key)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert suffix_dedup.remove_repeats(frame(spark, messy).limit(0)).count() == 0
    cleaned = suffix_dedup.without_repeats(frame(spark, messy), 80)
    assert cleaned.columns == frame(spark, messy).columns and cleaned.count() == len(messy)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cleaned.collect())


def test_repeated_strings_of_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op4_suffix_dedup"](spark, SMALL).collect()
    got = {r.doc_id: tuple(r)[1:5] for r in found}
    for r in found:  # the text is what is left, but for characters that were cut
        assert "\ufffd" in r.text or hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
    assert got == dict(zip((r[0] for r in rows), repeats_brute([r[1] for r in rows], 400), strict=True))


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(0)
    keys = [rng.integers(-3, 3, 500) for _ in range(3)]
    order = ranges.multikey_order(keys)
    got = [tuple(k[i] for k in keys) for i in order]
    assert got == sorted(got) and sorted(order) == list(range(500))


@pytest.mark.parametrize("buckets", [1, 40])
def test_repeats_across_bucket_borders(spark, buckets):
    rnd = random.Random(buckets)
    rows = [(rnd.choice([1, 1, 1, 2, 3, rnd.randrange(50)]), rnd.randrange(3), rnd.randrange(2), i) for i in range(300)]
    got = {r.i: r.whole for r in ranges.repeats(spark.createDataFrame(rows, "core long, u1 long, u2 long, i long"), ["i"], buckets).collect()}
    cores, whole = Counter(r[0] for r in rows), Counter(r[:3] for r in rows)
    assert got == {r[3]: whole[r[:3]] > 1 for r in rows if cores[r[0]] > 1}


# ---------------------------------------------------------------- nearest neighbours

def nearest_brute(rows, is_query, k):
    seen = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            seen.setdefault(i, v)
    ids = np.array(sorted(seen))
    x = np.array([seen[i] for i in ids], dtype=np.float32).astype(np.float64)
    out = {}
    for a in np.flatnonzero([is_query(i) for i in ids]):
        d = np.sqrt(((x - x[a]) ** 2).sum(axis=1))
        d[a] = np.inf
        best = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
        out[int(ids[a])] = [(int(ids[b]), float(d[b])) for b in best]
    return out


def found_neighbours(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def test_neighbours_recall(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((30, 24))
    x = centres[rng.integers(0, 30, 3000)] + 0.6 * rng.standard_normal((3000, 24))
    x[2000:] = x[2000]  # a third of all rows are one vector
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found_neighbours(nn_descent.nearest(df, F.col("vec_id") % 50 == 0))
    want = nearest_brute(rows, lambda i: i % 50 == 0, 10)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    assert got[2000] == want[2000]
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda r: (r[1], r[0]))
        assert all(abs(s - np.linalg.norm(np.float64(np.float32(x[v])) - np.float64(np.float32(x[q])))) < 1e-12 for v, s in found)


def test_neighbours_recall_beside_a_very_long_vector(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((30, 24))[rng.integers(0, 30, 3000)] + 0.6 * rng.standard_normal((3000, 24))
    x[1] *= 1e8
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found_neighbours(nn_descent.nearest(df, F.col("vec_id") % 50 == 0))
    want = nearest_brute(rows, lambda i: i % 50 == 0, 10)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95


def test_neighbours_of_the_small_table_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = con.execute(ORACLE["op5_nn_descent"]).fetchall()
    got = QUERIES["op5_nn_descent"](spark, SMALL).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_neighbours_of_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 0.0]),
            (None, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (9, []), (10, [0.0, 3.0]), (10, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, v int, q string")
    got = found_neighbours(nn_descent.nearest(df, F.col("vec_id") % 10 == 0))
    assert got == nearest_brute([r for r in rows if r[0] != 8], lambda i: i % 10 == 0, 10)
    assert nn_descent.nearest(df.limit(0), F.lit(True)).count() == 0
    assert nn_descent.nearest(df.limit(1), F.lit(True)).count() == 0


# ---------------------------------------------------------------- chats

def test_chats_of_the_small_table_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    want = con.execute(ORACLE["op8_chat_format"]).fetchall()
    assert sorted(map(tuple, QUERIES["op8_chat_format"](spark, SMALL).collect())) == sorted(want)


def test_chats_of_messy_turns(spark):
    t = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"),
         (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (4, 1, "assistant", "no"), (5, None, None, None), (None, 0, "user", "alone"),
         (6, 5, "user", "hi"), (6, 5, "assistant", "tie"), (7, 3, "user", "")]
    df = spark.createDataFrame([(*r, 1, 2) for r in t], "conv_id long, turn long, role string, text string, pos int, p0 int")
    got = {r.conv_id: (r.n_turns, r.copies, r.rendered) for r in chat.format_chats(df).collect()}

    def said(*turns):
        return "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns)

    assert got == {2: (2, 2, said(("user", "hi"), ("assistant", "yo"))), 4: (2, 1, said(("user", "hi"), ("assistant", "no"))),
                   5: (1, 1, said(("unknown", ""))), None: (1, 1, said(("user", "alone"))),
                   6: (2, 1, said(("assistant", "tie"), ("user", "hi"))), 7: (1, 1, said(("user", "")))}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_neighbours_in_double_precision(spark):
    """Distances beyond single precision, and values beyond its range on both sides."""
    near = [(0, [1.0, 1.0]), (1, [1.0 + 1e-9, 1.0]), (2, [1.0 + 2e-9, 1.0]), (3, [1.0 + 2e-9, 1.0]), (4, [5.0, 0.0])]
    is_query = F.col("vec_id") == 0
    for scale in (1.0, 1e100, 1e-100):
        df = spark.createDataFrame([(i, [x * scale for x in v]) for i, v in near], "vec_id long, embedding array<double>")
        got = [(r.rank, r.vec_id, r.score) for r in nn_descent.nearest(df, is_query).orderBy("rank").collect()]
        assert [g[:2] for g in got] == [(1, 1), (2, 2), (3, 3), (4, 4)]
        a = np.array(near[0][1]) * scale
        for (_, i, score), (_, v) in zip(got, near[1:], strict=True):
            apart = np.array([x * scale for x in v]) - a
            assert score == np.sqrt(apart[0] * apart[0] + apart[1] * apart[1]), i


# ---------------------------------------------------------------- packing

def test_bounds_are_optimal():
    rnd = random.Random(1)
    for _ in range(40):
        lengths = rnd.sample(range(0, 40), rnd.randrange(1, 9))
        counts = [rnd.randrange(1, 9) for _ in lengths]
        k = rnd.randrange(1, 5)

        def waste(bounds):
            return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts, strict=True))

        got = packing.optimal_bounds(lengths, counts, k)
        assert len(got) <= k and max(got) == max(lengths)
        rest = [x for x in lengths if x != max(lengths)]
        best = min(waste([max(lengths), *c]) for i in range(min(k, len(lengths))) for c in itertools.combinations(rest, i))
        assert waste(got) == best
    assert packing.optimal_bounds([], [], 4) == []


@pytest.mark.parametrize("group_rows", [100_000, 5])
def test_packing_of_messy_rows(spark, messy, group_rows):
    got = packing.pack(frame(spark, messy), max_len=1000, buckets=4, budget=3000, group_rows=group_rows).collect()
    per_doc = defaultdict(list)
    for r in got:
        per_doc[r.doc_id].append(r.n_tokens)
        assert 0 <= r.n_tokens <= r.bound <= 1000 and r.padding == r.bound - r.n_tokens
    want = defaultdict(list)
    for r in messy:
        n = len(words(r[1]))
        want[r[0]] += [1000] * (n // 1000) + ([n % 1000] if n % 1000 or n == 0 else [])
    assert {k: sorted(v) for k, v in per_doc.items()} == {k: sorted(v) for k, v in want.items()}
    batches = Counter((r.bound, r.batch_group, r.batch) for r in got)
    assert all(n <= max(1, 3000 // max(1, b[0])) for b, n in batches.items())
    assert len({(r.bound, r.batch_group, r.batch, r.slot) for r in got}) == len(got)
    assert len({r.bound for r in got}) <= 4
    assert packing.pack(frame(spark, messy).limit(0)).count() == 0


# ---------------------------------------------------------------- mixing

def mixed_weights(kind):
    if kind == "one large":  # a third of the rows and 19 equal sources, at the default power
        return {f"s{i}": (10_000 if i else 95_000) ** 0.7 for i in range(20)}
    if kind == "400 tiny":
        return {"big": 1.0} | {f"t{i}": 1e-6 for i in range(400)}
    rng = random.Random(4)
    return {f"s{i}": rng.choice([1, 3, 50]) + rng.random() for i in range(3000)}


@pytest.mark.parametrize(("kind", "end"), [("one large", 50_000), ("400 tiny", 20_000), ("3000", 60_000)])
def test_every_block_meets_its_window_over_many_ranges(kind, end):
    """Shares are exact: no source is a block off its share at any time, whatever the cuts."""
    whole = mixing.exact_weights(mixed_weights(kind))
    pfair = mixing.Pfair(list(whole.values()))
    cuts = [0, *sorted(random.Random(1).sample(range(1, end), 4)), end]
    taken, slots = Counter(), []
    for a, b in itertools.pairwise(cuts):
        for s, j, t in pfair.run(a, b, pfair.taken(a) if a else set(), pfair.taken(b), None):
            release, deadline = pfair.window(s, j)
            assert release <= t < deadline and j == taken[s]
            taken[s] += 1
            slots.append(t)
        for s, w in enumerate(pfair.weights):
            assert abs(taken[s] * pfair.total - b * w) < pfair.total
    assert slots == list(range(end))


def test_exact_weights_are_in_proportion():
    got = mixing.exact_weights({"a": 0.1, "b": 0.3, "z": 0, "n": float("nan"), "m": -1.0, None: 1e-9})
    assert set(got) == {"a", "b", None}
    assert all(got[k] * Fraction(0.1) == got["a"] * Fraction(v) for k, v in (("b", 0.3), (None, 1e-9)))


def test_mix_of_sources(spark):
    rows = [(i, "x", None, "hot" if i % 3 else f"s{i % 5}") for i in range(900)] + [(i, "y") for i in range(900, 930)]
    docs = frame(spark, rows)
    weights = {"hot": 5.0, "s0": 1.0, "s1": 1.0, "s2": 2.0, None: 1.0, "absent": 0.3}
    whole = mixing.exact_weights(weights)
    total = sum(whole.values())
    got = mixing.mix(docs, weights, block_docs=4, range_blocks=30).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    assert set(got) == set(mixing.mix(docs, weights, block_docs=4).collect())  # one range or several
    blocks = {(r.source, r.block): r.slot for r in got}
    assert all(n <= 4 for n in Counter((r.source, r.block) for r in got).values())
    timed = {k: s for k, s in blocks.items() if k[0] in weights}
    assert len(set(timed.values())) == len(timed)
    last = {src: max(s for (x, _), s in timed.items() if x == src) for src in weights if src != "absent"}
    for src, end in last.items():  # until the source runs out
        slots = sorted(s for (x, _), s in timed.items() if x == src)
        for t in range(1, end + 1):
            assert abs(bisect.bisect_left(slots, t) * total - t * whole[src]) < total
    late = {src: s for (src, _), s in blocks.items() if src not in weights}
    assert set(late) == {"s3", "s4"} and min(late.values()) > max(timed.values())
    mixed = mixing.mixed_documents(docs, weights, block_docs=4)
    assert mixed.columns == docs.columns and sorted(r.doc_id for r in mixed.collect()) == [r[0] for r in rows]


def test_mix_of_messy_rows(spark, messy):
    docs = frame(spark, messy)
    weights = mixing.source_weights(docs)
    got = mixing.mix(docs, weights, block_docs=2).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in messy)
    # each block takes its own slot inside its window
    whole = mixing.exact_weights(weights)
    pfair, names = mixing.Pfair(list(whole.values())), list(whole)
    slots = {(r.source, r.block): r.slot for r in got}
    assert len(set(slots.values())) == len(slots)
    for (src, j), t in slots.items():
        release, deadline = pfair.window(names.index(src), j)
        assert release <= t < deadline
    assert sorted(str(r) for r in mixing.mixed_documents(docs, weights).collect()) == sorted(str(r) for r in docs.collect())
    empty = docs.limit(0)
    assert mixing.mix(empty, mixing.source_weights(empty)).count() == 0
    assert mixing.mixed_documents(empty, {}).count() == 0
    assert mixing.mix(docs, {}).count() == len(messy)


def test_weights_too_far_apart_are_refused(spark):
    with pytest.raises(ValueError, match="too far apart"):
        mixing.mix(frame(spark, [(1, "x", None, "a"), (2, "x", None, "b")]), {"a": 1.0, "b": 1e-30})


# ---------------------------------------------------------------- the pipeline

def test_pipeline_against_plain_python(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {d: t for d, t in rows.items() if any(c.isalpha() for c in t or "")}
    least = {i[1]: c[1] for i, _, c in near_brute(sorted(kept.items()), 5, 80)}
    stay = [d for d in sorted(kept) if least[d] == d]
    gone = repeats_cover([kept[d] for d in stay], corpus_pipeline.PASSAGE_BYTES)
    want = {d: len(words(t)) for d, t in zip(stay, gone, strict=True)}
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r.doc_id] += r.n_tokens
    assert dict(got) == want


def test_the_mix_reaches_the_packed_batches(spark):
    """The batches of a bucket, one after the other, hold the sources in their target weights;
    without the mixing stage they don't."""
    import corpus_pipeline

    from tidemark.llm.common import staged

    stages = dict(corpus_pipeline.STAGES)
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.choice([3, 40]))), None, "big" if i < 3000 else f"s{i % 3}") for i in range(4500)]
    docs = staged(frame(spark, rows), "docs")
    weights = mixing.source_weights(docs)
    share = weights["big"] / sum(weights.values())
    source = {r[0]: r[3] for r in rows}

    def worst(packed):
        """How far a long stretch of a bucket's batches is from the target, until s* run out."""
        by = defaultdict(list)
        for r in packed.collect():
            by[r.bound].append(((r.batch_group, r.batch, r.slot), source[r.doc_id]))
        off = []
        for got in by.values():
            order = [x for _, x in sorted(got)]
            order = order[:max(i for i, x in enumerate(order) if x != "big") * 9 // 10]
            off += [abs(order[i:i + 400].count("big") / 400 - share) for i in range(0, len(order) - 400, 100)]
        return max(off)

    mixed = staged(stages["mix"](spark, docs, SMALL), "mixed")
    assert worst(stages["pack"](spark, mixed, SMALL)) < 0.08
    assert worst(stages["pack"](spark, docs, SMALL)) > 0.2


@pytest.mark.parametrize("files", [1, 5])
def test_numbered_rows_follow_the_written_order(spark, tmp_path, files):
    spark.range(0, 2000, 1, files).withColumn("place", F.lit("x")).write.option("maxRecordsPerFile", 130).parquet(str(tmp_path / "t"))
    for df in (spark.read.parquet(str(tmp_path / "t")), spark.range(0, 2000, 1, files).withColumn("place", F.lit("x"))):
        got, place = packing.numbered(df)
        assert place == "place_" and {(r.id, r[place]) for r in got.collect()} == {(i, i) for i in range(2000)}
    got, place = packing.numbered(spark.range(0))
    assert got.count() == 0


def repeats_cover(texts, length):
    raw = [t.encode() for t in texts]
    starts = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if starts[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def test_stages_pass_messy_and_empty_tables(spark, messy):
    import corpus_pipeline

    for docs in (frame(spark, messy), frame(spark, messy).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
