"""The prefix trie of conversations, by union-find over sorted neighbours.

Conversations are rows of turn hashes, range-partitioned and sorted. Neighbours that
share their first d turns are joined by an edge of depth d, and a partition joins them by
union-find in descending depth: where two components meet at depth d they become the
children of one node at depth d. A component that reaches a depth it isn't a node of yet
grows a node for each turn between. What a partition can't finish are the nodes on the
paths of its first and its last conversation (its spines), which may go on next door. It
returns them contracted: for each such node only what hangs on it directly (conversations,
finished children, their leaves and tokens). The spines of all partitions, in order, are
paths with attachments just like conversations, so the same step merges them, ``FAN``
partitions at a time until one forest is left.

The conversations that end at a node stand together in the sorted order, smallest first. A
node inside a partition hashes them there; for a spine node the partition writes them down in
chunks of text, and the chunks of a node are hashed one after the other from a sorted
stream, so that no task holds them (SHA-256 itself can't be divided).

Turns are known by 128 bits of hashes of role and text; prefixes by a 128-bit hash of
their turns.

Defined cases: a null role or text is empty; turns are ordered by number, null first, and
such as share a number by their hashes; repeated rows are repeated turns; a row without a
conversation id belongs to no conversation and is left out; the empty table gives no
node; other columns are ignored. One conversation's hashes are one row (24 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_side, staged

HEADS = 4  # crc32(conv_id) modulo this many turns come from the base conversation
GROUP = 20  # the base is the conversation at the multiple of this below
FAN = 512  # partitions whose spines one task merges
ROWS = 100_000  # conversations of a partition
CHUNK = 4096  # ids of a chunk
NOTHING = hashlib.sha256(b"").hexdigest()
MOST = 2 ** 63 - 1

NODE = ("conv_id long, depth int, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, key binary")
SPINE = "part int, side int, path binary, words array<long>, marks array<long>"
CHUNKS = "key binary, first long, ids string"
ROW = f"kind string, {NODE}, {SPINE}, chunk_{CHUNKS.replace(', ', ', chunk_')}"


class Forest:
    """Joins neighbouring paths in descending depth of their common prefix.

    ``paths``: bytes of 16 for each turn; ``words``: the turns' word counts; ``marks``: for
    each path the rows (depth, conversations, smallest id, children, leaves, tokens) that hang on
    its nodes, the deepest at the path's end; ``common``: turns each path shares with the next.
    ``last`` closes all nodes; else those on the first and on the last path stay open.
    """

    def __init__(self, paths: list[bytes], words: list, marks: list[list[tuple]], common: list[int], last: bool):
        self.paths, self.words, self.last = paths, words, last
        n = len(paths)
        self.up = list(range(n))
        self.node: list[list | None] = [None] * n  # depth, n, least, children, leaves, tokens, rows waiting for the parent
        self.open = [0] * n  # bit 1: holds the first path, bit 2: the last
        self.from_path = list(range(n))  # a path of the component
        if not last:
            self.open[0] |= 1
            self.open[n - 1] |= 2
        self.rows: list[list] = []  # closed nodes: [path, depth, n, least, children, leaves, tokens, parent's least, parent's spot]
        self.spines: dict[tuple[int, int], tuple] = {}  # (2 if on the last path else 1, depth): what hangs on it
        events = [(d, 0, i, m) for i, got in enumerate(marks) for d, *m in got]
        events += [(d, 1, i, None) for i, d in enumerate(common)]
        events.sort(key=lambda e: (-e[0], e[1]))
        for depth, kind, i, mark in events:
            a = self._raise(self._find(i), depth)
            if kind == 0:
                self._hang(self.node[a], mark)
            else:
                self._join(a, self._raise(self._find(i + 1), depth))
        top = self._raise(self._find(0), 0)
        self._close(top)

    def _find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    @staticmethod
    def _hang(node: list, mark: list) -> None:
        n, least, children, leaves, tokens = mark
        node[1] += n
        node[2] = min(node[2], least)
        node[3] += children
        node[4] += leaves
        node[5] += tokens

    def _close(self, c: int) -> list | None:
        """Finish the component's node; its row, or None if it stays open."""
        depth, n, least, children, leaves, tokens, waiting = self.node[c]
        if self.open[c]:
            spot = (2 if self.open[c] & 2 else 1, depth)
            self.spines[spot] = (n, least, children, leaves, tokens)
            for row in waiting:
                row[8] = spot
            return None
        for row in waiting:
            row[7] = least
        row = [self.from_path[c], depth, n, least, children, leaves + (children == 0),
               tokens + (n - 1) * (int(self.words[self.from_path[c]][depth - 1]) if depth else 0), None, None]
        self.rows.append(row)
        return row

    def _raise(self, c: int, depth: int) -> int:
        """Let the component's top be a node at ``depth``."""
        if self.node[c] is None:
            self.node[c] = [depth, 0, MOST, 0, 0, 0, []]
        while self.node[c][0] > depth:
            at = self.node[c][0] - 1
            row = self._close(c)
            self.node[c] = [at, 0, MOST, 0, 0, 0, []] if row is None else [at, row[2], row[3], 1, row[5], row[6], [row]]
        return c

    def _join(self, a: int, b: int) -> None:
        x, y = self.node[a], self.node[b]
        self._hang(x, y[1:6])
        x[6] = x[6] + y[6] if len(x[6]) >= len(y[6]) else y[6] + x[6]
        self.up[b] = a
        self.open[a] |= self.open[b]
        if self.open[b]:
            self.from_path[a] = self.from_path[b]


def prefix_keys(path: bytes, depths: list[int]) -> dict[int, bytes]:
    """The keys of ascending depths of one path, in one run over it."""
    state, at, out = hashlib.blake2b(digest_size=16), 0, {}
    for d in sorted(depths):
        state.update(path[16 * at:16 * d])
        at = d
        out[d] = state.copy().digest()
    return out


def _common(paths: list[bytes]) -> list[int]:
    """Turns that each path shares with the next one."""
    if len(paths) < 2:
        return []
    turns = np.array([len(p) // 16 for p in paths])
    start = np.concatenate([[0], np.cumsum(turns)])
    m = np.minimum(turns[:-1], turns[1:])
    pair = np.repeat(np.arange(len(m)), m)
    inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    if not len(pair):
        return m.tolist()
    both = np.frombuffer(b"".join(paths), dtype=np.uint64).reshape(-1, 2)
    differ = (both[start[:-2][pair] + inside] != both[start[1:-1][pair] + inside]).any(axis=1)
    out = m.copy()
    np.minimum.at(out, pair[differ], inside[differ])
    return out.tolist()


SCHEMA = pa.schema([("kind", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()),
                    ("parent_key", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("key", pa.binary()), ("part", pa.int32()),
                    ("side", pa.int32()), ("path", pa.binary()), ("words", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())),
                    ("chunk_key", pa.binary()), ("chunk_first", pa.int64()), ("chunk_ids", pa.string())])


def _batch(kind: str, names: list[str], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of some of the columns; the others are null."""
    for lo in range(0, len(rows), 5000):
        part = rows[lo:lo + 5000]
        have = dict(zip(names, zip(*part, strict=True), strict=True)) | {"kind": [kind] * len(part)}
        yield pa.RecordBatch.from_arrays([pa.array(have[f.name], f.type) if f.name in have else pa.nulls(len(part), f.type) for f in SCHEMA],
                                         schema=SCHEMA)


def _chunks(key: bytes, ids: np.ndarray) -> list[tuple]:
    """A node's ids as pieces of text, each led by its first id."""
    return [(key, int(ids[lo]), ",".join(map(str, ids[lo:lo + CHUNK].tolist()))) for lo in range(0, len(ids), CHUNK)]


def _emit(forest: Forest, part: int, named: bool, ends: list[np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    """Closed nodes, chunks and spines of a forest. ``named``: closed nodes have keys, since
    others (or chunks) may refer to them; ``ends``: the ids that end at each path's end."""
    paths, words = forest.paths, forest.words
    sides = ((1, 0), (2, len(paths) - 1))
    open_keys: dict[tuple[int, int], bytes] = {}
    for side, p in sides:
        open_keys |= {(side, d): k for d, k in prefix_keys(paths[p], [d for s, d in forest.spines if s == side]).items()}
    open_paths = {paths[dict(sides)[s]][:16 * d]: k for (s, d), k in open_keys.items()}
    chunks: list[tuple] = []
    shas: dict[bytes, str] = {}
    for path, ids in zip(paths, ends or [], strict=False):
        if path in open_paths:
            chunks += _chunks(open_paths[path], ids)
        else:
            shas[path] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
    keys: dict[tuple[int, int], bytes] = {}
    if named:
        of: dict[int, list[int]] = {}
        for row in forest.rows:
            of.setdefault(row[0], []).append(row[1])
        keys = {(p, d): k for p, depths in of.items() for d, k in prefix_keys(paths[p], depths).items()}
    nodes = [(least, depth, above, open_keys.get(spot), n, children, leaves, tokens,
              None if named else shas.get(paths[path][:16 * depth], NOTHING), keys.get((path, depth)))
             for path, depth, n, least, children, leaves, tokens, above, spot in forest.rows]
    yield from _batch("node", ["conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves",
                               "saved_tokens", "ends_sha256", "key"], nodes)
    yield from _batch("chunk", ["chunk_key", "chunk_first", "chunk_ids"], chunks)
    spines = []
    for side, p in sides:
        marks = [(d, *m) for (s, d), m in sorted(forest.spines.items()) if s == side and m[0]]
        if marks:
            deep = marks[-1][0]
            spines.append((part, side, paths[p][:16 * deep], [int(w) for w in words[p][:deep]], [x for m in marks for x in m]))
    yield from _batch("spine", ["part", "side", "path", "words", "marks"], spines)


def rebuilt(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, seq (two longs a turn), words: every conversation with the first turns of its
    base conversation in place of its own, as many as its id's checksum says."""
    body = F.coalesce(F.col(text), F.lit(""))
    named = [F.xxhash64(F.lit(seed), F.coalesce(F.col(role), F.lit("")), body) for seed in (21, 22)]
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), named[0].alias("a"), named[1].alias("b"),
                 F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("w")).alias("t"))
    whole = staged(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")), "turns")
    head = F.expr(f"cast(crc32(cast(cast(conv_id as string) as binary)) % {HEADS} as int)")
    base = whole.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("ts", 1, HEADS - 1).alias("first"))
    own = whole.withColumn("h", head).withColumn("of", F.col("conv_id") - F.col("conv_id") % GROUP)
    rest = F.expr("slice(ts, h + 1, greatest(size(ts) - h, 0))")
    both = own.join(base, F.col("of") == F.col("base"), "left").withColumn("ts", F.concat(
        F.coalesce(F.expr("slice(first, 1, h)"), F.slice("ts", 1, 0)), rest))
    return both.select("conv_id", F.flatten(F.transform("ts", lambda t: F.array(t["a"], t["b"]))).alias("seq"),
                       F.transform("ts", lambda t: t["w"]).alias("words"))


def _first_forests(seqs: DataFrame) -> DataFrame:
    """Nodes, chunks and spines of each sorted partition of (conv_id, seq, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        ids = t.column(0).to_numpy()
        flat, offsets = _list(t.column(1))
        words, word_offsets = _list(t.column(2))
        data = flat.tobytes()
        paths, counts, runs, before = [], [], [], None
        for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            path = data[8 * lo:8 * hi]
            if path != before:  # equal conversations are one path
                paths.append(path)
                counts.append(words[word_offsets[i]:word_offsets[i + 1]])
                runs.append(i)
                before = path
        ends = np.split(ids, runs[1:])
        marks = [[(len(p) // 16, len(e), int(e[0]), 0, 0, 0)] for p, e in zip(paths, ends, strict=True)]
        forest = Forest(paths, counts, marks, _common(paths), last=False)
        yield from _emit(forest, TaskContext.get().partitionId(), False, ends)

    return seqs.mapInArrow(run, ROW)


def _list(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column."""
    one = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    offsets = np.concatenate([[0], np.cumsum(one.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return one.flatten().to_numpy(zero_copy_only=False), offsets


def _merged_forests(spines: DataFrame, last: bool) -> DataFrame:
    """Nodes and spines of each group of consecutive spines (columns of SPINE, group first)."""

    def merge(group: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        paths, words, marks = [], [], []
        for r in rows:
            got = [tuple(r["marks"][i:i + 6]) for i in range(0, len(r["marks"]), 6)]
            if paths and paths[-1] == r["path"]:  # the same node again: one path
                marks[-1] = marks[-1] + got
            else:
                paths.append(r["path"])
                words.append(r["words"])
                marks.append(got)
        return _emit(Forest(paths, words, marks, _common(paths), last), group, True, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for b in batches:
            for r in b.to_pylist():
                if r["grp"] != group and rows:
                    yield from merge(group, rows)
                    rows = []
                group = r["grp"]
                rows.append(r)
        if rows:
            yield from merge(group, rows)

    return spines.mapInArrow(run, ROW)


def _hashed_ends(chunks: DataFrame, parts: int) -> DataFrame:
    """key, sha: the hash over each node's chunks in order, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            keys, shas = [], []
            for key, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        shas.append(state.hexdigest())
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], names=["end_key", "sha"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["end_key", "sha"])

    return chunks.repartition(parts, "key").sortWithinPartitions("key", "first").mapInArrow(run, "end_key binary, sha string")


def trie(seqs: DataFrame, rows: int = ROWS, fan: int = FAN) -> DataFrame:
    """The nodes of the trie of (conv_id, seq, words), one row each."""
    seqs = staged(seqs, "conversations")
    n = seqs.count()
    parts = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // rows))
    dealt = seqs.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    level = staged(_first_forests(dealt), "forests")
    nodes, chunks = [level.where("kind = 'node'")], level.where("kind = 'chunk'").select(
        F.col("chunk_key").alias("key"), F.col("chunk_first").alias("first"), F.col("chunk_ids").alias("ids"))
    last = False
    while not last:
        last = parts <= fan
        parts = -(-parts // fan)
        spines = level.where("kind = 'spine'").select("part", "side", "path", "words", "marks").withColumn("grp", F.expr(f"part div {fan}").cast("int"))
        spines = spines.repartition(parts, "grp").sortWithinPartitions("grp", "part", "side")
        level = staged(_merged_forests(spines, last), "forests")
        nodes.append(level.where("kind = 'node'"))

    columns = [c.split()[0] for c in NODE.split(", ")]
    inner = nodes[0].select(*columns)
    outer = nodes[1]
    for more in nodes[2:]:
        outer = outer.unionByName(more)
    outer = outer.select(*columns)
    # nodes of spines are few: at most two paths for each partition
    sha = _hashed_ends(chunks, int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    outer = staged(outer.join(sha, F.col("key") == F.col("end_key"), "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(NOTHING))).select(*columns), "spine-nodes")
    above = small_side(outer.select(F.col("key").alias("k"), F.col("conv_id").alias("above")))
    found = inner.unionByName(outer).join(above, F.col("parent_key") == F.col("k"), "left")
    return found.select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", "saved_tokens", "ends_sha256").withColumn("depth", F.col("depth").cast("long"))


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    of every node of the rebuilt conversations."""
    return trie(rebuilt(conversations, **columns))
