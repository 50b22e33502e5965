"""Registered queries of this subpackage: one ``opN_<name>`` for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, divergence, fingerprint, hyperminhash, kneser_ney, langid, mixing, nn_descent, packing, prefix_trie,
               sharding, suffix_dedup, token_count)
from .common import in_training, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: A tokenizer's vocabulary file; a parameter, never part of the repository.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, unigram pieces and best score of every document."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), token_count.zipf_vocabulary(VOCABULARY))


@query
def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the documents (3-word shingles, Jaccard 0.85)."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op3_hyperminhash"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT doc_id, min(other) AS least FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.least, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 400 bytes that start twice; ``text`` is
    what is left (a character that loses one of its bytes shows as U+FFFD)."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@query
def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of each vector whose id is divisible by 100."""
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# The exact neighbours: the search finds all of them on the small table.
ORACLE["op5_nn_descent"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1),
    lambda i: (v.e[i] - q.e[i]) * (v.e[i] - q.e[i])), lambda x, y: x + y)) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles learnt from the training rows."""
    docs = table(spark, sf_dir, "documents")
    profiles = langid.train_profiles(docs.where(in_training("doc_id", 4)))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", (~in_training("doc_id", 4)).alias("held_out"), "lang_pred", "score")


@query
def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney and add-one scores of every document; the training rows teach both."""
    docs = table(spark, sf_dir, "documents")
    found = kneser_ney.score(docs, kneser_ney.train(docs.where(in_training("doc_id", 7))))
    return found.withColumn("held_out", ~in_training("doc_id", 7))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


ORACLE["op8_chat_format"] = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
p AS (
  SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
    md5(string_agg(md5(role || chr(10) || text), ',') OVER (
      PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS name,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '') OVER (
      PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rendered
  FROM n),
whole AS (
  SELECT min(conv_id) AS conv_id, name, any_value(n_turns) AS n_turns, count(*) AS copies, any_value(rendered) AS rendered
  FROM p WHERE pos = n_turns GROUP BY name)
SELECT conv_id, n_turns, copies, rendered FROM whole
WHERE name NOT IN (SELECT name FROM p WHERE pos < n_turns)
"""


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of every document in optimal length buckets and token-budget batches."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot in a Pfair mix of the sources; weights follow size**0.7."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.source_weights(docs))


@query
def op11_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 40 with nearly equal bytes, and its place there."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and the terms that mark each source."""
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_source_divergence"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
g AS (
  SELECT o.lang, o.source, coalesce(s.total, 0) AS total, coalesce(v.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) o LEFT JOIN s USING (lang, source) LEFT JOIN v USING (lang)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT p.lang, p.term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(p.n) + 1)) // (any_value(l.total) + any_value(l.v)) AS q
  FROM p JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM g GROUP BY lang) l USING (lang) GROUP BY p.lang, p.term),
x AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // q.q AS BIGINT)
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 200
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


# The checksum is worked out from its polynomial, one byte of the decimal id after the other.
ORACLE["op13_prefix_trie"] = """
WITH tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS v FROM range(256) AS r(i)),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295,
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, v[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t), tab),
r AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, md5(string_agg(md5(role) || md5(text), '') OVER w) AS k,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT conv_id, depth, k, words FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM c),
e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM m),
n AS (
  SELECT k, any_value(depth) AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM e GROUP BY k),
ch AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
b AS (SELECT DISTINCT u.k, w.k AS below FROM m u JOIN m w ON u.conv_id = w.conv_id AND w.depth >= u.depth),
s AS (
  SELECT b.k, count(*) FILTER (ch.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM b JOIN n ON n.k = b.below LEFT JOIN ch ON ch.k = b.below GROUP BY b.k)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children,
  s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.k = n.k LEFT JOIN ch ON ch.k = n.k LEFT JOIN n a ON a.k = n.up
"""
