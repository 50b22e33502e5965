"""Count-only unigram tokenisation (Viterbi without the pieces).

An Aho-Corasick automaton over the vocabulary enumerates all pieces that match inside a
word; dynamic programming over the word's positions carries only the best score and its
piece count. Ties are settled as the `tokenizers` library's Unigram model does: starts
are visited from left to right and a later path replaces the best one only if its score
is greater, scores being added in text order; a position without a one-character piece
gets an unknown piece at the lowest score minus 10; neighbouring unknown pieces are
fused, and byte fallback turns them into one piece for each UTF-8 byte.

Words are `[^\\x20\\x09-\\x0D]+`, each with the marker U+2581 before it; a marker inside a
word begins a new one, as a space does. A word is solved once for each batch of texts
and worker (a bounded memo); counts of a text are sums over its words.

Defined cases: a null or empty text has 0 words and pieces and score 0; an empty table
gives no rows; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .hashing import chunks, flat_texts, prefix_hash, span_hash, token_spans

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 400_000


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a SentencePiece file with unigram scores.

    The public file ranks its pieces without probabilities; Zipf's law over the ranks
    gives log probabilities. Control, unknown and byte pieces are left out here.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    norm = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return [(p, -math.log(r + 1) - norm) for r, p in enumerate(pieces)]


class UnigramCounter:
    """Best score and piece count of a word by Viterbi over automaton matches."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.byte_fallback = byte_fallback
        self.auto = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY

    def count(self, word: str) -> tuple[int, float]:
        """(pieces, score) of one marked word."""
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        back = [0] * (n + 1)  # start of the best last piece; negative: unknown
        pieces = [0] * (n + 1)
        best[0] = 0.0
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (size, score) in self.auto.iter(word):
            ends[last + 1].append((last + 1 - size, score))
        single = self.single
        plain = all(c in single for c in word)
        # For one end, the library meets the candidate starts in ascending order.
        for end in range(1, n + 1):
            found, at, unk = None, 0, False
            for start, score in sorted(ends[end]):
                s = best[start] + score
                if found is None or s > found:
                    found, at = s, start
            if not plain and word[end - 1] not in single:
                s = best[end - 1] + self.unknown
                if found is None or s > found:
                    found, at, unk = s, end - 1, True
            best[end], back[end] = found, (-1 - at if unk else at)
            if not unk:
                pieces[end] = pieces[at] + 1
            elif self.byte_fallback:
                pieces[end] = pieces[at] + len(word[at:end].encode("utf-8", "replace"))
            else:
                pieces[end] = pieces[at] + (0 if back[at] < 0 else 1)
        return pieces[n], best[n]

    def count_text_word(self, word: str) -> tuple[int, float]:
        """A word as it stands in the text: marked, and cut at markers inside."""
        if MARK not in word:
            return self.count(MARK + word)
        marked = word if word.startswith(MARK) else MARK + word
        total, score = 0, 0.0
        for part in marked.split(MARK)[1:]:
            n, s = self.count(MARK + part)
            total, score = total + n, score + s
        return total, score


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], byte_fallback: bool = True,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, score of every whole text.

    ``vocabulary`` is broadcast: its size is that of a tokenizer, not of the data.
    """
    src = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(shared.value, byte_fallback)
        memo: dict[int, tuple[int, float]] = {}
        for b in batches:
            data, offsets = flat_texts(b.column(1))
            words = np.zeros(b.num_rows, dtype=np.int64)
            pieces = np.zeros(b.num_rows, dtype=np.int64)
            scores = np.zeros(b.num_rows, dtype=np.float64)
            for lo, hi, part, off in chunks(data, offsets):
                starts, ends, n = token_spans(part, off)
                words[lo:hi] = n
                if not len(starts):
                    continue
                names, first, back = np.unique(span_hash(prefix_hash(part), starts, ends),
                                               return_index=True, return_inverse=True)
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                raw = part.tobytes()
                got_n = np.empty(len(names), dtype=np.int64)
                got_s = np.empty(len(names), dtype=np.float64)
                for i, (name, at) in enumerate(zip(names.tolist(), first.tolist(), strict=True)):
                    got = memo.get(name)
                    if got is None:
                        got = memo[name] = counter.count_text_word(
                            raw[starts[at]:ends[at]].decode("utf-8", "replace"))
                    got_n[i], got_s[i] = got
                owner = np.repeat(np.arange(hi - lo), n)
                pieces[lo:hi] = np.bincount(owner, weights=got_n[back], minlength=hi - lo).astype(np.int64)
                scores[lo:hi] = np.bincount(owner, weights=got_s[back], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(pieces), pa.array(scores)],
                                             names=["doc_id", "n_words", "n_tokens", "score"])

    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    return src.mapInArrow(run, schema)
