"""Vectorised token hashing over Arrow string batches (used inside Spark tasks).

Texts are handled as one flat UTF-8 buffer per chunk, so no Python loop runs per
token. A token's hash is a polynomial over per-byte random 64-bit values modulo
2**64, taken from one running sum, then finalised. The constants come from a fixed
seed: every executor, retry and run computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _RNG.integers(0, 2**64, size=(2, 256), dtype=np.uint64)
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply, twice); returns a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POW: dict[int, np.ndarray] = {}


def _grown(key: int, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker and grown by doubling."""
    have = _POW.get(key)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        filled, step = 1, base
        while filled < size:
            have[filled:2 * filled] = have[:filled] * np.uint64(step)
            step = step * step % 2**64
            filled *= 2
        _POW[key] = have
    return have[:n]


def powers(which: int, n: int) -> np.ndarray:
    return _grown(which, int(BASES[which]), n)


def inverse_powers(which: int, n: int) -> np.ndarray:
    """base**-i modulo 2**64 (the base is odd, hence invertible)."""
    return _grown(which + 2, pow(int(BASES[which]), -1, 2**64), n)


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.large_string(), pa.large_binary()):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n, start = len(column), column.offset
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64, count=start + n + 1)[start:] if n else np.zeros(1, np.int64)
    if n == 0 or bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: (first row, end row, bytes, offsets)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of each text: (starts, ends, word count per text)."""
    solid = ~SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True  # a text's border ends a word
    begin = solid.copy()
    if len(data):
        begin[1:] &= ~solid[:-1] | first[1:-1]
    end = solid.copy()
    if len(data):
        end[:-1] &= ~solid[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    counts = np.diff(np.searchsorted(starts, offsets, side="left"))
    return starts, ends, counts


def prefix_hash(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Running polynomial sum; `span_hash` takes any span's hash from it."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[which][data] * powers(which, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each span [start, end): equal for equal bytes, whatever their place."""
    raw = (prefix[ends] - prefix[starts]) * inverse_powers(which, len(prefix))[starts]
    return mix(raw ^ (ends - starts).astype(np.uint64) * BASES[1 - which])


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word in order, and the word count per text."""
    data = LOWER[data]
    starts, ends, counts = token_spans(data, offsets)
    return span_hash(prefix_hash(data), starts, ends), counts


def combine(*parts: np.ndarray) -> np.ndarray:
    """Order-dependent hash of aligned hash columns (n-grams, shingles)."""
    out = parts[0]
    for p in parts[1:]:
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + p)
    return out


def shingles(tokens: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text, sorted: (hashes, count per text).

    A text of fewer words gives its whole word sequence as one shingle; without
    words it gives none.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    heads = np.concatenate([[0], np.cumsum(counts)])
    if len(tokens) >= n:
        whole = combine(*(tokens[i:len(tokens) - n + 1 + i] for i in range(n)))
        inside = owner[:len(whole)] == owner[n - 1:]
        hashes, owners = whole[inside], owner[:len(whole)][inside]
    else:
        hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for i, d in enumerate(short):  # at most n - 1 words each
            acc = np.array([counts[d]], dtype=np.uint64)
            for t in tokens[heads[d]:heads[d + 1]]:
                acc = combine(acc, np.array([t], dtype=np.uint64))
            extra[i] = acc[0]
        hashes, owners = np.concatenate([hashes, extra]), np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        keep = np.ones(len(hashes), dtype=bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[keep], owners[keep]
    return hashes, np.bincount(owners, minlength=len(counts)).astype(np.int64)
