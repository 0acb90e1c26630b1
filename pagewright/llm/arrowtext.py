"""Vectorised word and shingle hashing over Arrow text columns (numpy, no per-word Python).

Used inside ``mapInArrow`` / ``applyInPandas`` tasks. Words are maximal byte runs outside a
separator class; ASCII letters are lower-cased; a word is represented by a 64-bit hash (a
polynomial over the bytes with a final mix). Texts are worked off in blocks of a few MB, so the
scratch memory does not follow the size of one very long text. NULL texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 2 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_Q = 0xD1342543DE82EF95 | 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: word characters: everything but space and \x09-\x0D
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: word characters: ASCII digits and letters, and every byte of a non-ASCII character
ALNUM = np.ones(256, dtype=bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

_pow = np.ones(1, dtype=U64)
_inv = np.ones(1, dtype=U64)


def _tables(n: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, block + 1)
        a, b = np.full(size, _P, dtype=U64), np.full(size, _P_INV, dtype=U64)
        a[0] = b[0] = 1
        _pow, _inv = np.cumprod(a, dtype=U64), np.cumprod(b, dtype=U64)
    return _pow, _inv


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection): spreads every input bit over the whole word."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string column; NULL rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    if bufs[2] is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(bufs[2], dtype=np.uint8)[off[0]:off[-1]], off - off[0]


@dataclass
class Words:
    """Word hashes of several texts; text ``i`` owns ``hashes[offsets[i]:offsets[i + 1]]``."""

    hashes: np.ndarray
    offsets: np.ndarray
    heads: np.ndarray | None = None  # the first four bytes of each word, as a number


def _cuts(word: np.ndarray, n: int, block: int) -> Iterator[tuple[int, int]]:
    """Blocks of about ``block`` bytes that end at a separator byte."""
    a = 0
    while a < n:
        b = min(n, a + block)
        if b < n:
            back = np.flatnonzero(~word[max(a, b - 4096):b])
            if len(back):
                b = max(a, b - 4096) + int(back[-1]) + 1
            else:
                step = 4096
                while b < n:
                    ahead = np.flatnonzero(~word[b:b + step])
                    if len(ahead):
                        b += int(ahead[0]) + 1
                        break
                    b = min(n, b + step)
                    step *= 2
        yield a, b
        a = b


def _heads(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), U64)
    for j in range(4):
        at = starts + j
        inside = at < ends
        out |= np.where(inside, _LOWER[raw[np.where(inside, at, 0)]], 0).astype(U64) << U64(8 * j)
    return out


def hash_words(col, word_class: np.ndarray = NON_SPACE, heads: bool = False, block: int = BLOCK_BYTES) -> Words:
    """Hash every word of an Arrow string column (``heads``: the words' first bytes too).

    The scratch memory is about 50 times ``block``, the power tables 16 times.
    """
    raw, off = text_buffers(col)
    n = len(raw)
    if not n:
        return Words(np.zeros(0, U64), np.zeros(len(off), np.int64), np.zeros(0, U64))
    word = word_class[_LOWER[raw]]
    first = np.zeros(n + 1, dtype=bool)
    first[off] = True
    hs, ss, es = [], [], []
    for a, b in _cuts(word, n, block):
        w = word[a:b]
        edge = first[a:b + 1].copy()
        edge[0] = edge[-1] = True
        st = w.copy()
        st[1:] &= ~w[:-1] | edge[1:-1]
        en = w.copy()
        en[:-1] &= ~w[1:] | edge[1:-1]
        s, e = np.flatnonzero(st), np.flatnonzero(en)
        if not len(s):
            continue
        pw, inv = _tables(b - a + 1, block)
        v = _LOWER[raw[a:b]].astype(U64)
        v += U64(1)
        v *= pw[:b - a]
        v[~w] = 0
        h = np.add.reduceat(v, s)
        h *= inv[s]
        h ^= (e - s + 1).astype(U64) << U64(56)
        hs.append(mix(h))
        ss.append(s + a)
        es.append(e + (a + 1))
    if not hs:
        return Words(np.zeros(0, U64), np.zeros(len(off), np.int64), np.zeros(0, U64))
    starts = np.concatenate(ss)
    return Words(np.concatenate(hs), np.searchsorted(starts, off).astype(np.int64),
                 _heads(raw, starts, np.concatenate(es)) if heads else None)


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive entries from each position (length ``len(h) - k + 1``)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = h[:m].copy()
    for j in range(1, k):
        out *= U64(_Q)
        out += h[j:j + m]
    return mix(out)


def whole(h: np.ndarray) -> int:
    """Hash of a whole short sequence, distinct from those of other lengths."""
    out = len(h) + 1
    for x in h.tolist():
        out = (out * _Q + x) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([out], dtype=U64))[0])


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingle hashes per text: ``(hashes, offsets)``, with repeats.

    A text of fewer than ``k`` words, but not none, has its whole sequence as its one shingle.
    """
    off = words.offsets
    n = np.diff(off)
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_off = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
    g = ngrams(words.hashes, k)
    out = np.zeros(out_off[-1], U64)
    long_ = np.flatnonzero(n >= k)
    if len(long_):
        keep = np.zeros(len(words.hashes) + 1, dtype=np.int32)
        np.add.at(keep, off[:-1][long_], 1)
        np.add.at(keep, off[1:][long_] - k + 1, -1)
        src = np.cumsum(keep[:-1]).astype(bool)
        dst = np.ones(out_off[-1], dtype=bool)
        dst[out_off[:-1][np.flatnonzero((n > 0) & (n < k))]] = False
        out[dst] = g[src[:len(g)]] if len(g) else g
    for i in np.flatnonzero((n > 0) & (n < k)):
        out[out_off[i]] = whole(words.hashes[off[i]:off[i + 1]])
    return out, out_off


def sort_unique(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort and deduplicate each segment of ``h``."""
    h = h.copy()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a > 1:
            h[a:b].sort()
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = h[1:] != h[:-1]
    keep[off[:-1][off[:-1] < len(h)]] = True
    sums = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)
    return h[keep], sums[off]


def segment_sum(v: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of each segment (0 for empty ones), modulo 2^64 for unsigned input."""
    c = np.concatenate([np.zeros(1, v.dtype), np.cumsum(v, dtype=v.dtype)])
    return c[off[1:]] - c[off[:-1]]


def regrouped(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.Table]:
    """Arrow tables of about ``size`` bytes: small batches joined, large ones cut (by rows)."""
    held, total = [], 0
    for b in batches:
        step = max(1, b.num_rows * size // max(b.nbytes, 1))
        for a in range(0, b.num_rows, step):
            part = b.slice(a, step)
            held.append(part)
            total += part.nbytes
            if total >= size:
                yield pa.Table.from_batches(held)
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_column(values: np.ndarray, off: np.ndarray, kind=None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32), pa.int32()), pa.array(values, kind))
