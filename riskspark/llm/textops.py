"""Vectorised text primitives over Arrow string batches (numpy inside Spark tasks).

A batch is cut into chunks of at most ``CHUNK`` bytes (a longer text is a chunk
of its own), so memory follows the chunk and not the batch.  Words, shingles and
lines are byte spans of the chunk; their 64-bit hashes are polynomial hashes
modulo 2**64 read off one running sum, then mixed with the span's length.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
#: odd base, its inverse modulo 2**64, and odd mixing multipliers
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


class _Cache(dict):
    """Tables built once per process; travels empty to the workers."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every input bit."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= MIX1
    h ^= h >> np.uint64(27)
    h *= MIX2
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int):
    have = _POWERS.get("n", 0)
    if have < n:
        size = max(n, CHUNK + 1)
        up, down = np.full(size, BASE, np.uint64), np.full(size, BASE_INV, np.uint64)
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down),
                       byte=mix(np.arange(1, 513, dtype=np.uint64)).reshape(2, 256))
    return _POWERS["up"], _POWERS["down"], _POWERS["byte"]


def chunks(column, size: int = CHUNK):
    """Yield (first row, last row, bytes as uint8, offsets) over an Arrow string array; null is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + size, "right")) - 1)
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def spans(keep: np.ndarray, offsets: np.ndarray):
    """Maximal runs of ``keep`` inside each text: (starts, ends, text index of each run)."""
    n = len(keep)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(n + 1, bool)          # the byte begins a text (or lies behind the last one)
    first[offsets[:-1]] = True
    first[n] = True
    starts = keep.copy()
    starts[1:] &= ~keep[:-1] | first[1:n]
    ends = keep.copy()
    ends[:-1] &= ~keep[1:] | first[1:n]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every byte span; ``seed`` 0 or 1 gives two independent hashes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down, byte = _powers(len(data) + 1)
    byte = byte[seed]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX2)


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True):
    """``[^\x20\x09-\x0D]+`` words: (hash, text index, start, end); ``fold`` lower-cases A-Z."""
    s, e, t = spans(~SPACE[data], offsets)
    return hashes(FOLD[data] if fold else data, s, e), t, s, e


def shingles(h: np.ndarray, t: np.ndarray, n_texts: int, k: int = 5):
    """Hashes of every k consecutive words per text; a text of 1..k-1 words is one shingle.

    Returns (hash, text index, index of the first word).
    """
    if len(h) == 0:
        return h, t, np.zeros(0, np.int64)
    count = np.bincount(t, minlength=n_texts)
    begin = np.cumsum(count) - count
    at = np.arange(len(h))
    left = begin[t] + count[t] - at                    # words from here to the end of the text
    head = at[(left >= k) | ((at == begin[t]) & (count[t] < k))]
    size = np.minimum(left[head], k)
    mult = mix(np.arange(101, 101 + k, dtype=np.uint64)) | np.uint64(1)
    out = size.astype(np.uint64) * MIX1
    for j in range(k):
        ok = j < size
        out[ok] += mix(h[head[ok] + j] + mult[j]) * mult[j]
    return mix(out), t[head], head


def distinct(h: np.ndarray, t: np.ndarray):
    """Distinct (text, hash) pairs, sorted by text then hash."""
    o = np.argsort(h, kind="stable")
    o = o[np.argsort(t[o].astype(np.uint16) if len(t) and t.max() < 65536 else t[o], kind="stable")]
    h, t = h[o], t[o]
    if len(h) == 0:
        return h, t
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], t[new]
