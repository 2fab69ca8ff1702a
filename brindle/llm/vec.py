"""Vectorised scanning of UTF-8 text that lies in Arrow buffers.

Words are maximal runs of ASCII letters and digits and of code points from 128 on, with A-Z
lower-cased; in UTF-8 that is a property of single bytes, so one table look-up per byte finds them.
Hashes are 64-bit polynomials over random byte values, made from prefix sums, then mixed.
All work goes through segments of 128 KB, which a core's cache holds, so memory does not follow a text's length
except for eight to twenty bytes a word.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEGMENT = 1 << 17
CHUNK = 1 << 20

_BYTE = np.arange(256)
WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def series(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


_BASE = U(0xD6E8FEB86659FD93)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_GRAM = U(0xA0761D6478BD642F)
BYTES = series(1, 256)
LOWER_BYTES = BYTES[LOWER]
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(max(n, SEGMENT + 4096), base, U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U)
    return _powers[0], _powers[1]


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.empty(len(values) + 1, U)
    out[0] = 0
    np.cumsum(values * _power(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def trim() -> None:
    """Give freed memory back to the system, as workers stay alive between tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(offsets: np.ndarray, limit: int = CHUNK):
    """Row ranges of at most limit bytes, or of one row; memory goes back after the last."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi
    trim()


def words(data: np.ndarray, offsets: np.ndarray):
    """Start, end, hash and row of each word; a word never crosses rows."""
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    starts, ends, hashes = [], [], []
    lo = 0
    while lo < n:
        hi = min(n, lo + SEGMENT)
        while hi < n:  # on to where a word can break
            w = WORD[data[hi - 1 : hi + 4096]]
            cut = np.flatnonzero(~(w[1:] & w[:-1]) | first[hi : hi + len(w) - 1])
            if len(cut):
                hi += int(cut[0])
                break
            hi += len(w) - 1
        part = data[lo:hi]
        w = WORD[part]
        inner = first[lo + 1 : hi]
        s, e = w.copy(), w.copy()
        s[1:] &= ~w[:-1] | inner
        e[:-1] &= ~w[1:] | inner
        s, e = np.flatnonzero(s), np.flatnonzero(e) + 1
        sums = _prefix(LOWER_BYTES[part])
        hashes.append(mix((sums[e] - sums[s]) * _power(len(part) + 1)[1][s]))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U), z
    s = np.concatenate(starts)
    return s, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(offsets, s, "right") - 1


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive values."""
    if len(hashes) < n:
        return np.zeros(0, U)
    g = hashes[: len(hashes) - n + 1].copy()
    for j in range(1, n):
        g *= _GRAM
        g += hashes[j : j + len(g)]
    return mix(g)


def stir(x: np.ndarray) -> np.ndarray:
    """A lighter mix, enough to order hashes."""
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(32)
    return x


def window_hashes(data: np.ndarray, n: int, values: np.ndarray = BYTES, spread=mix) -> np.ndarray:
    """A hash of each n consecutive bytes; data should be a segment, not a whole corpus."""
    if len(data) < n:
        return np.zeros(0, U)
    sums = _prefix(values[data])
    x = sums[n:] - sums[:-n]
    x *= _power(len(sums))[1][: len(sums) - n]
    return spread(x)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = BYTES) -> np.ndarray:
    """A hash of the bytes of each span; data should be a segment."""
    sums = _prefix(values[data])
    return mix((sums[end] - sums[start]) * _power(len(sums))[1][start] + (end - start).astype(U))


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive values."""
    have = 1
    while have * 2 <= n:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return x if have == n else np.minimum(x[: len(x) - (n - have)], x[n - have :])


def row_shingles(hashes: np.ndarray, row: np.ndarray, n: int = 5):
    """Hash and row of each n-word shingle, in order; a row of fewer words, but not none, has one shingle of them all."""
    full = grams(hashes, n)
    ok = row[: len(full)] == row[n - 1 :] if len(full) else np.zeros(0, bool)
    g, r = full[ok], row[: len(full)][ok]
    if not len(hashes):
        return g, r
    begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size = np.diff(np.r_[begin, len(row)])
    short = size < n
    if short.any():
        begin, size = begin[short], size[short]
        h = np.zeros(len(begin), U)
        for j in range(n - 1):
            some = size > j
            h[some] = h[some] * _GRAM + hashes[begin[some] + j]
        g, r = np.concatenate([g, mix(h + size.astype(U))]), np.concatenate([r, row[begin]])
        order = np.argsort(r, kind="stable")
        g, r = g[order], r[order]
    return g, r


def distinct_per_row(g: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row."""
    order = np.lexsort((g, r))
    g, r = g[order], r[order]
    if len(g):
        keep = np.r_[True, (g[1:] != g[:-1]) | (r[1:] != r[:-1])]
        g, r = g[keep], r[keep]
    return g, r


def packed(values: list[np.ndarray | bytes]) -> pa.Array:
    return pa.array([v if isinstance(v, bytes) else v.tobytes() for v in values], pa.binary())
