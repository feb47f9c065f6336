"""Byte-level text kernels on numpy arrays, shared by the corpus operators.

Texts arrive as Arrow string columns. The kernels look at their UTF-8 bytes: all
separators used here are ASCII, so a byte table finds the same words as a scan
over code points. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
#: Bytes of text that are looked at together; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 18
#: Odd bases of the polynomial hashes modulo 2**64, and their inverses.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: True for bytes of words that white space ends.
WORD_BY_SPACE = ~_WHITE
#: True for bytes of words of letters and digits; every byte of a character beyond ASCII counts.
WORD_ALNUM = np.zeros(256, bool)
WORD_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER_BYTES = LOWER.tobytes()


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, row after the last, bytes, offsets."""
    data, offsets = texts(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


#: The lowest 0 to 8 bytes of a word.
_LOWEST = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)
#: Words up to so many bytes are hashed together, eight bytes at a time; longer ones one by one.
LONG_WORD = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, every eight of them mixed in by a bijection; equal words get equal hashes."""
    size = ends - starts
    out = mix(size.astype(U64) + U64(BASE))
    if not len(starts):
        return out
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), U64, wide, strides=(1,))  # the eight bytes from each place on
    some, at = np.arange(len(starts)), 0
    while len(some) and at < LONG_WORD:
        some = some[size[some] > at]
        part = eight[starts[some] + at] & _LOWEST[np.minimum(size[some] - at, 8)]
        out[some] = mix(out[some] * U64(BASE) ^ part)
        at += 8
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 1)
    return out


_powers = (np.ones(1, U64), np.ones(1, U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; kept up to a few chunks, since a task uses them again."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (BASE, BASE_INV):
        p = np.full(n, base, U64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= 4 * CHUNK_BYTES:
        _powers = (made[0], made[1])
    return made[0], made[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span: equal spans, wherever they stand, get equal hashes.

    A polynomial modulo 2**64, which patterned spans of about a thousand values can
    make collide; it is for short spans of hashes, such as grams of words.
    """
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    v = values.astype(U64) + U64(1)
    if salt:
        v = mix(v ^ U64(salt))
    np.cumsum(v * up[:-1], out=total[1:])
    out = (total[ends] - total[starts]) * down[starts]
    return mix(out ^ (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    step, m = 1, x
    while 2 * step <= w:
        m = np.minimum(m[: len(m) - step], m[step:])
        step *= 2
    return np.minimum(m[:n], m[w - step : w - step + n])


def sliding_max(x: np.ndarray, w: int) -> np.ndarray:
    return ~sliding_min(~x, w)
