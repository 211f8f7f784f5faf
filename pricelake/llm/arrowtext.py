"""Vectorised text primitives over Arrow string columns.

An Arrow string column is one byte buffer plus offsets, so a whole batch of
documents is tokenised and hashed with a handful of numpy passes and no
Python loop over words. Every function here works inside a Spark task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a single longer document is handled alone.
CHUNK_BYTES = 1 << 20

_U = np.uint64
#: Multiplier of the polynomial hashes (5 mod 8) and its inverse mod 2**64.
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_table(chars: bytes) -> np.ndarray:
    """A 256-entry mask that is True at the given byte values."""
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: White space of the word rule ``[^\x20\x09-\x0D]+``: every other byte is a word byte.
WORD_BYTES = ~byte_table(b" \t\n\x0b\x0c\r")

#: A-Z to a-z on UTF-8 bytes, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_null(column.type):
        column = pa.array([None] * len(column), pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    bufs = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(bufs[1], np.int64, n + 1, column.offset * 8)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """Row ranges (lo, hi) of at most ``size`` bytes, or one row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray):
    """Maximal runs of bytes in ``mask`` that stay inside one row.

    Returns (starts, ends, first): run i is ``data[starts[i]:ends[i]]`` and
    row r owns the runs ``first[r]:first[r + 1]``.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = mask[data]
    cut = offsets[:-1][offsets[:-1] < n]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[cut] = inside[cut]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = cut[cut > 0] - 1
    end[last] = inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads a polynomial hash over all bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """1, B, B**2, ... (or of B's inverse) mod 2**64; kept and grown by doubling."""
    key = "inv" if inverse else "pow"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        steps = np.full(size, _BASE_INV if inverse else _BASE, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if size <= 8 * CHUNK_BYTES:
            _POWERS[key] = have
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: P[j] = sum of values[i] * B**i for i < j."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def span_hash(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each values[start:end] from their prefix sums; the same values
    have the same hash wherever they stand."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    h = (p[ends] - p[starts]) * powers(len(p), True)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xA0761D6478BD642F))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word data[start:end]."""
    return span_hash(prefix(_BYTE_VALUES[data]), starts, ends)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Starts of all runs of ``width`` consecutive items inside one row, where
    row r owns items first[r]:first[r + 1]."""
    n = int(first[-1])
    if n < width:
        return np.zeros(0, np.int64)
    counts = np.diff(first)
    ok = np.ones(n, bool)
    # the last width - 1 items of each row start no window
    tail = np.minimum(counts, width - 1)
    stop = np.zeros(n + 1, np.int64)
    np.add.at(stop, first[1:] - tail, 1)
    np.add.at(stop, first[1:], -1)
    ok &= np.cumsum(stop)[:n] == 0
    return np.flatnonzero(ok)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    if len(values) < width:
        return np.zeros(0, values.dtype)
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    if rest:
        out = np.minimum(out[:-rest], out[rest:])
    return out


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the n items covered by the windows that start at ``starts``."""
    d = np.zeros(n + 1, np.int32)
    if len(starts):
        np.add.at(d, starts, 1)
        np.add.at(d, np.minimum(starts + width, n), -1)
    return np.cumsum(d[:n]) > 0


def rows_of(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The row that owns each item."""
    return np.searchsorted(first, items, side="right") - 1


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first minimum of each ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    at, have = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64), 1

    def join(left, right):
        return np.where(values[right] < values[left], right, left)

    while have * 2 <= width:
        at = join(at[:-have], at[have:])
        have *= 2
    rest = width - have
    if rest:
        at = join(at[:-rest], at[rest:])
    return at


def words_of(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray = WORD_BYTES, lower: bool = False):
    """(hashes, first, starts, ends) of the words of all rows: row r owns the
    words first[r]:first[r + 1]. Byte-long arrays exist for a chunk at a time."""
    hs, ss, es, first = [], [], [], [np.zeros(1, np.int64)]
    count = 0
    for lo, hi in chunks(offsets):
        base = offsets[lo]
        sub = data[base:offsets[hi]]
        if lower:
            sub = LOWER[sub]
        s, e, f = spans(sub, offsets[lo:hi + 1] - base, mask)
        hs.append(word_hashes(sub, s, e))
        ss.append(s + base)
        es.append(e + base)
        first.append(f[1:] + count)
        count += len(s)
    z = np.zeros(0, np.int64)
    return (np.concatenate(hs) if hs else np.zeros(0, np.uint64), np.concatenate(first),
            np.concatenate(ss) if ss else z, np.concatenate(es) if es else z)


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i], ..., starts[i] + lens[i] - 1."""
    if not len(lens) or not lens.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lens), lens)
