"""Vectorised text kernels shared by the operators of this subpackage.

All of them work on the flat UTF-8 buffer of an Arrow string column, so a batch of documents
costs a fixed number of numpy passes and no Python call per document or per word.
Nulls count as empty texts. Work is cut between rows into pieces of about ``PIECE`` bytes; a longer text is a piece of its own, so a task needs some
twenty times the bytes of its longest text, which Spark holds whole in any case.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
ROW_BITS = 20
LONG_WORD = 256
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
GOLD = np.uint64(0x9E3779B97F4A7C15)
_S33, _S29 = np.uint64(33), np.uint64(29)

#: ASCII white space parts words; with ``fold``, so does ASCII punctuation, and case is folded.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SPACE_OR_PUNCTUATION = SPACE.copy()
SPACE_OR_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain), in place."""
    h ^= h >> _S33
    h *= M1
    h ^= h >> _S29
    h *= M2
    h ^= h >> _S33
    return h


def seeded(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit words that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * GOLD + np.uint64(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE):
    """Row ranges of at most ``limit`` bytes and 2^ROW_BITS rows each, one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, i + (1 << ROW_BITS))
        yield i, j
        i = j


def lowered(data: np.ndarray) -> np.ndarray:
    """Folds the case of ASCII and of Latin-1 letters, which UTF-8 writes as C3 and one more byte."""
    out = LOWER[data]
    if len(out) > 1:
        at = np.flatnonzero(data[:-1] == 0xC3) + 1
        at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
        out[at] += 32
    return out


def words(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document and the number of all) of the words of all documents."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    gap = parts[data]
    starts = ~gap
    starts[1:] &= gap[:-1]
    ends = gap[1:] & ~gap[:-1]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    starts[edge] = ~gap[edge]  # the end of a document ends a word
    ends[edge - 1] = ~gap[edge - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    if not gap[-1]:
        end = np.append(end, n)
    return start, end, np.searchsorted(start, offsets)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; 8 bytes a step, and a digest for words beyond ``LONG_WORD`` bytes."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    wide = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    size = end - start
    h = size.astype(np.uint64) * GOLD
    h ^= wide[start] & _MASK[np.minimum(size, 8)]
    h *= M1
    h ^= h >> _S29
    at, step = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(at):
        x = h[at] ^ (wide[start[at] + step] & _MASK[np.minimum(size[at] - step, 8)])
        x *= M1
        x ^= x >> _S29
        h[at] = x
        step += 8
        at = at[size[at] > step]
    for k in np.flatnonzero(size > LONG_WORD):
        h[k] = np.frombuffer(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "<u8")[0]
    return mix(h)


def word_hashes(column: pa.Array, fold: bool = False):
    """Yields (first row, last row, hashes of the words, first word of each row ..., bytes, starts, ends) by pieces."""
    data, offsets = flat(column)
    for i, j in pieces(offsets):
        part = data[offsets[i] : offsets[j]]
        own = offsets[i : j + 1] - offsets[i]
        if fold:
            part = lowered(part)
        start, end, first = words(part, own, SPACE_OR_PUNCTUATION if fold else SPACE)
        yield i, j, hashes(part, start, end), first, part, start, end


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums by row of values given by word; empty rows have 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words that begin at each word, without regard to documents; the last n - 1 wrap and must be dropped."""
    k, out = 1, h.copy()
    left, at, acc = n, 0, None
    while left:  # doubling: a run of 2k words from two of k
        if left & 1:
            acc = out.copy() if acc is None else mix(acc * GOLD + np.roll(out, -at))
            at += k
        left >>= 1
        if left:
            out = mix(out * GOLD + np.roll(out, -k))
            k *= 2
    return acc


def running_max(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The running maximum of x within runs of equal group; x must be at least 0."""
    run = np.zeros(len(group), np.int64)
    run[1:] = np.cumsum(group[1:] != group[:-1])
    wide = int(x.max(initial=0)) + 1
    return np.maximum.accumulate(x + run * wide) - run * wide
