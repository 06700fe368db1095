"""Texts in Arrow batches as flat numpy arrays: words, word hashes, shingle hashes.

All functions work on blocks of bounded size, so a task's memory does not depend
on how many rows Spark puts into a batch; one text is never cut.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
HASH_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)


def _powers(base, size):
    out = np.full(size, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, 1 << 16)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), 1 << 16)


def _grow(size):
    global _UP, _DOWN
    if len(_UP) < size:
        _UP = _powers(_BASE, size)
        _DOWN = _powers(pow(_BASE, -1, 1 << 64), size)


def mix(x):
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(seed):
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F + 2 * seed))


_CODES = [_byte_codes(seed) for seed in range(2)]


def flat(array):
    """Bytes and offsets of an Arrow text or binary array; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)
    offsets = offsets[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches, column, limit=BLOCK_BYTES):
    """Slices of record batches whose `column` holds at most `limit` bytes or is one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def words(data, offsets):
    """Start and end of every word, and for each text the number of words before it."""
    size = len(data)
    inside = ~SPACE[data]
    start, end = inside.copy(), inside
    if size:
        end = inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        first = offsets[:-1][offsets[:-1] < size]
        start[first] = inside[first]
        last = offsets[1:][offsets[1:] > 0] - 1
        end[last] = inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data, starts, ends, seed=0):
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + HASH_BYTES, "right")))
        part = data[low : ends[last - 1]]
        _grow(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_CODES[seed][part] * _UP[: len(part)], out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        lengths = (b - a).astype(np.uint64)
        out[first:last] = mix((sums[b] - sums[a]) * _DOWN[a] + lengths * _STEP)
        first = last
    return out


def range_hashes(values, first, last):
    """Hash of the sequence values[first:last] for each pair of positions."""
    _grow(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _UP[: len(values)], out=sums[1:])
    lengths = (last - first).astype(np.uint64)
    return mix((sums[last] - sums[first]) * _DOWN[first] + lengths * _STEP)


def gram_hashes(hashes, n):
    """Hash of every n consecutive words, regardless of text ends; len(hashes) - n + 1 of them."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out *= _STEP
        out += hashes[k : k + count]
    return mix(out + np.uint64(n))


def ragged(starts, lengths):
    """Concatenated ranges start, start + 1, ... of the given lengths."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    shift = np.asarray(starts, dtype=np.int64) - (np.cumsum(lengths) - lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, lengths)
