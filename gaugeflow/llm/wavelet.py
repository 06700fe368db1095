"""A wavelet matrix of token ids in one compressed file.

The ids are kept as bit planes, the highest bit first. After each plane the ids are
reordered, those with a 0 first, so that all ids of one value end up side by side. A
plane is cut into blocks that are compressed one by one, each with the number of ones
before it; rank and select open only the blocks that they need. From the planes come
the id at a position, the number of times that an id occurs in a range, and the
positions at which it occurs, without unpacking the rest.

Layout: magic, length and check sum of the head (32 bits each), head (JSON), blocks in
order of plane and place, names (JSON) and lengths (64-bit numbers) of the documents, all
compressed. The head has the sizes and check sums of the others.
"""

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard

MAGIC = b"WAVELET1"
BLOCK_BITS = 1 << 19
_LENGTH = struct.Struct("<I")
_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


class Damaged(ValueError):
    """The bytes are not a whole wavelet file."""


def narrow(most):
    """The smallest kind of number that holds ids up to `most`."""
    return np.uint16 if most < 1 << 16 else np.uint32


def filtered(values, mask):
    """The values whose bit is set in `mask`, a bitmap."""
    bits = pa.Array.from_buffers(pa.bool_(), len(values), [None, pa.py_buffer(mask)])
    return pa.array(values).filter(bits).to_numpy()


def unpacked(data, size):
    return np.unpackbits(np.frombuffer(data, np.uint8), count=size, bitorder="little").view(bool)


def encode(ids, names, lengths, **extra):
    """The file of `ids` (an array), which belong to documents `names` of the given lengths.

    `names` are texts or None; `extra` goes into the head. No ids, no planes.
    """
    most = int(np.max(ids, initial=0))
    level = np.ascontiguousarray(ids, dtype=narrow(most))
    planes, body, size = [], [], len(level)
    for bit in reversed(range(most.bit_length())):
        ones = np.packbits((level & level.dtype.type(1 << bit)) != 0, bitorder="little")
        blocks, before = [], 0
        for first in range(0, len(ones), BLOCK_BITS // 8):
            part = ones[first : first + BLOCK_BITS // 8]
            data = _PACK.compress(part.tobytes())
            blocks.append((len(data), zlib.crc32(data), before))
            body.append(data)
            before += int(np.bitwise_count(part).sum())
        planes.append({"zeros": size - before, "blocks": blocks})
        level = np.concatenate([filtered(level, ~ones), filtered(level, ones)])
    tail = [_PACK.compress(json.dumps(names).encode()), _PACK.compress(np.asarray(lengths, "<i8").tobytes())]
    head = _PACK.compress(json.dumps({
        **extra, "tokens": size, "docs": len(names), "planes": planes,
        "tail": [(len(t), zlib.crc32(t)) for t in tail],
    }).encode())
    check = _LENGTH.pack(zlib.crc32(head))
    return b"".join([MAGIC, _LENGTH.pack(len(head)), check, head, *body, *tail])


def read_head(data):
    """The head of a file, and where its blocks begin."""
    data, first = memoryview(data), len(MAGIC) + 2 * _LENGTH.size
    if bytes(data[: len(MAGIC)]) != MAGIC or len(data) < first:
        raise Damaged("no wavelet file")
    (size,), (check,) = _LENGTH.unpack_from(data, len(MAGIC)), _LENGTH.unpack_from(data, first - 4)
    head = data[first : first + size]
    if len(head) != size or zlib.crc32(head) != check:
        raise Damaged("damaged head")
    return json.loads(_UNPACK.decompress(head)), first + size


class Plane:
    """One bit plane: bits, rank and select over arrays of positions, block by block."""

    def __init__(self, data, at, size, zeros, blocks):
        self.data, self.size, self.zeros = data, size, zeros
        self.at = at + np.cumsum([0, *(b[0] for b in blocks)])
        self.checks = [b[1] for b in blocks]
        self.ones = np.array([*(b[2] for b in blocks), size - zeros], dtype=np.int64)
        self.opened = {}

    def stored(self, k):
        data = self.data[self.at[k] : self.at[k + 1]]
        if zlib.crc32(data) != self.checks[k]:
            raise Damaged(f"damaged block {k}")
        return _UNPACK.decompress(data)

    def block(self, k):
        """The bits of block k; the last one opened is kept."""
        if k not in self.opened:
            self.opened = {k: unpacked(self.stored(k), min(BLOCK_BITS, self.size - k * BLOCK_BITS))}
        return self.opened[k]

    def bits(self):
        return unpacked(b"".join(map(self.stored, range(len(self.checks)))), self.size)

    def bits_and_ranks(self, positions):
        """The bit at each position below the size, and the number of ones before each."""
        positions = np.asarray(positions, dtype=np.int64)
        bits, ranks = np.zeros(len(positions), bool), np.full(len(positions), self.ones[-1])
        places = positions // BLOCK_BITS
        for k in np.unique(places[positions < self.size]):
            block, at = self.block(int(k)), np.flatnonzero((places == k) & (positions < self.size))
            inside = positions[at] - k * BLOCK_BITS
            bits[at] = block[inside]
            if len(at) > 2:
                sums = np.cumsum(block, dtype=np.int64) - block
                ranks[at] = self.ones[k] + sums[inside]
            else:
                ranks[at] = [self.ones[k] + np.count_nonzero(block[:i]) for i in inside]
        return bits, ranks

    def select(self, bit, numbers):
        """Positions of the bits of a kind with the given numbers, counted from 0."""
        numbers = np.asarray(numbers, dtype=np.int64)
        starts = np.arange(len(self.checks), dtype=np.int64) * BLOCK_BITS
        before = self.ones[:-1] if bit else starts - self.ones[:-1]
        places = np.searchsorted(before, numbers, "right") - 1
        out = np.empty(len(numbers), dtype=np.int64)
        for k in np.unique(places):
            at = np.flatnonzero(places == k)
            out[at] = starts[k] + np.flatnonzero(self.block(int(k)) == bit)[numbers[at] - before[k]]
        return out


class Wavelet:
    """A file's contents: `access`, `count`, `locate`, `ids`, and its documents."""

    def __init__(self, data):
        self.data = memoryview(data)
        self.head, at = read_head(self.data)
        self.size, self.planes = self.head["tokens"], []
        for plane in self.head["planes"]:
            self.planes.append(Plane(self.data, at, self.size, plane["zeros"], plane["blocks"]))
            at = int(self.planes[-1].at[-1])
        parts = []
        for size, check in self.head["tail"]:
            part = self.data[at : at + size]
            if zlib.crc32(part) != check:
                raise Damaged("damaged documents")
            parts.append(_UNPACK.decompress(part))
            at += size
        self.end = at
        self.names = json.loads(parts[0])
        self.lengths = np.frombuffer(parts[1], "<i8")
        self.starts = np.cumsum(self.lengths) - self.lengths

    def access(self, positions):
        """The ids at positions from 0 to the size."""
        positions = np.asarray(positions, dtype=np.int64)
        if len(positions) and not 0 <= positions.min() <= positions.max() < self.size:
            raise IndexError("position outside the file")
        out = np.zeros(len(positions), dtype=np.uint32)
        for plane in self.planes:
            bits, ranks = plane.bits_and_ranks(positions)
            out = out << np.uint32(1) | bits
            positions = np.where(bits, plane.zeros + ranks, positions - ranks)
        return out

    def interval(self, token, first=0, last=None):
        """Where the occurrences of `token` in a range of positions stand below the last plane."""
        ends = np.array([first, self.size if last is None else last], dtype=np.int64)
        if token < 0 or int(token).bit_length() > len(self.planes):
            return 0, 0
        for k, plane in enumerate(self.planes):
            ranks = plane.bits_and_ranks(ends)[1]
            one = token >> (len(self.planes) - 1 - k) & 1
            ends = plane.zeros + ranks if one else ends - ranks
        return int(ends[0]), int(ends[1])

    def count(self, token, first=0, last=None):
        """How often `token` occurs from position `first` to before `last`."""
        low, high = self.interval(token, first, last)
        return high - low

    def locate(self, token, first=0, last=None):
        """The positions of `token` in a range, in ascending order."""
        at = np.arange(*self.interval(token, first, last), dtype=np.int64)
        for k, plane in reversed(list(enumerate(self.planes))):
            one = bool(token >> (len(self.planes) - 1 - k) & 1)
            at = plane.select(one, at - plane.zeros if one else at)
        return np.sort(at)

    def ids(self):
        """All ids in their order: the planes are put together from the last to the first."""
        out = np.zeros(self.size, dtype=narrow((1 << len(self.planes)) - 1))
        for k, plane in reversed(list(enumerate(self.planes))):
            bits, level = plane.bits(), np.empty_like(out)
            ones = out[plane.zeros :]
            ones |= out.dtype.type(1 << (len(self.planes) - 1 - k))
            for mask, values in ((~bits, out[: plane.zeros]), (bits, ones)):
                if len(values):
                    np.place(level, mask, values)
            out = level
        return out.astype(np.uint32)
