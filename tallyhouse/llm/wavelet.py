"""Wavelet matrix: numbers stored as bit-planes with rank directories; access, counting and search need no other index.

File format (little-endian): magic, number of planes, length, documents; zeros per plane; then compressed parts, each
behind its length: documents' ids, a mask of null ids, documents' ends, and per plane its bits and its rank directory
(ones before every 512th bit).
"""

import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
STEP = 512


def _packed(array):
    data = zstandard.ZstdCompressor(level=1).compress(array.tobytes())
    return struct.pack("<Q", len(data)) + data


class WaveletMatrix:
    def __init__(self, length, zeros, planes, directories):
        self.length, self.zeros, self.planes, self.directories = length, zeros, planes, directories

    @classmethod
    def build(cls, values, bits):
        zeros, planes, directories = [], [], []
        for shift in range(bits - 1, -1, -1):
            ones = (values >> shift & 1).astype(bool)
            values = np.concatenate([values[~ones], values[ones]])
            plane = np.packbits(ones)
            padded = np.zeros(-(-len(plane) // (STEP // 8)) * (STEP // 8), np.uint8)
            padded[: len(plane)] = plane
            per_step = np.bitwise_count(padded.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1, dtype=np.int64)
            planes.append(plane)
            directories.append(np.r_[0, np.cumsum(per_step)].astype(np.uint32))
            zeros.append(len(ones) - int(per_step.sum()))
        return cls(len(values), zeros, planes, directories)

    def _rank1(self, level, at):
        """Ones before `at` in a plane."""
        full = at // STEP
        plane = self.planes[level][full * (STEP // 8) : at // 8 + 1]
        ones = int(self.directories[level][full])
        whole = at // 8 - full * (STEP // 8)
        ones += int(np.bitwise_count(plane[:whole]).sum())
        if at % 8:
            ones += int(plane[whole] >> (8 - at % 8)).bit_count()
        return ones

    def _select(self, level, bit, number):
        """Place of the `number`-th (from 0) zero or one of a plane."""
        table = self.directories[level].astype(np.int64)
        if not bit:
            table = np.minimum(np.arange(len(table)) * STEP, self.length) - table
        full = int(np.searchsorted(table, number, side="right")) - 1
        bits = np.unpackbits(self.planes[level][full * (STEP // 8) : (full + 1) * (STEP // 8)])
        return full * STEP + int(np.flatnonzero(bits == bit)[number - int(table[full])])

    def access(self, at):
        """The value at a place."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        value = 0
        for level, plane in enumerate(self.planes):
            bit = int(plane[at // 8] >> (7 - at % 8)) & 1
            ones = self._rank1(level, at)
            value = value << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return value

    def _range(self, value, start, stop):
        """Where the occurrences of a value in [start, stop) lie below the last plane."""
        if value >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = self._rank1(level, start), self._rank1(level, stop)
            if value >> (len(self.planes) - 1 - level) & 1:
                start, stop = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, value, start=0, stop=None):
        """Occurrences of a value in [start, stop)."""
        a, b = self._range(value, start, self.length if stop is None else stop)
        return b - a

    def select(self, value, number):
        """Place of the `number`-th occurrence, from 0."""
        a, b = self._range(value, 0, self.length)
        if not 0 <= number < b - a:
            raise IndexError(number)
        at = a + number
        for level in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, value):
        """Places of all occurrences, ascending."""
        return [self.select(value, k) for k in range(self.count(value))]

    def values(self):
        """All values in order: the planes undone from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        below = np.zeros(self.length, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.length).astype(bool)
            above = np.empty(self.length, kind)
            above[~ones] = below[: self.zeros[level]]
            above[ones] = below[self.zeros[level] :] | kind(1 << (len(self.planes) - 1 - level))
            below = above
        return below


def to_file(values, bits, doc_ids, ends):
    """The bytes of one file: values of the documents one after the other, with the documents' ids (None: null) and ends."""
    matrix = WaveletMatrix.build(values, bits)
    null = np.array([d is None for d in doc_ids], np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], np.int64)
    out = [MAGIC, struct.pack("<BQQ", bits, matrix.length, len(ids)), np.array(matrix.zeros, np.uint64).tobytes()]
    out += [_packed(ids), _packed(null), _packed(np.asarray(ends, np.int64))]
    for plane, directory in zip(matrix.planes, matrix.directories):
        out += [_packed(plane), _packed(directory)]
    return b"".join(out)


def from_file(data):
    """(matrix, doc_ids, ends) of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    bits, length, documents = struct.unpack_from("<BQQ", data, 4)
    at = 4 + 17
    zeros = [int(z) for z in np.frombuffer(data, np.uint64, bits, at)]
    at += 8 * bits

    def part(kind):
        nonlocal at
        (size,) = struct.unpack_from("<Q", data, at)
        raw = zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + size])
        at += 8 + size
        return np.frombuffer(raw, kind)

    ids, null, ends = part(np.int64), part(np.uint8), part(np.int64)
    planes, directories = [], []
    for _ in range(bits):
        planes.append(part(np.uint8))
        directories.append(part(np.uint32))
    return WaveletMatrix(length, zeros, planes, directories), [None if n else int(i) for i, n in zip(ids, null)], ends
