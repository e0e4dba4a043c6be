"""Words of whole texts as arrays: positions and 64-bit hashes, over the bytes of many texts at once.

A word is a run of bytes other than the six ASCII white-space bytes; with `lower`, A-Z count as a-z. UTF-8
keeps both properties byte by byte. A word's hash is a polynomial over its bytes, taken from one
running sum over the whole buffer, and then mixed.
"""

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts are taken together up to this size; a longer text is taken alone
SLICE_ROWS = 4000      # fewer than 1 << 12
U = np.uint64
MULTIPLIER = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240101)).integers(0, 1 << 64, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x):
    """A well spread 64-bit value for each 64-bit value."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


class Hasher:
    """Powers of the multiplier, kept between slices."""

    def __init__(self):
        self._up = self._down = np.ones(1, U)

    def _powers(self, n):
        if len(self._up) < n:
            size = max(n, SLICE_BYTES * 5 // 4)
            self._up = np.cumprod(np.concatenate([np.ones(1, U), np.full(size, MULTIPLIER, U)]))
            self._down = np.cumprod(np.concatenate([np.ones(1, U), np.full(size, INVERSE, U)]))
        return self._up, self._down

    def hashes(self, data, starts, ends):
        """Hash of data[s:e] for each pair."""
        if not len(starts):
            return np.zeros(0, U)
        up, down = self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=total[1:])
        return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


class Words:
    """Words of consecutive texts. `first[i]:first[i + 1]` are the words of text i."""

    def __init__(self, data, offsets, hasher, lower):
        self.data, self.offsets = data, offsets
        space = SPACE[data]
        edge = np.empty(len(data) + 1, bool)
        edge[:-1] = ~space
        edge[-1] = False
        starts = edge.copy()
        starts[1:] &= ~edge[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        starts[inner] = edge[inner]  # a word ends with its text
        ends = edge.copy()
        ends[:-1] &= ~edge[1:] | starts[1:]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.hash = hasher.hashes(LOWER[data] if lower else data, self.starts, self.ends)

    @property
    def doc(self):
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def shingles(self, n):
        """(hash, number of the text, position in it) of every n consecutive words of one text."""
        doc, total = self.doc, len(self.hash)
        if total < n:
            return np.zeros(0, U), doc[:0], doc[:0]
        h = np.zeros(total - n + 1, U)
        for i in range(n):
            h = h * MULTIPLIER + self.hash[i:total - n + 1 + i]
        inside = np.flatnonzero(doc[:total - n + 1] == doc[n - 1:])
        return mixed(h[inside]), doc[inside], inside - self.first[doc[inside]]


def buffers(column):
    """(bytes, offsets) of an Arrow string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, "<i8")[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, "<i8")
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(column, hasher, lower=True, limit=SLICE_BYTES, rows=SLICE_ROWS):
    """(first row, row after the last, Words) over a column, in slices of bounded size."""
    data, offsets = buffers(column)
    at = 0
    while at < len(offsets) - 1:
        upto = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1), at + rows)
        part = offsets[at:upto + 1]
        yield at, upto, Words(data[part[0]:part[-1]], part - part[0], hasher, lower)
        at = upto


def segment_sums(values, bounds):
    """Sums of values[bounds[i]:bounds[i + 1]]; empty segments give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[bounds[1:]] - total[bounds[:-1]]
