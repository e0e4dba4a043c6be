"""Elias-Fano sequences and an n-gram trie of them, in memory-mapped arrays.

A sorted sequence of n numbers below u keeps the lower log2(u/n) bits of each number packed, and the upper
parts in unary: bit (upper part + index) is set. A number's group by upper part is bounded by two zeros of that
bit string, found through counts per word, and then searched by lower bits. All operations take arrays.
"""

import os
import uuid

import numpy as np
from pyarrow import fs as pafs

from eventmart.llm.token_files import file_system

U = np.uint64
ONE = U(1)


def _packed(values, width):
    """Numbers of `width` bits, one after the other in 64-bit words."""
    n = len(values)
    out = np.zeros((n * width + 63) // 64 + 2, U)
    if n and width:
        at = np.arange(n, dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(U)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] = np.bitwise_or.reduceat(values << shift, first)
        last = np.append(first[1:], n) - 1
        over = last[shift[last].astype(np.int64) + width > 64]
        out[word[over] + 1] |= values[over] >> (U(64) - shift[over])
    return out


def _unpacked(words, width, index):
    if not width:
        return np.zeros(len(index), U)
    at = index.astype(np.int64) * width
    word, shift = at >> 6, (at & 63).astype(U)
    upper = np.where(shift > 0, words[word + 1] << ((U(64) - shift) & U(63)), U(0))
    return ((words[word] >> shift) | upper) & U((1 << width) - 1)


def _select(words, counts, rank):
    """Place of the set bit number `rank` (from 0); counts[i] is the number of set bits before word i."""
    word = np.searchsorted(counts, rank, "right") - 1
    left, bits, place = rank - counts[word], words[word].copy(), np.zeros(len(rank), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(bits & U((1 << half) - 1)).astype(np.int64)
        up = left >= low
        left = np.where(up, left - low, left)
        place += np.where(up, half, 0)
        bits = np.where(up, bits >> U(half), bits)
    return word * 64 + place


class Sequence:
    """A sorted sequence of numbers below `universe`. `arrays` are its parts, as written by `encode`."""

    def __init__(self, arrays):
        (self.n, self.width, self.groups), self._low, self._high, self._ones, self._zeros = (int(x) for x in arrays[0]), *arrays[1:]

    @staticmethod
    def encode(values, universe):
        n, values = len(values), values.astype(U)
        width = max(0, (max(1, int(universe)) // max(1, n)).bit_length() - 1)
        upper = (values >> U(width)).astype(np.int64)
        groups = int(universe) >> width
        bits = np.zeros(-(-(n + groups + 1) // 64) * 64, np.uint8)
        bits[upper + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        zeros = np.arange(len(ones)) * 64 - ones
        low = _packed(values & U((1 << width) - 1), width)
        return [np.array([n, width, groups]), low, high, ones, zeros]

    def __getitem__(self, index):
        """The numbers at an array of places."""
        upper = _select(self._high, self._ones, index) - index
        return (upper.astype(U) << U(self.width)) | _unpacked(self._low, self.width, index)

    def find(self, values):
        """(place of the first number that is not smaller, is it equal?) for each value below the universe."""
        values = values.astype(U)
        group = (values >> U(self.width)).astype(np.int64)
        lower = values & U((1 << self.width) - 1)
        flipped = ~self._high
        end = _select(flipped, self._zeros, group) - group
        start = np.where(group > 0, _select(flipped, self._zeros, np.maximum(group - 1, 0)) - (group - 1), 0)
        low, high = start, end.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            below = _unpacked(self._low, self.width, middle) < lower[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        equal = low < end
        equal[equal] = _unpacked(self._low, self.width, low[equal]) == lower[equal]
        return low, equal


class Mapped:
    """Arrays in one file of a shared folder, as read-only memory maps. The file loses its name once it is mapped, so a task
    that fails or runs again leaves nothing and meets nothing. In a store that is no mounted file system arrays stay in memory.
    """

    def __init__(self, arrays, folder):
        arrays = [np.ascontiguousarray(a) for a in arrays]
        system, root = file_system(folder)
        if not isinstance(system, pafs.LocalFileSystem):
            self.arrays = arrays
            return
        os.makedirs(root, exist_ok=True)
        path, places = f"{root}/{uuid.uuid4().hex}.levels", []
        try:
            with open(path, "wb") as file:
                for a in arrays:
                    file.write(b"\0" * (-file.tell() % 8))
                    places.append((file.tell(), a.dtype, a.shape))
                    file.write(a.tobytes())
                file.write(b"\0" * 8)
            self.arrays = [np.memmap(path, d, "r", at, shape) if np.prod(shape) else np.zeros(shape, d) for at, d, shape in places]
        finally:
            os.unlink(path)


class Trie:
    """Contexts, their successors, a quantised value per successor and one per context.

    Levels: the context keys; the successor keys of the whole trie, which numbers them; pointers from a context to
    its first successor, a monotone sequence; and all successors' numbers, each raised by its context's number
    times the size of the vocabulary, so that the level as a whole rises and a context's part of it is searched
    relative to the context.
    """

    def __init__(self, contexts, first, successors, values, backoffs, folder, context_bits=64, successor_bits=40):
        vocabulary = np.unique(successors)
        number = np.searchsorted(vocabulary, successors)
        owner = np.repeat(np.arange(len(contexts)), np.diff(first))
        self._size = max(1, len(vocabulary))
        levels = [
            Sequence.encode(contexts, 1 << context_bits), Sequence.encode(vocabulary, 1 << successor_bits),
            Sequence.encode(first, len(successors) + 1), Sequence.encode(owner * self._size + number, max(1, len(contexts)) * self._size)]
        mapped = Mapped([a for level in levels for a in level] + [values, backoffs], folder).arrays
        self._contexts, self._vocabulary, self._first, self._successors = (Sequence(mapped[5 * i:5 * i + 5]) for i in range(4))
        self._values, self._backoffs = mapped[20:]

    def look_up(self, contexts, successors):
        """(value, found?) per pair: the successor's value, or else the context's; value -1 without the context."""
        context, known = self._contexts.find(contexts)
        number, in_vocabulary = self._vocabulary.find(successors)
        value, found = np.full(len(context), -1, np.int64), np.zeros(len(context), bool)
        value[known] = self._backoffs[context[known]]
        ask = np.flatnonzero(known & in_vocabulary)
        if len(ask):
            place, equal = self._successors.find((context[ask] * self._size + number[ask]).astype(U))
            inside = equal & (place >= self._first[context[ask]].astype(np.int64)) & (place < self._first[context[ask] + 1].astype(np.int64))
            found[ask[inside]] = True
            value[ask[inside]] = self._values[place[inside]]
        return value, found
