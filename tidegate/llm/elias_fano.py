"""Monotone integer sequences in Elias-Fano form, queried for many places at once.

A sequence of ``n`` ascending values below ``u`` takes about ``2 + log2(u / n)`` bits a value:
the low bits are packed, the high bits are a unary bitmap. A directory of ones per 64-bit
word serves both selections. Sequences live in one array of 64-bit words, so that they
can be written to a file and memory-mapped.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_HEADER = 4


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits each, packed into 64-bit words, with one spare word."""
    words = np.zeros((len(values) * width + 63) // 64 + 1, np.uint64)
    if width and len(values):
        bit = np.arange(len(values), dtype=np.int64) * width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        spill = np.flatnonzero(shift + _U(width) > 64)
        np.bitwise_or.at(words, word[spill] + 1, values[spill] >> (_U(64) - shift[spill]))
    return words


def _unpack(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.uint64)
    bit = index * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
    return (low | high) & _U((1 << width) - 1)


#: Place of the k-th set bit of a byte, at byte * 8 + k.
_IN_BYTE = np.zeros(2048, np.int64)
for _byte in range(256):
    for _k, _place in enumerate(i for i in range(8) if _byte >> i & 1):
        _IN_BYTE[_byte * 8 + _k] = _place
_ONES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with ``rank`` set bits before it."""
    rank = rank.astype(np.uint64)
    pairs = word - ((word >> _U(1)) & _U(0x5555555555555555))
    fours = (pairs & _U(0x3333333333333333)) + ((pairs >> _U(2)) & _U(0x3333333333333333))
    upto = ((fours + (fours >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES  # byte i: set bits of bytes 0 to i
    passed = (((rank * _ONES) | _TOPS) - upto) & _TOPS  # bytes that end before the bit
    place = np.bitwise_count(passed).astype(np.uint64) * _U(8)
    before = ((upto << _U(8)) >> place) & _U(255)
    inside = ((word >> place) & _U(255)) * _U(8) + (rank - before)
    return place.astype(np.int64) + _IN_BYTE[inside.astype(np.int64)]


def encode(values: np.ndarray, universe: int) -> np.ndarray:
    """Words that hold ascending ``values`` below ``universe``."""
    n = len(values)
    width = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
    values = values.astype(np.uint64)
    high = (values >> _U(width)).astype(np.int64) + np.arange(n)
    size = n + (int(universe) >> width) + 1
    bitmap = np.zeros((size + 63) // 64, np.uint64)
    np.bitwise_or.at(bitmap, high >> 6, _U(1) << (high & 63).astype(np.uint64))
    ones = np.zeros(len(bitmap) + 1, np.uint64)
    np.cumsum(np.bitwise_count(bitmap), out=ones[1:])
    low = _pack(values & _U((1 << width) - 1), width)
    head = np.array([n, width, len(bitmap), len(low)], np.uint64)
    return np.concatenate([head, bitmap, ones, low])


class Sequence:
    """An encoded sequence at a place of an array of words, which may be memory-mapped."""

    def __init__(self, words: np.ndarray, at: int = 0):
        self.n, self.width, size, low = (int(x) for x in words[at:at + _HEADER])
        begin = at + _HEADER
        self.bitmap = words[begin:begin + size]
        self.ones = words[begin + size:begin + 2 * size + 1]
        self.low = words[begin + 2 * size + 1:begin + 2 * size + 1 + low]
        self.stop = begin + 2 * size + 1 + low
        self._zeros = None

    def _select1(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, rank.astype(np.uint64), "right") - 1
        return word * 64 + _select_in_word(self.bitmap[word], rank - self.ones[word].astype(np.int64))

    def _select0(self, rank: np.ndarray) -> np.ndarray:
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        word = np.searchsorted(self._zeros, rank, "right") - 1
        return word * 64 + _select_in_word(~self.bitmap[word], rank - self._zeros[word])

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = index.astype(np.int64)
        if not len(index):
            return np.zeros(0, np.uint64)
        high = (self._select1(index) - index).astype(np.uint64)
        return (high << _U(self.width)) | _unpack(self.low, index, self.width)

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First index and end of the values with the given high bits."""
        beyond = high >= len(self.bitmap) * 64 - self.n
        inside = np.where(beyond, 0, high)
        place = np.where(inside > 0, self._select0(np.maximum(inside - 1, 0)) + 1, 0)
        left = ~self.bitmap[place >> 6] >> (place & 63).astype(np.uint64)
        stop = place + np.bitwise_count(~left & (left - _U(1)))  # the next zero, mostly in the same word
        far = np.flatnonzero(left == 0)
        stop[far] = self._select0(inside[far])
        end = np.minimum(stop - inside, self.n)
        return np.where(beyond, self.n, place - inside), np.where(beyond, self.n, end)

    def _search(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the first value at or above each target, the end of its bucket, and its low bits."""
        index, end = self._bucket((target >> _U(self.width)).astype(np.int64))
        low = target & _U((1 << self.width) - 1)
        stop = end.copy()
        open_ = np.flatnonzero(index < stop)
        while len(open_):  # halve what is left of each bucket
            middle = (index[open_] + stop[open_]) >> 1
            above = _unpack(self.low, middle, self.width) < low[open_]
            index[open_] = np.where(above, middle + 1, index[open_])
            stop[open_] = np.where(above, stop[open_], middle)
            open_ = open_[index[open_] < stop[open_]]
        return index, end, low

    def successor(self, target: np.ndarray) -> np.ndarray:
        """Index of the first value at or above each target; ``n`` where there is none."""
        if not len(target) or not self.n:
            return np.zeros(len(target), np.int64)
        return self._search(target.astype(np.uint64))[0]

    def find(self, target: np.ndarray) -> np.ndarray:
        """Index of each target in a strictly ascending sequence; -1 where it is missing."""
        out = np.full(len(target), -1, np.int64)
        if len(target) and self.n:
            index, end, low = self._search(target.astype(np.uint64))
            there = np.flatnonzero(index < end)
            hit = there[_unpack(self.low, index[there], self.width) == low[there]]
            out[hit] = index[hit]
        return out
