"""Elias-Fano sequences in numpy: monotone integers in compact arrays that can be memory-mapped.

Of n values below a universe U the low ``l`` = log2(U / n) bits are packed; the high parts are a unary
bit vector, with counts of ones before each 64-bit word for selecting. Every query is vectorised.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Place of the k-th one in a byte (8 if there is none).
SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8)] for b in range(256)], dtype=np.uint8)
POPCOUNT = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits (at most 57) one after another in 64-bit words, and a spare word."""
    words = np.zeros(len(values) * width // 64 + 3, U64)
    if width and len(values):
        at = np.arange(len(values), dtype=U64) * U64(width)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        words[word[first]] |= np.add.reduceat(values << shift, first)  # their bits are apart: adding is joining
        over = shift + U64(width) > U64(64)
        words[word[over] + 1] |= values[over] >> (U64(64) - shift[over])
    return words


def unpack(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), U64)
    at = index.astype(np.int64) * width
    every_byte = np.ndarray((len(words) * 8 - 7,), "<u8", buffer=words.data, strides=(1,))
    return (every_byte[at >> 3] >> (at & 7).astype(U64)) & U64((1 << width) - 1)


class EliasFano:
    """A sequence that never falls; ``arrays`` is all that is stored."""

    def __init__(self, n: int, width: int, arrays: dict[str, np.ndarray]):
        self.n, self.width = n, width
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]
        self.zeros = None

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        values = values.astype(U64)
        width = max(0, (universe // max(1, n)).bit_length() - 1)
        if width > 57:
            raise ValueError("the universe is too large for so few values")
        high = (values >> U64(width)).astype(np.int64)
        bits = np.zeros(((int(high[-1]) if n else 0) + n + 2 + 63) // 64 * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))).astype(np.uint32)
        return cls(n, width, {"low": pack(values & U64((1 << width) - 1), width), "high": words, "ones": ones})

    @property
    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones}

    def _select(self, k: np.ndarray, before: np.ndarray, flip: int) -> np.ndarray:
        """Place of the k-th one (``flip`` 0) or zero (``flip`` 255) of the high bits."""
        word = np.searchsorted(before, k, "right") - 1
        left = (k - before[word]).astype(np.int64)
        parts = np.ascontiguousarray(self.high[word]).view(np.uint8).reshape(-1, 8) ^ np.uint8(flip)
        sums = np.cumsum(POPCOUNT[parts], axis=1, dtype=np.int64)
        byte = (sums <= left[:, None]).sum(axis=1).clip(max=7)
        row = np.arange(len(k))
        left -= sums[row, byte] - POPCOUNT[parts[row, byte]]
        return word * 64 + byte * 8 + SELECT[parts[row, byte], left.clip(0, 7)]

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, U64)
        high = self._select(index, self.ones, 0) - index
        return (high.astype(U64) << U64(self.width)) | unpack(self.low, self.width, index)

    def find(self, keys: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The index of the first value equal to each key, or -1: successor search within the keys' high part.

        With ``first`` and ``end`` only indices from ``first`` to before ``end`` are searched, for each key its own.
        """
        keys = np.asarray(keys, U64)
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not len(keys):
            return out
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        high, low = (keys >> U64(self.width)).astype(np.int64), keys & U64((1 << self.width) - 1)
        there = np.flatnonzero((high >= 0) & (high < int(self.zeros[-1])))  # a high part that the sequence reaches
        h = high[there]
        start = np.where(h > 0, self._select(np.maximum(h - 1, 0), self.zeros, 255) - h + 1, 0)
        stop = np.minimum(self._select(h, self.zeros, 255) - h, self.n)
        if first is not None:
            start, stop = np.maximum(start, first[there]), np.minimum(stop, end[there])
        last = stop
        key = low[there]
        while len(open_ := np.flatnonzero(start < stop)):
            mid = (start[open_] + stop[open_]) >> 1
            less = unpack(self.low, self.width, mid) < key[open_]
            start[open_] = np.where(less, mid + 1, start[open_])
            stop = stop.copy()
            stop[open_] = np.where(less, stop[open_], mid)
        inside = np.flatnonzero(start < last)
        hit = inside[unpack(self.low, self.width, start[inside]) == key[inside]]
        out[there[hit]] = start[hit]
        return out
