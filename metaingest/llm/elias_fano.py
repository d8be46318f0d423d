"""Elias-Fano sequences: sorted integers in about two bits each plus low bits.

A sequence is bytes that can lie in a memory-mapped file. The upper parts are
one bitmap, in which the i-th value sets bit ``upper + i``; the lower parts are
packed. The zeros of the bitmap, counted for each 64 bits, lead to the values
with a given upper part.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 17


class EliasFano:
    def __init__(self, count: int, width: int, lower: np.ndarray, upper: np.ndarray, zeros: np.ndarray):
        self.count, self.width = count, width
        self.lower, self.upper, self.zeros = lower, upper, zeros
        # Eight bytes from any byte on.
        self._words = np.ndarray((len(lower) - 7,), "<u8", lower, strides=(1,))

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values`` ascend, may repeat and are below ``universe``."""
        count = len(values)
        width = max(0, (universe // max(count, 1)).bit_length() - 1)
        highs = (values >> np.uint64(width)).astype(np.int64)
        size = count + (universe >> width) + 2
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[highs + np.arange(count)] = 1
        upper = np.packbits(bits, bitorder="little")
        zeros = 64 - bits.reshape(-1, 64).sum(1, dtype=np.int64)
        return cls(count, width, _pack(values, width), upper, np.concatenate(([0], np.cumsum(zeros))).astype(np.int64))

    def parts(self) -> list[np.ndarray]:
        return [self.lower, self.upper, self.zeros]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.width
        return (self._words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def _below(self, highs: np.ndarray) -> np.ndarray:
        """How many values have an upper part below each of ``highs``."""
        out = np.zeros(len(highs), np.int64)
        some = np.flatnonzero(highs > 0)
        for low in range(0, len(some), _CHUNK):
            part = some[low : low + _CHUNK]
            wanted = highs[part]  # the zero of this number ends the upper part before
            word = np.searchsorted(self.zeros, wanted, "left") - 1
            bits = np.unpackbits(self.upper.reshape(-1, 8)[word], axis=1, bitorder="little")
            seen = np.cumsum(bits == 0, axis=1, dtype=np.uint8)
            inside = (seen < (wanted - self.zeros[word])[:, None]).sum(1)
            out[part] = word * 64 + inside + 1 - wanted
        return out

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """Values by their number."""
        ones = np.concatenate(([0], np.cumsum(64 - np.diff(self.zeros))))
        out = np.empty(len(at), np.uint64)
        for low in range(0, len(at), _CHUNK):
            part = at[low : low + _CHUNK]
            word = np.searchsorted(ones, part, "right") - 1
            bits = np.unpackbits(self.upper.reshape(-1, 8)[word], axis=1, bitorder="little")
            seen = np.cumsum(bits, axis=1, dtype=np.uint8)
            inside = (seen <= (part - ones[word])[:, None]).sum(1)
            highs = word * 64 + inside - part
            out[low : low + _CHUNK] = (highs.astype(np.uint64) << np.uint64(self.width)) | self._lows(part)
        return out

    def successor(self, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of the first value from ``low`` to ``high`` that is not
        below ``wanted``; ``high`` if all are."""
        highs = (wanted >> np.uint64(self.width)).astype(np.int64)
        first = np.minimum(np.maximum(low, self._below(highs)), high)
        last = np.minimum(np.maximum(first, self._below(highs + 1)), high)
        lows = wanted & np.uint64((1 << self.width) - 1)
        while len(open_ := np.flatnonzero(first < last)):
            middle = (first[open_] + last[open_]) >> 1
            less = self._lows(middle) < lows[open_]
            first[open_[less]] = middle[less] + 1
            last[open_[~less]] = middle[~less]
        return first


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value, and eight bytes to read over."""
    out = np.zeros(-(-len(values) * width // 8) + 8, np.uint8)
    step = 1 << 16  # a multiple of 8, so that each part starts at a byte
    for low in range(0, len(values) if width else 0, step):
        part = values[low : low + step]
        bits = ((part[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bits.ravel(), bitorder="little")
        out[low * width // 8 : low * width // 8 + len(packed)] = packed
    return out
