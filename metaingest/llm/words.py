"""Words of whole texts as byte spans, found and hashed with numpy.

Texts stay in their Arrow buffer. Words never cross texts; a null text is
empty. Hashes have 64 bits, so that equality of hashes stands for equality of
words throughout the operators.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_SPAN_BYTES = 1 << 18
_PRIME = 0x9E3779B97F4A7C15


def _not_in(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``
SPACED = _not_in((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased
ALPHANUMERIC = _not_in((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

#: A random odd value for each byte; A-Z have those of a-z in the second table.
EXACT = np.random.default_rng(20240601).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CASELESS = EXACT.copy()
CASELESS[65:91] = EXACT[97:123]


class Texts(NamedTuple):
    """Some whole texts: text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Spans of bytes; those of text ``i`` are ``first[i]`` to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def arrow_texts(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Consecutive rows ``low`` to ``high`` of at most ``limit`` bytes, or one longer row."""
    data, offsets = arrow_texts(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, rows)
        yield low, high, Texts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def find_words(texts: Texts, table: np.ndarray = SPACED, kinds: np.ndarray | None = None) -> Words:
    """Runs of the bytes in ``table``. With ``kinds``, a run is also cut where
    a byte of kind 1 meets one of kind 2."""
    data, offsets = texts
    inside = table[data]
    size = len(inside)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < size)]
    if kinds is not None:
        kind = kinds[data]
        borders = np.concatenate((borders, np.flatnonzero(kind[1:] * kind[:-1] == 2) + 1))
    opens[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(opens)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    up = np.full(length, _PRIME, np.uint64)
    down = np.full(length, pow(_PRIME, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = CASELESS) -> np.ndarray:
    """A hash of each span's bytes. Spans are in order and don't overlap."""
    out = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, base + _SPAN_BYTES, "right")))
        size = int(ends[high - 1] - base)
        up, down = _powers(_SPAN_BYTES + 1 if size <= _SPAN_BYTES else size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[base : base + size]] * up[:size], out=sums[1:])
        at = starts[low:high] - base
        out[low:high] = (sums[ends[low:high] - base] - sums[at]) * down[at]
        low = high
    return mix(out)


def chain(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` neighbours."""
    count = max(0, len(hashes) - length + 1)
    out = np.full(count, length, np.uint64)
    for k in range(length):
        out *= np.uint64(_PRIME)
        out += hashes[k : k + count]
    return mix(out)


def run_starts(words: Words, length: int) -> np.ndarray:
    """The words at which a run of ``length`` words of one text starts."""
    of = words.texts()
    count = max(0, len(of) - length + 1)
    return np.flatnonzero(of[:count] == of[length - 1 : length - 1 + count])


def release() -> None:
    """Give memory that is free in this Python worker back to the system.

    Workers outlive their tasks, and what one stage held would be missing in the next."""
    _powers.cache_clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def releasing(function: Callable) -> Callable:
    """A function over batches that ends with ``release``."""

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()

    return run


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """``values`` cut at ``first`` into one list a row."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
