"""Small numpy helpers over Arrow text columns, used inside tasks.

Texts are handled as one flat UTF-8 byte array per slice of an Arrow batch, so that
words, hashes and windows of many documents are found by array operations.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18          # bytes of text worked on at once (a longer text is worked on alone): each takes some hundred bytes of arrays

# Word classes: True where the byte belongs to a word.
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False                      # [^\x20\x09-\x0D]+
ALNUM_WORDS = np.zeros(256, bool)                                    # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_random = np.random.default_rng(20240229)
SYMBOL = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95      # odd, so invertible modulo 2^64
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64; kept and extended as longer inputs come."""
    got = _tables.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        got[0] = 1
        got = _tables[base] = np.multiply.accumulate(got)
    return got[:n]


def released(run: Callable) -> Callable:
    """A task's function over Arrow batches; when the task ends, what its arrays took goes back to the system. Workers live on for the
    next stages, and what they keep would add up with them."""
    @functools.wraps(run)
    def task(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _give_back()
    return task


def released_group(run: Callable) -> Callable:
    """The same for a function of one group's table."""
    @functools.wraps(run)
    def group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            _give_back()
    return group


def _give_back() -> None:
    _tables.clear()                                                  # soon made again
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)           # where the C library has it
    if trim is not None:
        trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any stretch of a symbol sequence, from prefix sums modulo 2^64."""

    def __init__(self, symbols: np.ndarray, base: int = _WORD_BASE):
        n = len(symbols)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _powers(base, n), out=self._sums[1:])
        self._inverse = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._inverse[start])

    def windows(self, length: int) -> np.ndarray:
        """The hash of each window of `length` symbols, by start."""
        n = len(self._sums) - 1
        if n < length:
            return np.zeros(0, np.uint64)
        return mixed((self._sums[length:] - self._sums[:n + 1 - length]) * self._inverse[:n + 1 - length])


def byte_rolling(data: np.ndarray) -> Rolling:
    return Rolling(SYMBOL[data], _BYTE_BASE)


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with at most `limit` bytes; null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_string())
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, at, body = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        own = offsets[row:end + 1]
        yield row, end, data[own[0]:own[-1]], own - own[0]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, firsts): byte spans of all words, and for each document its first word's number (one more entry than documents)."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return mixed(byte_rolling(data).of(starts, ends) + (ends - starts).astype(np.uint64))


def spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as maximal runs (adjoining spans become one)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    return starts[new], ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]]


def binary_column(parts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow binary column from its values' bytes, one after another, and their sizes."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(parts))])
