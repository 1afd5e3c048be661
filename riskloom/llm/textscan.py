"""Words and their hashes straight from the bytes of an Arrow text column (numpy)."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task.
SLICE_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S29 = np.uint64(33), np.uint64(29)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and where each row starts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def row_slices(starts: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``limit`` bytes; a longer row stands alone."""
    row, last = 0, len(starts) - 1
    while row < last:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        yield row, end
        row = end


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S29)) * _M2
    return h ^ (h >> _S33)


def spans(is_word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of word bytes; no run crosses a row's start."""
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1]
    last[:-1] &= ~is_word[1:]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(is_word))]
    first[edges] = is_word[edges]
    last[edges - 1] = is_word[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes a step."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), buffer=padded, strides=(1,))
    size = end - begin
    h = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, left, rows = begin, size, None
    while len(at):
        keep = np.minimum(left, 8).astype(np.uint64)
        part = eight[at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * keep))
        part = np.where(keep == 0, np.uint64(0), part)
        if rows is None:
            h = mix(h ^ part)
        else:
            h[rows] = mix((h[rows] * _M2) ^ part)
        more = left > 8
        rows = np.flatnonzero(more) if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def per_row(rows: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sums (or counts) of span values for each of ``count`` rows."""
    return np.bincount(rows, weights=weights, minlength=count).astype(np.int64)


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work``, after which a task gives its free memory back to the machine. Workers live on
    from stage to stage, and what they keep would count against each later one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library

    return run
