"""Encode each distinct piece of text once, and put documents together from the results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from riskloom.llm.textscan import SLICE_BYTES, hash_spans, mix

_FIRST = np.uint64(0xA0761D6478BD642F)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: Lead bytes of all characters beyond ASCII that some library takes for white space.
_DOUBT = np.zeros(256, bool)
_DOUBT[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def safe_breaks(data: np.ndarray) -> np.ndarray:
    """Positions of single blanks between two characters that surely aren't white space.

    Neither a byte-level nor a piece vocabulary whose tokens hold blanks only in front
    joins anything across such a place, so both sides can be encoded apart.
    """
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    doubt = (before >= 0x80) & (_DOUBT[data[at - 2]] | _DOUBT[data[np.maximum(at - 3, 0)]])
    return at[~(_WHITE[before] | _WHITE[after] | _DOUBT[after] | doubt)]


def segments(data: np.ndarray, starts: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray]]:
    """Balanced pieces of work: (first row, first byte, row starts within and the end).

    Rows are gathered up to ``limit`` bytes. A longer row is cut at safe breaks, so
    it comes as several segments of the same row.
    """
    row, last = 0, len(starts) - 1
    while row < last:
        end = int(np.searchsorted(starts, starts[row] + limit, "right")) - 1
        if end > row:
            yield row, int(starts[row]), starts[row : end + 1]
            row = end
            continue
        begin, stop = int(starts[row]), int(starts[row + 1])
        while stop - begin > limit:
            cut, look = None, begin + limit
            while cut is None and look < stop:
                near = safe_breaks(data[look - 4 : min(look + 65536, stop)]) + look - 4
                near = near[near > look]
                cut = int(near[0]) if len(near) else None
                look += 65530
            if cut is None:
                break
            yield row, begin, np.array([begin, cut])
            begin = cut
        yield row, begin, np.array([begin, stop])
        row += 1


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, where one of each stands, and for each value its place among them."""
    order = np.argsort(h)
    ordered = h[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(h)]
    back = np.empty(len(h), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


class Memo:
    """Remembers what ``encode`` gave for each distinct piece between safe breaks.

    ``encode(pieces, first)`` gets byte strings (with their leading blank, but for the
    piece that begins a text: ``first``) and returns a count for each, and equally long
    flat arrays. Entries are found by a 64-bit hash. When they outgrow ``limit`` values
    all are forgotten, so memory is bounded whatever the text.
    """

    def __init__(self, encode: Callable, arrays: int = 1, limit: int = 2_000_000) -> None:
        self.encode, self.arrays, self.limit = encode, arrays, limit
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = [np.zeros(0, np.int32) for _ in range(self.arrays)]

    def segment(self, data: np.ndarray, starts: np.ndarray, opens: bool) -> tuple:
        """Of the rows that start at ``starts``: (row, byte in the segment, count) of each
        piece, and the flat arrays of all pieces in order. opens: the first row begins here
        (and isn't the rest of a cut row)."""
        base = int(starts[0])
        data, starts = data[base : int(starts[-1])], starts - base
        rows_begin = starts[:-1][np.diff(starts) > 0]
        is_first, is_begin = np.zeros(len(data) + 1, bool), np.zeros(len(data), bool)
        is_first[rows_begin] = is_begin[rows_begin] = True
        breaks = safe_breaks(data)
        is_begin[breaks[~is_first[breaks + 1]]] = True
        begin = np.flatnonzero(is_begin)
        if not len(begin):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, [np.zeros(0, np.int32) for _ in range(self.arrays)]
        end = np.append(begin[1:], len(data))
        row = np.searchsorted(starts, begin, "right") - 1
        first = is_first[begin]
        if not opens and begin[0] == 0:
            first[0] = False
        h = hash_spans(data, begin, end)
        h = np.where(first, mix(h ^ _FIRST), h)
        keys, where, back = distinct(h)
        get = self.slots.get
        slot = np.array([get(k, -1) for k in keys.tolist()], np.int64)
        if (slot < 0).any() and sum(map(len, self.flat[:1])) > self.limit:
            self.forget()
            slot[:] = -1
        lack = np.flatnonzero(slot < 0)
        if len(lack):
            raw, at = data.tobytes(), where[lack]
            pieces = [raw[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            count, *flat = self.encode(pieces, first[at])
            have = len(self.count)
            self.begin = np.concatenate([self.begin, len(self.flat[0]) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = [np.concatenate([a, np.asarray(b, np.int32)]) for a, b in zip(self.flat, flat, strict=True)]
            self.slots.update(zip(keys[lack].tolist(), range(have, have + len(lack)), strict=True))
            slot[lack] = np.arange(have, have + len(lack))
        count = self.count[slot][back]
        total = int(count.sum())
        shift = self.begin[slot][back] - (np.cumsum(count) - count)
        index = np.repeat(shift, count) + np.arange(total)
        return row, begin, count, [a[index] for a in self.flat]
