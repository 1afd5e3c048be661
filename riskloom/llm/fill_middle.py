"""Fill-in-middle transformation (operator 12): cuts found in indexable skip lists.

The units of a text (its lines) are the nodes of a skip list. Every link, on the bottom lane
and on the express lanes above, carries its width in units and in code points, so walking down
to a rank gives the code points before it without counting them unit by unit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.textscan import mix, row_slices, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KEY, FIM_PERCENT, SPM_PERCENT = "7", 100, 50
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Lane(NamedTuple):
    """Links of one lane, one for each of its nodes, in order."""

    units: np.ndarray
    points: np.ndarray
    linked: np.ndarray  # whether a node of the same text follows
    down: np.ndarray  # the node's place on the lane below


class SkipLists:
    """One skip list for each text. ``units``: how many a text has; ``points``: the code points
    of all units, text after text. Each text begins with a head node, which is on all lanes;
    one node in four of a lane is also on the next."""

    def __init__(self, units: np.ndarray, points: np.ndarray) -> None:
        heads = np.cumsum(units + 1) - (units + 1)
        total = int(units.sum()) + len(units)
        is_head = np.zeros(total, bool)
        is_head[heads] = True
        follows = np.append(~is_head[1:], False)
        width = np.zeros(total, np.int64)
        width[follows] = points  # a node's link reaches over the unit that follows it
        number = np.arange(total) - np.repeat(heads, units + 1)
        tall = mix(number.astype(np.uint64) + _STEP)
        self.lanes = [Lane(follows.astype(np.int64), width, follows, np.arange(total))]
        head, level = is_head, 0
        while not head.all():
            below, level = self.lanes[-1], level + 1
            up = np.flatnonzero(head | (tall & np.uint64(3) == 0))
            # a link of the new lane is as wide as the links below it together
            units_up, points_up = (np.add.reduceat(x, up) for x in (below.units, below.points))
            head, tall = head[up], tall[up] >> np.uint64(2)
            if level % 24 == 0:  # fresh bits for lanes beyond the hash's own
                tall = mix(up.astype(np.uint64) + _STEP * np.uint64(level))
            self.lanes.append(Lane(units_up, points_up, np.append(~head[1:], False), up))

    def points_before(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Code points of the first ``rank`` units of each of the texts."""
        at, left, points = text.copy(), rank.copy(), np.zeros(len(rank), np.int64)
        for lane in reversed(self.lanes):
            while (go := lane.linked[at] & (lane.units[at] <= left)).any():
                left -= np.where(go, lane.units[at], 0)
                points += np.where(go, lane.points[at], 0)
                at = at + go
            at = lane.down[at]
        return points


def line_units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each row (each with its line end) and the code points of all lines."""
    if not len(data):
        return np.zeros(len(starts) - 1, np.int64), np.zeros(0, np.int64)
    opens = np.append(True, data[:-1] == 0x0A)
    edges = starts[:-1][np.diff(starts) > 0]
    opens[edges] = True
    begin = np.flatnonzero(opens)
    points = np.add.reduceat((data & 0xC0 != 0x80).astype(np.int64), begin)
    row = np.searchsorted(starts, begin, "right") - 1
    return np.bincount(row, minlength=len(starts) - 1), points


def draws(doc_id: int | None, key: str) -> tuple[int, ...]:
    """Four numbers that a document's id decides; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{key}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(docs: DataFrame, key: str = KEY, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output for each row of ``docs``
    (doc_id, text).

    Two ranks drawn from the id cut the lines into prefix, middle and suffix. psm gives
    ``<P>prefix<S>suffix<M>middle``, spm ``<S>suffix<P>prefix<M>middle``, plain the text. A text
    that is empty or holds a marker is plain, and one drawn out by ``fim_percent``; plain rows
    have null lengths. See ``restored`` for the way back.

    A null text is an empty one. A null doc_id draws as an empty id and stays null. Equal rows
    give equal rows. Whole texts are cut, however long. Other columns are left behind. An empty
    table gives no row.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            for first, last in row_slices(starts):
                raw, edges = data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
                units, points = line_units(raw, edges)
                ids = batch.column(0).slice(first, last - first)
                drawn = np.array([draws(i, key) for i in ids.to_pylist()], np.int64)
                cuts = np.sort(drawn[:, :2] % (units + 1)[:, None], axis=1)
                rows = np.arange(len(units))
                lists = SkipLists(units, points)
                low, high = (lists.points_before(rows, cuts[:, i]) for i in (0, 1))
                forms, outputs = [], []
                texts = batch.column(1).slice(first, last - first).fill_null("").to_pylist()
                for text, a, b, x, y in zip(texts, low.tolist(), high.tolist(), drawn[:, 2].tolist(), drawn[:, 3].tolist(), strict=True):
                    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or x % 100 >= fim_percent:
                        forms.append("plain")
                        outputs.append(text)
                    elif y % 100 < spm_percent:
                        forms.append("spm")
                        outputs.append("".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b])))
                    else:
                        forms.append("psm")
                        outputs.append("".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])))
                plain = np.array([f == "plain" for f in forms])
                arrays = [ids, pa.array(units), pa.array(forms), pa.array(low, mask=plain), pa.array(high - low, mask=plain), pa.array(outputs, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``transform`` was made from. The text holds no marker and no
    marker can begin inside another, so the first of each is the one that was put there."""
    first, last = len(PREFIX), len(MIDDLE)
    middle = F.instr(output, MIDDLE)

    def part(begin: Column | int, end: Column) -> Column:
        return F.substring(output, F.lit(begin) if isinstance(begin, int) else begin, end - begin)

    tail = F.substring(output, middle + last, F.length(output))
    other = F.instr(output, SUFFIX)
    psm = F.concat(part(first + 1, other), tail, part(other + len(SUFFIX), middle))
    own = F.instr(output, PREFIX)
    spm = F.concat(part(own + len(PREFIX), middle), tail, part(len(SUFFIX) + 1, own))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
