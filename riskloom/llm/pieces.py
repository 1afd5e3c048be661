"""Offset-preserving piece encoding and decoding (operator 10).

A text is normalised by longest-prefix matches in the model's compiled character map,
which records for every normalised byte where it came from. The library encodes, and
every piece is projected through that record to a span of the original bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.memo import Memo, segments
from riskloom.llm.textscan import text_bytes

BLANK = "▁".encode()


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(message):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = message[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = message[at : at + size], at + size
        yield key >> 3, value


class CharMap:
    """A model's normaliser: its character map and its rules for blanks."""

    def __init__(self, proto: bytes) -> None:
        spec = next((v for k, v in _fields(proto) if k == 3), b"")
        rules = dict(_fields(spec))
        blob = rules.get(2, b"")
        self.dummy_prefix = bool(rules.get(3, 1))
        self.squeeze = bool(rules.get(4, 1))
        self.escape = bool(rules.get(5, 1))
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int]:
        """What stands for the longest mapped prefix of ``text[at:]``, and its length;
        where none is mapped, the character itself. A broken byte gives U+FFFD."""
        found, node, units = None, 0, self.units
        if units:
            node ^= self._offset(units[0])
            for n in range(at, len(text)):
                node ^= text[n]
                unit = units[node]
                if unit & 0x800000FF != text[n]:
                    break
                node ^= self._offset(unit)
                if unit >> 8 & 1:
                    found = (units[node] & 0x7FFFFFFF, n + 1 - at)
        if found:
            begin = found[0]
            return self.texts[begin : self.texts.index(0, begin)], found[1]
        lead = text[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        char = text[at : at + size]
        try:
            char.decode()
        except UnicodeDecodeError:
            return "�".encode(), 1
        return char, size

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def normalise(self, text: bytes) -> tuple[bytes, list[int]]:
        """The normalised bytes, and for each of them, and the end, its original byte."""
        out, origin = bytearray(), []
        blank = BLANK if self.escape else b" "
        parts, at = [], 0
        while at < len(text):
            to, size = self.longest(text, at)
            parts.append((to, at, size))
            at += size
        if self.squeeze:  # blanks in front go
            while parts and parts[0][0] in (b" ", b""):
                parts.pop(0)
        end = len(text)
        if not parts:
            return b"", [end]
        begin = parts[0][1]
        if self.dummy_prefix:
            out += blank
            origin += [begin] * len(blank)
        after_blank = self.squeeze
        for to, at, _ in parts:
            while after_blank and to.startswith(b" "):
                to = to[1:]
            if not to:
                continue
            for byte in to:
                new = blank if byte == 0x20 else bytes([byte])
                out += new
                origin += [at] * len(new)
            after_blank = self.squeeze and to.endswith(b" ")
        if self.squeeze:
            while out.endswith(blank) and len(out) >= len(blank):
                del out[-len(blank) :]
                end = origin[len(out)]
                del origin[len(out) :]
        return bytes(out), [*origin, end]


class PieceEngine:
    """The library, its character map and a memo of distinct pieces of text."""

    def __init__(self, model: str, spans: bool) -> None:
        with open(model, "rb") as file:
            proto = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.map, self.spans = CharMap(proto), spans
        pieces = [dict(_fields(v)) for k, v in _fields(proto) if k == 1]
        kinds = [p.get(3, 1) for p in pieces]
        self.byte = np.array([k == 6 for k in kinds])
        self.size = np.array([1 if k == 6 else len(p[1]) for p, k in zip(pieces, kinds, strict=True)], np.int64)
        #: Whether texts may be encoded apart at single blanks.
        self.apart = (
            not self.map.units and self.map.dummy_prefix and self.map.escape and not self.map.squeeze
            and 4 not in kinds and 6 in kinds
            and not any(BLANK in p[1].lstrip(BLANK) for p in pieces if p.get(3, 1) == 1)
        )
        self.first_byte = int(np.flatnonzero(self.byte)[0]) if self.byte.any() else 0
        self.memo = Memo(self.encode, 3 if spans else 1)

    def encode(self, texts: list[bytes], first: np.ndarray) -> tuple:
        """Counts, ids and, if wanted, begin and end bytes of each piece's span."""
        # the library puts a blank in front of a text; it stands for the one cut off here
        whole = [(t if f else t[1:]).decode("utf-8", "replace") for t, f in zip(texts, first.tolist(), strict=True)]
        ids = self.library.encode(whole, num_threads=1)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(count.sum()))
        return (count, flat, *self.project(texts, first, count, flat)) if self.spans else (count, flat)

    def origins(self, texts: list[bytes], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each normalised byte of each text, and one place behind it, its original
        byte; and where each text's run of them begins."""
        if not self.apart:
            runs = [np.array(self.map.normalise(t)[1], np.int64) for t in texts]
            sizes = np.fromiter(map(len, runs), np.int64, len(runs))
            return np.concatenate([*runs, np.zeros(0, np.int64)]), np.cumsum(sizes) - sizes
        # blanks become three bytes, other bytes stay; the prefix of a text has three
        raw = np.frombuffer(b"".join(texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(texts)), size)
        value, times = np.zeros(len(raw) + 2 * len(texts), np.int64), np.zeros(len(raw) + 2 * len(texts), np.int64)
        at = np.arange(len(raw)) + 2 * owner + 1
        value[at], times[at] = np.arange(len(raw)) - begin[owner], np.where(raw == 0x20, len(BLANK), 1)
        head = begin + 2 * np.arange(len(texts))
        times[head] = np.where(first & (size > 0), len(BLANK), 0)
        value[head + size + 1], times[head + size + 1] = size, 1
        done = np.cumsum(times) - times
        return np.repeat(value, times), done[head]

    def project(self, texts: list[bytes], first: np.ndarray, count: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The original bytes of each piece. Of the byte pieces of one character only the
        last has its bytes; those before it are empty and stand where it begins."""
        origin, base = self.origins(texts, first)
        size = np.cumsum(self.size[ids])
        owner = np.repeat(np.arange(len(texts)), count)
        before = np.append(0, size)[np.cumsum(count) - count]
        stop = size - before[owner] + base[owner]
        start = stop - self.size[ids]
        last = np.append(base[1:], len(origin))[owner] - 1
        stop, start = np.minimum(stop, last), np.minimum(start, last)
        begin, end = origin[start], origin[stop]
        within = self.byte[ids] & (ids - self.first_byte >= 0x80) & (ids - self.first_byte < 0xC0)
        lead = np.maximum.accumulate(np.where(within, 0, np.arange(len(ids))))
        begin = np.where(self.byte[ids], begin[lead], begin)
        goes_on = np.append(within[1:], False) if len(ids) else within
        return begin, np.where(self.byte[ids] & goes_on, begin, end)


@lru_cache(4)
def engine(model: str, spans: bool) -> PieceEngine:
    return PieceEngine(model, spans)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each whole text: id_col, ids, begins, ends (bytes of the original text).

    A null or empty text has no piece. Any further columns are left behind, so their names
    can't clash; repeated rows are encoded each; a null id stays null. Very long texts
    are cut where pieces can't join, or else encoded whole. One row per input row.
    """
    schema = f"`{id_col}` long, ids array<int>, begins array<int>, ends array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(model, True)
        for batch in batches:
            for rows, arrays in encoded_rows(own, batch.column(1)):
                count = np.array([len(a[0]) for a in arrays])
                edges = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
                flat = [np.concatenate(x).astype(np.int32) for x in zip(*arrays, strict=True)]
                lists = [pa.ListArray.from_arrays(edges, pa.array(x)) for x in flat]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(rows[0], len(rows)), *lists], names=[id_col, "ids", "begins", "ends"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(work, schema)


def encoded_rows(own: PieceEngine, column: pa.Array) -> Iterator[tuple[range, list[list[np.ndarray]]]]:
    """Runs of rows with the ids, begins and ends of each."""
    data, starts = text_bytes(column)
    if not own.apart:
        raw = data.tobytes()
        for i in range(len(starts) - 1):
            _, *flat = own.encode([raw[starts[i] : starts[i + 1]]], np.array([True]))
            yield range(i, i + 1), [flat]
        return
    held: tuple[int, list] | None = None  # a long row that comes in parts
    for row, byte, edges in segments(data, starts):
        opens, closes = byte == starts[row], edges[-1] == starts[row + len(edges) - 1]
        piece_row, at, count, (ids, begins, ends) = own.memo.segment(data, edges, opens)
        shift = np.repeat(at + byte - starts[row + piece_row], count)
        flat = ids, begins + shift, ends + shift
        sizes = np.bincount(piece_row, weights=count, minlength=len(edges) - 1).astype(np.int64)
        cuts = np.cumsum(sizes)[:-1]
        rows = [list(x) for x in zip(*(np.split(a, cuts) for a in flat), strict=True)]
        if held:
            rows[0] = [np.concatenate(x) for x in zip(held[1], rows[0], strict=True)]
            held = None
        if not closes:
            held = row, rows[0]
            continue
        yield range(row, row + len(rows)), rows


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The library's text of each row's ids: id_col, decoded. No ids give an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = engine(model, False).library
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [library.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[id_col, "decoded"])

    return encoded.select(F.col(id_col).cast("long"), ids_col).mapInArrow(work, f"`{id_col}` long, decoded string")


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass, without sending the ids out and back:
    id_col, ids, begins, ends, decoded. Nulls, repeated rows and other columns are treated as in
    ``encode``; an empty table gives no row."""
    schema = f"`{id_col}` long, ids array<int>, begins array<int>, ends array<int>, decoded string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(model, True)
        for batch in batches:
            for rows, arrays in encoded_rows(own, batch.column(1)):
                edges = pa.array(np.concatenate([[0], np.cumsum([len(a[0]) for a in arrays])]), pa.int32())
                lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate(x).astype(np.int32))) for x in zip(*arrays, strict=True)]
                texts = own.library.decode([a[0].tolist() for a in arrays], num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(rows[0], len(rows)), *lists, pa.array(texts, pa.string())], names=[id_col, "ids", "begins", "ends", "decoded"]
                )

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(work, schema)
