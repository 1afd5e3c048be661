"""Benchmark decontamination (operator 13): one Aho-Corasick automaton over normalised items.

Letters of the automaton are numbered words: a text's words are hashed in its bytes, numbered
by the items' vocabulary, and the automaton reads the numbers once. Its matches are word
positions, which the words' places in the bytes map back to the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch
from riskloom.llm.textscan import LOWER, hash_spans, per_row, row_slices, spans, text_bytes

WINDOW = 10
#: Words of items in one automaton (about ten nodes of 50 bytes each); more items take more
#: automata, one after another. Longer items are cut into pieces that overlap.
AUTOMATON_WORDS, PIECE_WORDS = 200_000, 4096
#: Sets of windows whose items a worker remembers.
REMEMBERED = 10_000

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end, row and hash of each word (ASCII letters and digits, and all beyond ASCII;
    hashed in ASCII lower case)."""
    begin, end, row = spans(WORD[data], starts)
    return begin, end, row, hash_spans(LOWER[data], begin, end)


def item_pieces(items: DataFrame, window: int) -> DataFrame:
    """item (the id as text), words, hashes: each item's words in pieces of bounded length. All
    windows of an item lie within a piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            for first, last in row_slices(starts):
                edges = starts[first : last + 1] - starts[first]
                _, _, row, h = words(data[starts[first] : starts[last]], edges)
                at = np.searchsorted(row, np.arange(last - first + 1))
                own, pieces = [], []
                for i in range(last - first):
                    n = int(at[i + 1] - at[i])
                    for k in range(-(-max(1, n - window + 1) // PIECE_WORDS) if n else 0):
                        begin = int(at[i]) + k * PIECE_WORDS
                        own.append(first + i)
                        pieces.append(h[begin : min(begin + PIECE_WORDS + window - 1, int(at[i + 1]))])
                arrays = [batch.column(0).take(pa.array(own, pa.int64())), pa.array([len(p) for p in pieces], pa.int64()), pa.array([p.astype("<u8").tobytes() for p in pieces], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["item", "words", "hashes"])

    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string"))
    return own.mapInArrow(work, "item string, words long, hashes binary")


class Windows:
    """The automaton of all windows of the pieces, and the items each window stands in."""

    def __init__(self, pieces: list[tuple[str, bytes]], window: int) -> None:
        self.names = sorted({item for item, _ in pieces})
        rank = {item: i for i, item in enumerate(self.names)}
        hashes = [np.frombuffer(h, "<u8") for _, h in pieces]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        numbers: dict[tuple[int, ...], int] = {}
        owners: list[set[int]] = []
        for (item, _), h in zip(pieces, hashes, strict=True):
            ids = self.number(h).tolist()
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                key = tuple(ids[i : i + size])
                if (at := numbers.setdefault(key, len(owners))) == len(owners):
                    owners.append(set())
                    self.automaton.add_word(key, at)
                owners[at].add(rank[item])
        self.owners = [np.fromiter(o, np.int64) for o in owners]
        self.sizes = np.array([len(k) for k in numbers], np.int64)
        self.shortest = int(self.sizes.min()) if len(self.sizes) else 0
        self.remembered: dict[bytes, list[str]] = {}
        if owners:
            self.automaton.make_automaton()

    def number(self, h: np.ndarray) -> np.ndarray:
        """The number of each word, from 1; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, 0)

    def candidates(self, ids: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Rows with as many known words in a run as the shortest window has. Only they can
        hold one."""
        if not self.shortest or len(ids) < self.shortest:
            return np.zeros(0, np.int64)
        gaps = np.append(0, np.cumsum(ids == 0))
        k = self.shortest
        run = (gaps[k:] == gaps[:-k]) & (row[k - 1 :] == row[: len(row) - k + 1])
        return np.flatnonzero(per_row(row[: len(run)][run], rows))

    def items(self, found: np.ndarray) -> list[str]:
        """The names of the items that hold any of the windows, in order."""
        key = found.tobytes()
        if (known := self.remembered.get(key)) is None:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            ranks = np.unique(np.concatenate([self.owners[i] for i in found.tolist()]))
            known = self.remembered[key] = [self.names[i] for i in ranks.tolist()]
        return known


_BUILT: dict[str, Windows] = {}


def _windows(token: str, shared, window: int) -> Windows:
    """The automaton of a broadcast, built once in each worker."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Windows(shared.value, window)
    return _BUILT[token]


SPAN = "struct<first:long, last:long, begin:long, end:long>"


def scan(docs: DataFrame, pieces: list[tuple[str, bytes]], window: int, keys: str) -> DataFrame:
    """For each row of ``docs`` (the columns ``keys``, then text): n_words, spans, items. See
    ``contamination``."""
    shared, token = docs.sparkSession.sparkContext.broadcast(pieces), uuid4().hex
    columns = docs.columns[:-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _windows(token, shared, window)
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "begin", "end")]))
        for batch in batches:
            data, starts = text_bytes(batch.column(len(columns)))
            for first, last in row_slices(starts):
                raw, edges, n = data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], last - first
                begin, end, row, h = words(raw, edges)
                ids = own.number(h)
                at = np.searchsorted(row, np.arange(n + 1))
                found, names = [[] for _ in range(n)], [[] for _ in range(n)]
                for i in own.candidates(ids, row, n).tolist():
                    a, b = int(at[i]), int(at[i + 1])
                    matches = list(own.automaton.iter(tuple(ids[a:b].tolist())))
                    if not matches:
                        continue
                    last_word, number = np.array(matches, np.int64).T
                    change = np.zeros(b - a + 1, np.int64)
                    np.add.at(change, last_word + 1 - own.sizes[number], 1)
                    np.add.at(change, last_word + 1, -1)
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])))
                    points = np.cumsum(np.append(0, raw[edges[i] : edges[i + 1]] & 0xC0 != 0x80))
                    found[i] = [
                        {"first": s, "last": e, "begin": int(points[begin[a + s] - edges[i]]), "end": int(points[end[a + e - 1] - edges[i]])}
                        for s, e in edge.reshape(-1, 2).tolist()
                    ]
                    names[i] = own.items(np.unique(number))
                kept = batch.slice(first, n)
                made = [pa.array(per_row(row, n)), pa.array(found, kind), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*kept.columns[: len(columns)], *made], names=[*columns, "n_words", "spans", "items"])

    return docs.mapInArrow(work, f"{keys}, n_words long, spans array<{SPAN}>, items array<string>")


def numbered(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + batch.num_rows)), *batch.columns], names=["_row", *batch.schema.names])
            number += batch.num_rows

    return docs.mapInArrow(work, "_row long, doc_id long, text string")


def merged(spans_of_all: str):
    """Spans of several passes as one list in which they neither overlap nor touch."""
    last = lambda acc: F.try_element_at(acc, F.lit(-1))

    def add(acc, x):
        joined = F.struct(
            last(acc)["first"].alias("first"), F.greatest(last(acc)["last"], x["last"]).alias("last"),
            last(acc)["begin"].alias("begin"), F.greatest(last(acc)["end"], x["end"]).alias("end"),
        )
        apart = (F.size(acc) == 0) | (x["first"] > last(acc)["last"])
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)))

    return F.aggregate(F.array_sort(spans_of_all), F.array().cast(f"array<{SPAN}>"), add)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans, items for each row of ``docs`` (doc_id, text), against ``items``
    (item_id, text).

    A window is ``window`` consecutive words of an item; an item of fewer words is one window.
    spans are the maximal runs of words inside any occurrence of a window: first and last word
    (last not included) and the code points of the original text from begin to end. items are
    the ids, as texts and in their order, of all items with an occurring window.

    Texts are read whole and once for each automaton (AUTOMATON_WORDS). Null and empty texts,
    of documents and items, have no words; so has every document where ``items`` is empty. A
    null doc_id stays null; a null item_id counts as an empty one; rows that repeat an item_id
    are one item with several texts. Repeated documents come back each. Other columns are left
    behind, so their names can't clash. No documents give no row. Words are compared by 64-bit
    hashes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    pieces = scratch.write(item_pieces(items, window), "pieces")
    total = pieces.agg(F.sum("words")).first()[0] or 0
    automata = -(-total // AUTOMATON_WORDS) or 1
    part = F.pmod(F.xxhash64("item", "hashes"), F.lit(automata))
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if automata > 1:
        docs = scratch.write(numbered(docs), "documents")
    keys = "doc_id long" if automata == 1 else "_row long, doc_id long"
    passes = []
    for k in range(automata):
        own = [(r.item, bytes(r.hashes)) for r in pieces.filter(part == k).select("item", "hashes").distinct().collect()]
        passes.append(scan(docs, own, window, keys))
    if automata == 1:
        return passes[0]
    made = passes[0]
    for other in passes[1:]:
        made = made.union(other)
    made = made.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
    return made.select("doc_id", "n_words", merged("s").alias("spans"), F.array_sort(F.array_distinct("i")).alias("items"))


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
