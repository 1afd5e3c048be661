"""Packing of documents into sequences (operator 7): shortest pack first over the histogram."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import byte_tokens
from riskloom.llm.store import Scratch
from riskloom.llm.textscan import releasing

END_ID = 1
MAX_TOKENS = 2048
#: Pieces of one task that are ranked in one group.
BUCKET_ROWS = 100_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``max_tokens`` and a rest. _part
    and _at number them within the task that made them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, made, task = byte_tokens.engine(vocabulary), 0, TaskContext.get().partitionId()
        for batch in batches:
            doc, start, length, crc, tokens = [], [], [], [], []
            ids_of = batch.column(0).to_pylist()
            for rows, arrays in byte_tokens.token_rows(own, batch.column(1)):
                for row, ids in zip(rows, arrays, strict=True):
                    raw = memoryview(np.append(ids, np.uint32(end_id)).astype("<u4").tobytes())
                    n = len(ids) + 1
                    for at in range(0, n, max_tokens):
                        part = raw[4 * at : 4 * (at + max_tokens)]
                        doc.append(ids_of[row])
                        start.append(at)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        tokens.append(n)
            columns = (doc, start, length, crc, tokens, [task] * len(doc), range(made, made + len(doc)))
            made += len(doc)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_part", "_at"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(work), f"{PIECES}, _part long, _at long")


def pack_histogram(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, count, first sequence, offset).

    Lengths are placed longest first. Each joins the shortest packs that exist, as long as
    it fits there; what finds no place opens new packs. Packs of equal content are one
    pattern with a count, so the work grows with the number of lengths, not of documents.
    """
    patterns: list[tuple[tuple[int, ...], int]] = []
    shortest: list[tuple[int, int]] = []  # (filled, pattern)

    def put(content: tuple[int, ...], count: int) -> None:
        patterns.append((content, count))
        heapq.heappush(shortest, (sum(content), len(patterns) - 1))

    for length in sorted(histogram, reverse=True):
        left, made = histogram[length], []
        while left and shortest and shortest[0][0] + length <= max_tokens:
            _, k = heapq.heappop(shortest)
            content, count = patterns[k]
            # as many of this length as the pack holds, so that equal pieces need few steps
            many = min((max_tokens - sum(content)) // length, max(1, left // count))
            take = min(count, left // many)
            left -= take * many
            made.append((content + (length,) * many, take))
            patterns[k] = (content, count - take)
            if count > take:
                heapq.heappush(shortest, (sum(content), k))
        if left:
            many = max(1, min(max_tokens // length, left))
            if left // many:
                made.append(((length,) * many, left // many))
            if left % many:
                made.append(((length,) * (left % many), 1))
        for content, count in made:
            put(content, count)
    placed, ranks, sequence = [], dict.fromkeys(histogram, 0), 0
    for content, count in patterns:
        offset = 0
        for length in content if count else ():
            placed.append((length, ranks[length], count, sequence, offset))
            ranks[length] += count
            offset += length
        sequence += count
    return placed


def assign(pieces: DataFrame, scratch: Scratch, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Adds sequence_id and offset to pieces, by the rank of each among those of its length.

    The histogram on the driver has at most ``max_tokens`` rows. Ranks are counted within
    (length, bucket) groups and shifted by the rows of earlier buckets. Buckets are stretches of
    BUCKET_ROWS pieces of the task that made them, so no length and no row, however often it is
    repeated, meets in one task.
    """
    total = pieces.count()
    keyed = pieces.withColumn("_bucket", F.struct("_part", F.floor(F.col("_at") / BUCKET_ROWS).alias("_stretch")))
    counts = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placed = np.array(pack_histogram(histogram, max_tokens) or np.zeros((0, 5)), np.int64)
    placed = placed[np.lexsort((placed[:, 1], placed[:, 0]))]
    # one ascending key for (length, rank): ranks are below the row count
    lookup = pieces.sparkSession.sparkContext.broadcast((placed[:, 0] * (total + 1) + placed[:, 1], placed))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("_at")
    ranked = keyed.withColumn("_rank", F.row_number().over(order) - 1).join(shifts, ["length", "_bucket"])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = lookup.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            slot = np.searchsorted(keys, length * (total + 1) + rank, "right") - 1
            sequence = table[slot, 3] + rank - table[slot, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(table[slot, 4])], names=[*columns, "sequence_id", "offset"]
            )

    return ranked.select(*columns, (F.col("_rank") + F.col("_before")).alias("_rank")).mapInArrow(releasing(work), f"{PIECES}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Packs all ids of ``docs`` (doc_id, text) into sequences of at most ``max_tokens``.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    A document longer than a sequence gives full pieces and a rest; each id is in one
    piece. A null or empty text has the end id alone. A null doc_id stays null; repeated
    rows are packed each; columns other than doc_id and text are left behind, so their
    names can't clash; an empty table gives no row. Pieces of one length are ranked by
    the task that made them and their order there.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    return assign(scratch.write(token_pieces(docs, vocabulary, max_tokens, end_id), "pieces"), scratch, max_tokens)
