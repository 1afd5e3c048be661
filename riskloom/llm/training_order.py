"""Training-order materialisation (operator 5).

A keyed Feistel permutation with cycle walking gives every fixed-length sequence its
global slot. Range partitions over the slots write shards of fixed-stride records, so a
reader finds any slot by arithmetic and can stop and resume anywhere.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import byte_tokens
from riskloom.llm.files import Replacing, locate
from riskloom.llm.store import Scratch, new_path
from riskloom.llm.textscan import mix, text_bytes

ROUNDS = 6
SEQUENCE_TOKENS = 128
END_ID = 1
#: Records of a shard: 16 MB of two-byte ids.
SHARD_ROWS = 65_536
#: Record bytes that a task sorts by shard at once, and how hard it packs them; how hard the
#: records of one stretch of rows are packed before their number is known.
HELD_BYTES, PACKING_LEVEL, STRETCH_LEVEL = 32 << 20, 9, 3
#: Range partitions at most; each holds neighbouring shards.
MOST_RANGES = 20_000
#: What travels with each record: place in its shard, doc_id, whether there is one, seq_no, n_tokens.
FIELDS = tuple(map(np.dtype, ("<u4", "<i8", "u1", "<i4", "<i4")))


def permute(index: np.ndarray, size: int, key: str) -> np.ndarray:
    """The slot of each index: a bijection of 0 .. size-1 that ``key`` chooses."""
    half = max(1, -(-max(size - 1, 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest(), "<u8")

    def feistel(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << np.uint64(half)) | right

    slot = feistel(np.asarray(index).astype(np.uint64))
    while len(out := np.flatnonzero(slot >= np.uint64(size))):  # walk the cycle back into range
        slot[out] = feistel(slot[out])
    return slot.astype(np.int64)


#: Of the records of a stretch: doc_id, whether there is one, seq_no, n_tokens.
STRETCH = tuple(map(np.dtype, ("<i8", "u1", "<i4", "<i4")))


def sequences(docs: DataFrame, vocabulary: str, tokens: int, end_id: int) -> DataFrame:
    """Fixed-length records of each document's ids and ``end_id``; the last is padded with
    ``end_id``. A stretch of rows gives one blob of its records (see ``unpacked``): _part and
    _at number them within the task that made them, n is how many there are."""
    wide = _id_type(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, made, part = byte_tokens.engine(vocabulary), 0, TaskContext.get().partitionId()
        pack = zstandard.ZstdCompressor(level=STRETCH_LEVEL).compress
        for batch in batches:
            doc_ids, known = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for rows, arrays in byte_tokens.token_rows(own, batch.column(1)):
                size = np.array([len(a) + 1 for a in arrays])
                count = -(-size // tokens)
                flat = np.full(int(count.sum()) * tokens, end_id, wide)
                first = np.cumsum(count) - count
                for a, at in zip(arrays, (first * tokens).tolist(), strict=True):
                    flat[at : at + len(a)] = a
                number = np.arange(len(flat) // tokens) - np.repeat(first, count)
                length = np.minimum(tokens, np.repeat(size, count) - number * tokens)
                doc, there = (np.repeat(x[rows[0] : rows[-1] + 1], count) for x in (doc_ids, known))
                blob = pack(b"".join([*(x.astype(t).tobytes() for x, t in zip((doc, there, number, length), STRETCH, strict=True)), flat.tobytes()]))
                arrays = [pa.array([x], pa.int64()) for x in (part, made, len(number))]
                made += len(number)
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([blob], pa.binary())], names=["_part", "_at", "n", "blob"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "_part long, _at long, n long, blob binary")


def unpacked(blob: bytes, n: int) -> list[np.ndarray]:
    """The STRETCH fields of a blob's records, and the records as rows of bytes."""
    raw, fields, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    for t in STRETCH:
        fields.append(np.frombuffer(raw, t, n, at))
        at += n * t.itemsize
    return [*fields, np.frombuffer(raw, np.uint8, offset=at).reshape(n, -1)]


def _id_type(vocabulary: str) -> np.dtype:
    size = byte_tokens.engine(vocabulary).library.get_vocab_size()
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def materialise(
    docs: DataFrame, vocabulary: str, folder: str, key: str = "epoch-0",
    tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Writes the sequences of ``docs`` (doc_id, text) in training order to ``folder``.

    Returns the index, one row per sequence: doc_id, seq_no, n_tokens, slot, shard, offset
    (bytes in the shard). Slots are 0 .. n-1 without gaps. A null or empty text has one
    sequence (the end id, padded); a null doc_id stays null; repeated rows get slots of
    their own; columns other than doc_id and text are left behind; an empty table writes
    no shard. Writing the index runs the job, and a lost task rewrites its shards whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "training-order")
    made = scratch.write(sequences(docs, vocabulary, tokens, end_id), "sequences", level=1)
    # counts per task are as many as tasks; each task's records follow those of earlier tasks
    counts = sorted((r["_part"], r["n"]) for r in made.groupBy("_part").agg(F.sum("n").alias("n")).collect())
    parts, sizes = (np.array(x, np.int64) for x in (zip(*counts, strict=True) if counts else ((), ())))
    total = int(sizes.sum())
    if not total:
        return spark.createDataFrame([], INDEX)
    first = spark.sparkContext.broadcast(dict(zip(parts.tolist(), (np.cumsum(sizes) - sizes).tolist(), strict=True)))
    stride = tokens * _id_type(vocabulary).itemsize

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=PACKING_LEVEL).compress
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            slot, *fields, records = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(slot, kind="stable")
            shard = slot[order] // shard_rows
            groups = np.split(order, np.flatnonzero(np.diff(shard)) + 1)
            own = [int(slot[g[0]] // shard_rows) for g in groups]
            parts = [[slot[g] - k * shard_rows, *(f[g] for f in fields)] for k, g in zip(own, groups, strict=True)]
            blobs = [
                pack(b"".join([*(x.astype(t).tobytes() for x, t in zip(part, FIELDS, strict=True)), records[g].tobytes()]))
                for part, g in zip(parts, groups, strict=True)
            ]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

        for batch in batches:
            for part, at, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc, known, seq, size, records = unpacked(blob, n)
                index = np.arange(first.value[part] + at, first.value[part] + at + n)
                held.append((permute(index, total, key), doc, known, seq, size, records))
                if sum(len(x[0]) for x in held) * stride >= HELD_BYTES:
                    yield flush()
        if held:
            yield flush()

    # what a task has for one shard travels as one compressed blob
    shards = -(-total // shard_rows)
    ranges = min(shards, MOST_RANGES)
    blobs = made.mapInArrow(place, "shard long, blob binary")
    # the ranges are known, so nothing has to be sampled to find them
    ranged = blobs.repartitionById(ranges, F.expr(f"int(shard * {ranges} div {shards})")).sortWithinPartitions("shard")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[bytes] = []
        shard = None

        def flush() -> pa.RecordBatch:
            rows = min(shard_rows, total - shard * shard_rows)
            whole, table = np.zeros((rows, stride), np.uint8), np.zeros((5, rows), np.int64)
            for blob in held:
                raw = unpack(blob)
                n, fields, at = len(raw) // (sum(t.itemsize for t in FIELDS) + stride), [], 0
                for t in FIELDS:
                    fields.append(np.frombuffer(raw, t, n, at))
                    at += n * t.itemsize
                place = fields[0].astype(np.int64)
                table[:, place] = fields
                whole[place] = np.frombuffer(raw, np.uint8, n * stride, at).reshape(n, stride)
            with Replacing(shard_path(folder, shard)) as out:
                out.write(whole.tobytes())
            held.clear()
            doc = pa.array(table[1], mask=table[2] == 0)
            arrays = [doc, *(pa.array(x) for x in (table[3], table[4], table[0] + shard * shard_rows, np.full(rows, shard), np.arange(rows) * stride))]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "seq_no", "n_tokens", "slot", "shard", "offset"])

        for batch in batches:
            for own, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != shard:
                    if held:
                        yield flush()
                    shard = own
                held.append(blob)
        if held:
            yield flush()

    index = scratch.write(ranged.mapInArrow(write, INDEX), "index")
    scratch.drop(made)
    return index


INDEX = "doc_id long, seq_no long, n_tokens long, slot long, shard long, offset long"


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def read_shards(
    spark: SparkSession, index: DataFrame, folder: str, vocabulary: str, tokens: int = SEQUENCE_TOKENS, resume_at: int = 0, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The records from slot ``resume_at`` on, in slot order within a task: slot, record."""
    stride = tokens * _id_type(vocabulary).itemsize
    shards = index.filter(F.col("slot") >= resume_at).select("shard").distinct()
    # few names, much to read: as many tasks as shards allow
    shards = shards.repartition(max(1, min(shards.count(), MOST_RANGES)), "shard")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in sorted(batch.column(0).to_pylist()):
                store, path = locate(shard_path(folder, shard))
                slot = max(resume_at, shard * shard_rows)
                with store.open_input_file(path) as file:
                    file.seek((slot - shard * shard_rows) * stride)
                    while block := file.read(stride * 4096):
                        records = [block[i : i + stride] for i in range(0, len(block), stride)]
                        yield pa.RecordBatch.from_arrays([pa.array(range(slot, slot + len(records)), pa.int64()), pa.array(records, pa.binary())], names=["slot", "record"])
                        slot += len(records)

    return shards.mapInArrow(work, "slot long, record binary")


def training_order(docs: DataFrame, vocabulary: str, key: str = "epoch-0") -> DataFrame:
    """Writes shards in the shared folder and reads them back: the index with ids_crc32 of
    what stands in each slot (the ids without padding, two or four bytes each)."""
    spark = docs.sparkSession
    folder = new_path(spark, "training-shards")
    index = materialise(docs, vocabulary, folder, key)
    size = _id_type(vocabulary).itemsize

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["doc_id", "seq_no", "n_tokens", "slot", "shard", "offset", "ids_crc32"]
            sums = []
            opened: tuple[int, object] | None = None
            for shard, at, n in zip(*(batch.column(i).to_pylist() for i in (4, 5, 2)), strict=True):
                if opened is None or opened[0] != shard:
                    store, path = locate(shard_path(folder, shard))
                    opened = shard, store.open_input_stream(path, compression=None).read()
                sums.append(zlib.crc32(opened[1][at : at + n * size]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=names)

    return index.mapInArrow(crc, f"{INDEX}, ids_crc32 long")
