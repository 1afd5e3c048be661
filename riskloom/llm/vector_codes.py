"""Vector code compression (operator 11): product codes found by per-dimension value dictionaries.

Vectors of integers are cut into equal consecutive parts; each part is coded as the number of
its nearest codebook entry. A block of rows keeps, for each dimension, a dictionary of its
distinct integers. In a round the squared differences of every dictionary value to all entries
are tabulated once, and the distances of a part are gathers from these tables and sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers of a block (rows times dimensions), and rows whose distances are held at once.
BLOCK_VALUES, DISTANCE_ROWS = 1 << 19, 1024
#: Labels whose sums are joined with a broadcast (about 40 bytes each).
BROADCAST_LABELS = 500_000


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, label and floor(scale * component) of the rows whose vector isn't null and has
    only finite components."""
    v = F.col("vector")
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return own.filter(fine).select("vec_id", "label", F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x)).alias("ints"))


def blocks(rows: DataFrame) -> DataFrame:
    """Rows of one length in blocks: n, dim, their ids and labels, the dictionaries of all
    dimensions one after another with their sizes, and each row's places in them."""
    label = dict(rows.dtypes)["label"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                same = np.flatnonzero(sizes == dim)
                step = max(1, BLOCK_VALUES // max(1, dim))
                for at in range(0, len(same), step):
                    own = pa.array(same[at : at + step])
                    x = lists.take(own).flatten().to_numpy(zero_copy_only=False).reshape(len(own), dim)
                    found = [np.unique(x[:, d], return_inverse=True) for d in range(dim)]
                    values = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]).astype("<i8")
                    places = np.array([f[1] for f in found], "<u4").tobytes()
                    edges = pa.array([0, len(own)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([len(own)], pa.int64()), pa.array([dim], pa.int64()),
                            pa.ListArray.from_arrays(edges, batch.column(0).take(own)), pa.ListArray.from_arrays(edges, batch.column(1).take(own)),
                            pa.array([values.tobytes()], pa.binary()), pa.array([[len(f[0]) for f in found]], pa.list_(pa.int32())), pa.array([places], pa.binary()),
                        ],
                        names=["n", "dim", "ids", "labels", "dictionary", "sizes", "places"],
                    )

    return rows.mapInArrow(work, f"n long, dim long, ids array<long>, labels array<{label}>, dictionary binary, sizes array<int>, places binary")


class Dictionaries:
    """One block: a dictionary for each dimension and the places of all rows in it."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        sizes = batch.column(batch.schema.get_field_index("sizes"))[row].as_py()
        values = np.frombuffer(batch.column(batch.schema.get_field_index("dictionary"))[row].as_py(), "<i8")
        self.values = np.split(values, np.cumsum(sizes)[:-1]) if sizes else []
        self.rows = batch.column(batch.schema.get_field_index("n"))[row].as_py()
        self.places = np.frombuffer(batch.column(batch.schema.get_field_index("places"))[row].as_py(), "<u4").reshape(len(sizes), self.rows)
        self.most = int(max(-int(values.min()), int(values.max()))) if len(values) else 0

    def nearest(self, books: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each part: each row's nearest entry (the first of equals) and its squared distance."""
        parts, entries, width = books.shape
        reach = (self.most + (int(np.abs(books).max()) if books.size else 0)) ** 2 * max(1, width)
        if reach >= 1 << 62:
            raise OverflowError("squared distances don't fit into 64 bits")
        kind = np.int32 if reach < 1 << 31 else np.int64
        for p in range(parts):
            dims = range(p * width, min((p + 1) * width, len(self.values)))
            tables = [((self.values[d][:, None] - books[p, :, d - p * width]) ** 2).astype(kind) for d in dims]
            rest = (books[p, :, len(dims) :] ** 2).sum(axis=1).astype(kind)  # positions a shorter last part lacks
            entry, error = np.empty(self.rows, np.int64), np.empty(self.rows, np.int64)
            part = np.empty((min(DISTANCE_ROWS, self.rows), entries), kind)
            for at in range(0, self.rows, DISTANCE_ROWS):
                n = min(DISTANCE_ROWS, self.rows - at)
                total = np.broadcast_to(rest, (n, entries)).copy()
                for d, table in zip(dims, tables, strict=True):
                    np.take(table, self.places[d, at : at + n], axis=0, out=part[:n], mode="clip")
                    total += part[:n]
                best = total.argmin(axis=1)
                entry[at : at + n], error[at : at + n] = best, total[np.arange(n), best]
            yield entry, error

    def part_values(self, p: int, width: int) -> np.ndarray:
        """The integers of a part, one row each; positions that a shorter last part lacks are 0."""
        out = np.zeros((self.rows, width), np.int64)
        for d in range(p * width, min((p + 1) * width, len(self.values))):
            out[:, d - p * width] = self.values[d][self.places[d]]
        return out


def sums(made: DataFrame, books: np.ndarray) -> DataFrame:
    """Rows and componentwise sums of the parts assigned to each entry, added up by task first."""
    parts, entries, width = books.shape
    shared = made.sparkSession.sparkContext.broadcast(books)
    names = [f"s{j}" for j in range(width)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                own = Dictionaries(batch, row)
                for p, (entry, _) in enumerate(own.nearest(shared.value)):
                    count[p] += np.bincount(entry, minlength=entries)
                    np.add.at(total[p], entry, own.part_values(p, width))
        part, entry = np.nonzero(count)
        if len(part):
            columns = [part, entry, count[part, entry], *(total[part, entry, j] for j in range(width))]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["part", "entry", "n", *names])

    own = made.select("n", "dictionary", "sizes", "places").mapInArrow(work, "part long, entry long, n long" + "".join(f", {c} long" for c in names))
    return own.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *names)))


def _cut(vector: list[int], parts: int) -> np.ndarray:
    width = -(-len(vector) // parts)
    return np.append(np.array(vector, np.int64), np.zeros(parts * width - len(vector), np.int64)).reshape(parts, width)


def codebooks(rows: DataFrame, made: DataFrame, dim: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """The entries of all parts after the rounds. Only they are on the driver."""
    first = rows.filter(F.size("ints") == dim).orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).collect()
    books = np.array([_cut(r.ints, parts) for r in first]).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in sums(made, books).collect():
            books[r.part, r.entry] = np.array(r[3:], np.int64) // r.n
    return books


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable rows of ``vectors`` and the codebooks (parts, entries, width).

    The first: vec_id, label, codes (an entry for each part), error (squared distances summed
    over parts), label_error (error summed over the rows of one label). Entries start as the
    parts of the rows with the smallest ids (null ids last, equal ids by vector); a round moves
    each used entry to the floor of its parts' mean. Distances that tie take the first entry.

    Rows whose vector is null or holds null, NaN or an infinity take no part, nor do those whose
    length isn't the most common one (the longer of equally common ones). A length that the parts
    don't divide is filled up with zeros. Repeated rows are rows each; a null id or label stays
    null, and null labels are one label. Other columns are left behind, so their names can't
    clash. Without usable rows there is no code and no entry. Components whose squared distances
    don't fit into 64 bits stop the job.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vector-codes")
    rows = integers(vectors, id_col, vector_col, label_col, scale)
    label = dict(rows.dtypes)["label"]
    made = scratch.write(blocks(rows), "blocks")
    common = made.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if common is None:
        empty = f"vec_id long, label {label}, codes array<long>, error long, label_error long"
        return spark.createDataFrame([], empty), np.zeros((parts, 0, 0), np.int64)
    made = made.filter(F.col("dim") == common.dim)
    books = codebooks(rows, made, common.dim, parts, entries, rounds)
    shared = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = Dictionaries(batch, row)
                entry, error = (np.array(x) for x in zip(*own.nearest(shared.value), strict=True))
                edges = pa.array(np.arange(own.rows + 1) * len(entry), pa.int32())
                ids, labels = (batch.column(i).slice(row, 1).flatten() for i in (1, 2))
                codes = pa.ListArray.from_arrays(edges, pa.array(entry.T.ravel()))
                yield pa.RecordBatch.from_arrays([ids, labels, codes, pa.array(error.sum(axis=0))], names=["vec_id", "label", "codes", "error"])

    coded = made.select("n", "ids", "labels", "dictionary", "sizes", "places").mapInArrow(assign, f"vec_id long, label {label}, codes array<long>, error long")
    coded = scratch.write(coded, "codes")
    by_label = scratch.write(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels")
    by_label = F.broadcast(by_label) if by_label.count() <= BROADCAST_LABELS else by_label
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label"), books


def books_sha256(books: np.ndarray) -> str:
    """The digest of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_text(codes: str = "codes"):
    """Each part's entry as two hexadecimal digits."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
