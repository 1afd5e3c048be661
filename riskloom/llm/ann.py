"""Nearest neighbours by vantage-point trees (operator 1).

Largest inner products become smallest distances by one more coordinate, sqrt(M^2 - |x|^2)
with the largest norm M of a shard, and 0 for queries. Each shard has a tree over its
vectors. A subtree is left out if the triangle inequality, times a factor, says that it holds
nothing nearer than what is known; at factor 1 nothing is ever missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

#: Vectors of a shard, queries of a block, vectors of a leaf.
SHARD_ROWS, QUERY_ROWS, LEAF = 16_384, 16_384, 128
#: Vectors that a vantage point is chosen from, and tested on.
CHOICES, PROBES = 8, 64
FACTOR = 1.1

TREE = "dim long, shard long, pos long, ids array<long>, vector array<double>, lo long, hi long, vantage long, near double, far_from double, far_to double, left long, right long"
FOUND = "query_id long, vec_id long, score double"


def proper(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector, dim of the rows that take part: an id, and a vector that isn't null,
    empty or zero and has only finite components."""
    v = F.col("vector")
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return own.filter(F.col("vec_id").isNotNull() & fine).withColumn("dim", F.size("vector").cast("long"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(0, most - (x * x).sum(axis=1)))])


def build(x: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """The order of the rows of ``x`` in the tree, and its nodes: (first and last place, vantage
    row, largest distance within, smallest and largest beyond, the children)."""
    order, nodes = np.arange(len(x)), []
    rng = np.random.default_rng(len(x))

    def grow(lo: int, hi: int) -> int:
        me = len(nodes)
        nodes.append((lo, hi, -1, 0.0, 0.0, 0.0, -1, -1))
        if hi - lo > LEAF:
            own = order[lo:hi]
            sample = x[own[rng.integers(0, hi - lo, PROBES)]]
            choices = own[rng.integers(0, hi - lo, CHOICES)]
            # a vantage point from which distances differ much cuts best
            spread = [np.linalg.norm(sample - x[c], axis=1).std() for c in choices]
            vantage = int(choices[int(np.argmax(spread))])
            far = np.linalg.norm(x[own] - x[vantage], axis=1)
            rank = np.argsort(far, kind="stable")
            order[lo:hi], far, mid = own[rank], far[rank], (hi - lo) // 2
            left, right = grow(lo, lo + mid), grow(lo + mid, hi)
            nodes[me] = (lo, hi, vantage, far[mid - 1], far[mid], far[-1], left, right)
        return me

    if len(x):
        grow(0, len(x))
    return order, nodes


def shard_tree(table: pa.Table, keep: int) -> pa.Table:
    """The tree of one shard. Equal vectors are one place that holds their ``keep`` smallest
    ids, as no query can have more of them among its neighbours."""
    dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
    ids, x = table.column("vec_id").to_numpy(), _matrix(table.column("vector"), dim) + 0.0
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    once = np.append(True, ids[1:] != ids[:-1])  # of an id's rows the smallest vector
    ids, x = ids[once], x[once]
    alike = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[alike], x[alike]
    new = np.append(True, (x[1:] != x[:-1]).any(axis=1))
    starts, x = np.flatnonzero(new), x[new]
    stops = np.append(starts[1:], len(ids))
    most = float((x * x).sum(axis=1).max())
    place, nodes = build(_lifted(x, most))
    where = np.empty(len(place), np.int64)
    where[place] = np.arange(len(place))
    rows = [(n[0], n[1], where[n[2]] if n[2] >= 0 else -1, *n[3:]) for n in nodes] + [(None,) * 8] * (len(place) - len(nodes))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    return pa.table({
        "dim": pa.array([dim] * len(place), pa.int64()), "shard": pa.array([shard] * len(place), pa.int64()), "pos": pa.array(range(len(place)), pa.int64()),
        "ids": pa.array([ids[starts[p] : min(stops[p], starts[p] + keep)] for p in place], pa.list_(pa.int64())),
        "vector": pa.ListArray.from_arrays(pa.array(np.arange(len(place) + 1) * dim, pa.int32()), pa.array(x[place].ravel())),
        **{c: pa.array([None if v is None else v for v in values], k) for c, values, k in zip(("lo", "hi", "vantage", "near", "far_from", "far_to", "left", "right"), columns, kinds, strict=True)},
    })


class Search:
    """A block of queries in one tree."""

    def __init__(self, tree: dict, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> None:
        self.x, self.ids, self.first, self.nodes = tree["x"], tree["ids"], tree["first"], tree["nodes"]
        self.q, self.query_ids, self.k, self.factor = q, query_ids, k, factor
        self.most = float((self.x * self.x).sum(axis=1).max())
        self.norm = (q * q).sum(axis=1)
        self.opened = 0  # vectors compared with queries
        self.kth = np.full(len(q), -np.inf)
        self.best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]  # query, id, score

    def reach(self, who: np.ndarray) -> np.ndarray:
        """The distance within which a query still looks; a hair more, so that ties are seen."""
        with np.errstate(invalid="ignore"):
            far = np.sqrt(np.maximum(0, self.norm[who] + self.most - 2 * self.kth[who]))
        return np.where(np.isneginf(self.kth[who]), np.inf, far * (1 + 1e-9) + 1e-9 * (1 + np.sqrt(self.most)))

    def bounds(self) -> tuple[list[tuple[int, int]], np.ndarray]:
        """The leaves, and for each query and leaf the least distance that the triangle
        inequality allows, from all vantage points above the leaf."""
        leaves, least = [], []
        stack = [(0, np.zeros(len(self.q)))]
        while stack:
            node, bound = stack.pop()
            lo, hi, vantage, near, far_from, far_to, left, right = self.nodes[node]
            if left < 0:
                leaves.append((lo, hi))
                least.append(bound)
                continue
            gap = np.sqrt(np.maximum(0, self.norm + self.most - 2 * (self.q @ self.x[vantage])))
            stack.append((right, np.maximum(bound, np.maximum(far_from - gap, gap - far_to))))
            stack.append((left, np.maximum(bound, gap - near)))
        return leaves, np.array(least).T

    def run(self) -> None:
        """Each query looks into its nearest leaf first; then every leaf is opened for those
        queries whose bound, times the factor, is still within reach."""
        if not len(self.q):
            return
        leaves, least = self.bounds()
        first = least.argmin(axis=1)
        for seeds in (True, False):
            for i, (lo, hi) in enumerate(leaves):
                who = np.flatnonzero((first == i) if seeds else (first != i))
                who = who if seeds else who[self.factor * least[who, i] <= self.reach(who)]
                if len(who):
                    self.opened += len(who) * (hi - lo)
                    self.leaf(lo, hi, who)

    def leaf(self, lo: int, hi: int, who: np.ndarray) -> None:
        rough = self.q[who] @ self.x[lo:hi].T
        slack = 1e-9 * (1 + np.abs(rough))
        a, b = np.nonzero(rough + slack >= self.kth[who][:, None])
        if not len(a):
            return
        a, b = who[a], b + lo
        score = np.zeros(len(a))
        for j in range(self.q.shape[1]):  # term by term: equal vectors get equal scores
            score += self.q[a, j] * self.x[b, j]
        many = self.first[b + 1] - self.first[b]
        at = np.repeat(self.first[b] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        a, score, ids = np.repeat(a, many), np.repeat(score, many), self.ids[at]
        own = ids != self.query_ids[a]
        touched = np.zeros(len(self.q), bool)
        touched[a] = True
        old = touched[self.best[0]]
        query, ids, score = (np.concatenate([o[old], n[own]]) for o, n in zip(self.best, (a, ids, score), strict=True))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        head = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(head, np.diff(np.append(head, len(query))))
        full = rank == self.k - 1
        self.kth[query[full]] = score[full]
        top = rank < self.k
        self.best = [np.concatenate([o[~old], n[top]]) for o, n in zip(self.best, (query, ids, score), strict=True)]


def read_tree(table: pa.Table) -> dict:
    table = table.sort_by("pos")
    dim = table.column("dim")[0].as_py()
    ids = table.column("ids").combine_chunks()
    names = ("lo", "hi", "vantage", "near", "far_from", "far_to", "left", "right")
    nodes = table.select(names).filter(pa.compute.is_valid(table.column("lo")))
    return {
        "x": _matrix(table.column("vector"), dim), "ids": ids.flatten().to_numpy(), "first": np.append(0, np.cumsum(pa.compute.list_value_length(ids).to_numpy())),
        "nodes": list(zip(*(nodes.column(c).to_pylist() for c in names), strict=True)),
    }


def trees(vectors: DataFrame, keep: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The index: one row per place of a shard's tree. Every proper row is in it."""
    own = proper(vectors, id_col, vector_col)
    shards = max(1, -(-own.count() // SHARD_ROWS))
    keyed = own.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    return keyed.groupBy("dim", "shard").applyInArrow(lambda t: shard_tree(t, keep), TREE)


def search(index: DataFrame, queries: DataFrame, k: int, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its ``k`` largest inner products
    among the rows of ``index`` (a written table of ``trees``) with another id, ties to the
    smaller vec_id. ``factor`` 1 finds them all; larger ones look into fewer subtrees.

    Blocks of queries meet every shard's tree, keep k rows each, and the best k of all
    shards stay. Vectors of unequal length are not compared. Improper vectors (null, empty,
    zero, with null or non-finite components) take no part; of several rows with one id the
    smallest vector does. Fewer than k candidates are all returned; none give no row."""
    asked = proper(queries, id_col, vector_col).groupBy("vec_id").agg(F.min(F.struct("vector", "dim")).alias("q")).select("vec_id", "q.vector", "q.dim")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    sizes = index.groupBy("dim").agg(F.max("shard").alias("_last"))
    asked = asked.join(sizes, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("shard"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"), "vec_id", "vector"
    )
    places = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def work(tree: pa.Table, block: pa.Table) -> pa.Table:
        if not tree.num_rows or not block.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids = block.column("vec_id").to_numpy()
        own = Search(read_tree(tree), ids, _matrix(block.column("vector"), block.column("dim")[0].as_py()), k, factor)
        own.run()
        query, found, score = own.best
        return pa.table({"query_id": ids[query], "vec_id": found, "score": score})

    keys = ("dim", "shard", "block")
    found = places.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(work, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, every: int, k: int, factor: float = FACTOR) -> DataFrame:
    """The ``k`` nearest rows of each row whose vec_id is divisible by ``every``; see ``search``."""
    index = Scratch(vectors.sparkSession, "vantage-trees").write(trees(vectors, k + 1), "index")
    return search(index, vectors.filter(F.col("vec_id") % every == 0), k, factor)
