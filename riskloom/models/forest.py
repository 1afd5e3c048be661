"""A random forest over many rows: histograms of binned rows, one pass per level of all trees.

It is the forest of Spark ML (weighted Gini, Poisson bags, sqrt of the inputs per node, at most
32 bins, leaves that agree are merged) for rows of the encoder. Of a row it keeps a byte or two
per input column: the bin of a number, and of a one-hot block which entry is set. Spark ML keeps
four bytes per entry of the vector and, for each tree, a bag count and several copies of a node
number. Tasks count their own rows; a shuffle adds up the counts, a slice of nodes at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import ScaleLimits
from riskloom.models.encoder import FEATURES, TabularEncoderModel
from riskloom.roles import LABEL
from riskloom.session import join_path, pin

TREES, DEPTH, LEAF_ROWS, BINS = 200, 12, 5, 32
#: Rows of one stored block, and nodes whose counts travel together.
BLOCK_ROWS, SLICE_NODES = 131_072, 256
#: Entries of a vector up to which a task holds the counts of all nodes of a tree's level.
MOST_ENTRIES = 1_024
#: Steps of the grid of quantiles that bins are chosen from.
QUANTILES = 1_023


class Layout(NamedTuple):
    """Where the vector of the encoder has its numbers and one-hot blocks."""

    numbers: int
    widths: tuple[int, ...]

    @classmethod
    def of(cls, encoder: TabularEncoderModel) -> "Layout":
        learned = encoder.learned
        return cls(len(learned["numeric"]), tuple(c["width"] for c in learned["categorical"]))

    @property
    def entries(self) -> int:
        return self.numbers + sum(self.widths)

    @property
    def kind(self) -> type:
        return np.uint8 if max((BINS, *self.widths)) < 255 else np.uint16

    def columns(self, features: str) -> list[Column]:
        """The numbers, and per block the place of its set entry from 1, or 0."""
        entries, at, places = vector_to_array(features), self.numbers, []
        for width in self.widths:
            places.append(F.array_position(F.slice("_forest_entries", at + 1, width), 1.0).cast("int"))
            at += width
        return [entries.alias("_forest_entries"), F.slice("_forest_entries", 1, self.numbers).alias("_forest_numbers"), F.array(*places).cast("array<int>").alias("_forest_places")]

    def split_of(self, feature: np.ndarray, bin_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(column, base, span): a row goes right if its value less base, wrapped, is below span."""
        top = np.iinfo(self.kind).max
        starts = self.numbers + np.concatenate([[0], np.cumsum(self.widths)]).astype(np.int64)
        block = np.searchsorted(starts, feature, side="right") - 1
        number = feature < self.numbers
        column = np.where(number, feature, self.numbers + block)
        place = feature - starts[np.maximum(block, 0)] + 1
        return (
            column.astype(np.int64),
            np.where(number, bin_ + 1, place).astype(self.kind),
            np.where(number, top - bin_, 1).astype(self.kind),
        )


def coded(numbers: np.ndarray, places: np.ndarray, edges: list[np.ndarray], layout: Layout) -> np.ndarray:
    """Columns by rows: how many edges lie below each number, then the places."""
    rows = len(numbers) if layout.numbers else len(places)
    out = np.empty((layout.numbers + len(layout.widths), rows), layout.kind)
    for i, own in enumerate(edges):
        out[i] = np.searchsorted(own, numbers[:, i], side="left")
    for i in range(len(layout.widths)):
        out[layout.numbers + i] = places[:, i]
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class Level(NamedTuple):
    """The split nodes of a level of one tree. ``kids`` has two entries a node: the number of
    a split node of the next level, or -1 - l for the leaf l of the tree."""

    column: np.ndarray
    base: np.ndarray
    span: np.ndarray
    kids: np.ndarray


def step(flat: np.ndarray, rows: int, at: np.ndarray, node: np.ndarray, level: Level) -> np.ndarray:
    """Where the rows ``at`` of a block go from their nodes."""
    value = flat.take((level.column * rows).take(node) + at)
    right = (value - level.base.take(node)) < level.span.take(node)
    return level.kids.take(2 * node + right)


_BAG = np.searchsorted(np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)]), (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def bag(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often a tree sees each row of a block: Poisson of mean 1."""
    return _BAG[np.random.default_rng([seed, tree, block]).integers(0, 65_536, rows, np.uint16)]


def chosen(seed: int, tree: int, level: int, part: int, nodes: int, entries: int) -> np.ndarray:
    """The inputs that each node of a slice may split by."""
    count = int(np.ceil(np.sqrt(entries)))
    draws = np.random.default_rng([seed, tree, level, part, 1]).random((count, nodes))
    picks = np.empty((nodes, count), np.int64)
    # The k-th draw is among the first entries - count + k + 1; one drawn before gives the last of them.
    for k in range(count):
        last = entries - count + k
        drawn = (draws[k] * (last + 1)).astype(np.int64)
        picks[:, k] = np.where((picks[:, :k] == drawn[:, None]).any(axis=1), last, drawn)
    return np.sort(picks, axis=1)


def _slices(nodes: int) -> list[tuple[int, int]]:
    return [(a, min(a + SLICE_NODES, nodes)) for a in range(0, nodes, SLICE_NODES)]


def _level_counts(blocks: list, seed: int, tree: int, levels: list[Level], nodes: int, layout: Layout) -> Iterator[tuple[int, bytes]]:
    """(slice, counts) of the nodes that a tree has open: rows by class, by chosen one-hot
    entry and class, and by chosen number, bin and class."""
    parts = _slices(nodes)
    picks = np.concatenate([chosen(seed, tree, len(levels), p, b - a, layout.entries) for p, (a, b) in enumerate(parts)])
    number = picks < layout.numbers
    n_numbers = number.sum(axis=1)
    most = int(n_numbers.max())
    total = np.zeros((nodes, 2))
    hot = [np.zeros((nodes, w + 1, 2)) for w in layout.widths]
    bins = np.zeros((most, nodes, BINS, 2))
    for block, rows, flat, label in blocks:
        counts = bag(seed, tree, block, rows)
        at = np.flatnonzero(counts)
        node = np.zeros(len(at), np.int64)
        for level in levels:
            node = step(flat, rows, at, node, level)
            if (level.kids < 0).any():
                stay = np.flatnonzero(node >= 0)
                at, node = at.take(stay), node.take(stay)
        weight, y = counts.take(at).astype(np.float64), label.take(at)
        total += np.bincount(2 * node + y, weight, 2 * nodes).reshape(nodes, 2)
        for i, sums in enumerate(hot):
            first = (layout.numbers + i) * rows
            place = flat[first : first + rows].take(at)
            sums += np.bincount((node * sums.shape[1] + place) * 2 + y, weight, sums.size).reshape(sums.shape)
        for k in range(most):
            has = np.flatnonzero((n_numbers > k).take(node))
            at, node, weight, y = at.take(has), node.take(has), weight.take(has), y.take(has)
            value = flat.take((picks[:, k] * rows).take(node) + at)
            bins[k] += np.bincount((node * BINS + value) * 2 + y, weight, nodes * BINS * 2).reshape(nodes, BINS, 2)
    ones = np.zeros((*picks.shape, 2))
    first = layout.numbers
    for sums, width in zip(hot, layout.widths):
        own = (picks >= first) & (picks < first + width)
        at_node, at_pick = np.nonzero(own)
        ones[at_node, at_pick] = sums[at_node, picks[own] - first + 1]
        first += width
    for p, (a, b) in enumerate(parts):
        own = int(n_numbers[a:b].max())
        arrays = (total[a:b], ones[a:b], bins[:own, a:b])
        yield p, np.concatenate([x.ravel() for x in arrays]).astype(np.int32).tobytes()


def _blocks(batches: Iterator[pa.RecordBatch], layout: Layout) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    found = []
    for batch in batches:
        for block, rows, values, labels in zip(*(c.to_pylist() for c in batch.columns)):
            found.append((block, rows, np.frombuffer(values, layout.kind), np.frombuffer(labels, np.uint8).astype(np.int64)))
    return found


SPLIT = np.dtype([("feature", "i4"), ("bin", "i4"), ("gain", "f8"), ("left", "f8", 2), ("right", "f8", 2)])


def gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1)
    return 1 - (counts**2).sum(axis=-1) / np.where(total > 0, total, 1.0) ** 2


def best_splits(counts: np.ndarray, picks: np.ndarray, weights: np.ndarray, layout: Layout) -> np.ndarray:
    """The best split of each node of a slice; feature -1 where none gains."""
    nodes, n_picks = picks.shape
    total, rest = counts[: 2 * nodes].reshape(nodes, 1, 2), counts[2 * nodes :]
    ones = rest[: nodes * n_picks * 2].reshape(nodes, n_picks, 2)
    bins = rest[nodes * n_picks * 2 :].reshape(-1, nodes, BINS, 2)
    below = np.cumsum(bins, axis=2)[:, :, :-1].transpose(1, 0, 2, 3).reshape(nodes, -1, 2)
    # A place that was not chosen as a one-hot entry has no ones, so nothing goes right there.
    left = np.concatenate([below, total - ones], axis=1).astype(np.float64)
    right = total - left
    enough = (left.sum(axis=2) >= LEAF_ROWS) & (right.sum(axis=2) >= LEAF_ROWS)
    wl, wr, wt = left * weights, right * weights, total * weights
    share = wl.sum(axis=2) / wt.sum(axis=2)
    gain = np.where(enough, gini(wt) - share * gini(wl) - (1 - share) * gini(wr), -1.0)
    # A number that a node has not chosen is no candidate, whatever its counts.
    n_numbers = (picks < layout.numbers).sum(axis=1)
    used = np.arange(below.shape[1]) // (BINS - 1) < n_numbers[:, None]
    gain[:, : below.shape[1]][~used] = -1.0
    best = gain.argmax(axis=1)
    node = np.arange(nodes)
    is_number = best < below.shape[1]
    place = np.where(is_number, best // (BINS - 1), best - below.shape[1])
    found = np.zeros(nodes, SPLIT)
    found["gain"] = gain[node, best]
    found["feature"] = np.where(found["gain"] > 0, picks[node, place], -1)
    found["bin"] = np.where(is_number, best % (BINS - 1), 0)
    found["left"], found["right"] = left[node, best], right[node, best]
    return found


class _Growing:
    """One tree while its levels are found: splits as arrays on the driver, like any model."""

    def __init__(self) -> None:
        self.levels: list[Level] = []
        self.splits: list[np.ndarray] = []
        self.open = 1

    def grow(self, found: np.ndarray, layout: Layout) -> None:
        """Take the splits of the open nodes; children that may split are open next."""
        kids = np.stack([found["left"], found["right"]], axis=1)
        splits = found["feature"] >= 0
        last = len(self.levels) + 1 == DEPTH
        more = splits[:, None] & (kids.min(axis=2) > 0) & (kids.sum(axis=2) >= 2 * LEAF_ROWS) & (not last)
        number = np.where(more, np.cumsum(more.ravel()).reshape(more.shape) - 1, -1)
        column, base, span = layout.split_of(np.maximum(found["feature"], 0), found["bin"])
        self.levels.append(Level(column, base, span, number.ravel().astype(np.int64)))
        self.splits.append(found)
        self.open = int(more.sum())

    def finished(self, root: np.ndarray, weights: np.ndarray, entries: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
        """Levels with leaves, their shares of class 1, and the importance of each input.

        From below: a node without split is a leaf, and so is one whose children are leaves of
        the same prediction."""
        leaf: list[np.ndarray] = [None] * len(self.levels)  # per node, whether it is a leaf
        counts = [np.asarray(root, float).reshape(1, 2)]
        for level, found in zip(self.levels, self.splits):
            both = np.stack([found["left"], found["right"]], axis=1).reshape(-1, 2)
            counts.append(both[level.kids >= 0])
        importance = np.zeros(entries)
        for d in range(len(self.levels) - 1, -1, -1):
            kids, found = self.levels[d].kids, self.splits[d]
            is_leaf = np.ones(len(kids), bool)
            if d + 1 < len(self.levels):
                is_leaf[kids >= 0] = leaf[d + 1]
            own = np.stack([found["left"], found["right"]], axis=1) * weights
            says = own[..., 1] > own[..., 0]
            same = is_leaf.reshape(-1, 2).all(axis=1) & (says[:, 0] == says[:, 1])
            leaf[d] = (found["feature"] < 0) | same
            kept = ~leaf[d]
            np.add.at(importance, found["feature"][kept], (found["gain"] * (counts[d] * weights).sum(axis=1))[kept])
        share = lambda c: (c * weights)[..., 1] / (c * weights).sum(axis=-1)
        if leaf[0][0]:
            return [], share(counts[0]), importance
        out, leaves = [], []
        for d, level in enumerate(self.levels):
            kept = ~leaf[d]
            kids = level.kids.copy()
            both = np.stack([self.splits[d]["left"], self.splits[d]["right"]], axis=1).reshape(-1, 2)
            ends = kids < 0
            if d + 1 < len(self.levels):
                ends[~ends] = leaf[d + 1]
                renumbered = np.cumsum(~leaf[d + 1]) - 1
                kids[~ends] = renumbered[kids[~ends]]
            ends &= np.repeat(kept, 2)
            done = sum(len(x) for x in leaves)
            kids[ends] = -1 - (done + np.arange(ends.sum()))
            leaves.append(share(both[ends]))
            if not kept.any():
                break
            out.append(Level(level.column[kept], level.base[kept], level.span[kept], kids[np.repeat(kept, 2)]))
        return out, np.concatenate(leaves), importance


def bin_edges(vectors: DataFrame, layout: Layout) -> list[np.ndarray]:
    """Per number at most 31 edges; a value equal to an edge lies below it."""
    if not layout.numbers:
        return []
    entries, x, _ = layout.columns(FEATURES)
    rows = vectors.select(entries).select(x)
    grid = [i / QUANTILES for i in range(QUANTILES + 1)]
    asked = [F.percentile_approx(F.get("_forest_numbers", i), grid, 10_000).alias(f"q{i}") for i in range(layout.numbers)]
    edges = []
    for values in rows.agg(*asked).first():
        own = np.unique(values)
        if len(own) > BINS:
            own = np.unique(np.asarray(values)[np.linspace(0, QUANTILES, BINS + 1).round().astype(int)[1:]])
        edges.append(own[:-1][: BINS - 1])
    return edges


def stored_blocks(vectors: DataFrame, edges: list[np.ndarray], layout: Layout) -> DataFrame:
    """(block, rows, values, labels): the binned rows, a byte or two per column of a row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rows", "values", "labels"]

        def packed(held: list) -> pa.RecordBatch:
            values, labels = np.concatenate([v for v, _ in held], axis=1), np.concatenate([y for _, y in held])
            row = [[len(labels)], [values.tobytes()], [labels.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.binary(), pa.binary()))], names)

        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, p = _matrix(batch.column(0), layout.numbers), _matrix(batch.column(1), len(layout.widths))
            held.append((coded(x, p, edges, layout), batch.column(2).to_numpy().astype(np.uint8)))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    entries, x, p = layout.columns(FEATURES)
    rows = vectors.select(entries, LABEL).select(x, p, F.col(LABEL).cast("int"))
    blocks = rows.mapInArrow(work, "rows int, values binary, labels binary")
    return pin(blocks.select(F.monotonically_increasing_id().alias("block"), "*"))


def fits(counts: dict[int, int], encoder: TabularEncoderModel, limits: ScaleLimits) -> bool:
    """Whether rows are many and their vectors such that they are fitted here."""
    entries = Layout.of(encoder).entries
    return sum(counts.values()) > limits.forest_rows and set(counts) == {0, 1} and 0 < entries <= MOST_ENTRIES


def fit_forest(vectors: DataFrame, counts: dict[int, int], encoder: TabularEncoderModel, seed: int, limits: ScaleLimits) -> "ForestModel":
    """A pass over the blocks per level; the driver holds the trees and nothing of the rows."""
    spark, layout = vectors.sparkSession, Layout.of(encoder)
    n = sum(counts.values())
    weights = np.array([n / (2 * counts[c]) for c in (0, 1)])
    edges = bin_edges(vectors, layout)
    cores = spark.sparkContext.defaultParallelism
    tasks = -(-n // (limits.forest_rows_per_task * cores)) * cores
    blocks = stored_blocks(vectors, edges, layout).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    trees = [_Growing() for _ in range(TREES)]
    roots = np.zeros((TREES, 2))
    try:
        for depth in range(DEPTH):
            state = spark.sparkContext.broadcast([(t, g.levels, g.open) for t, g in enumerate(trees) if g.open])
            if not state.value:
                break

            def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                own = _blocks(batches, layout)
                for tree, levels, nodes in state.value if own else ():
                    for part, payload in _level_counts(own, seed, tree, levels, nodes, layout):
                        yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([part], pa.int32()), pa.array([payload], pa.binary())], ["tree", "part", "counts"])

            sizes = {t: nodes for t, _, nodes in state.value}

            def choose(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
                tree, part = (int(x) for x in key)
                a, b = _slices(sizes[tree])[part]
                picks = chosen(seed, tree, depth, part, b - a, layout.entries)
                total = sum(np.frombuffer(c, np.int32).astype(np.int64) for c in frame["counts"])
                found = best_splits(total, picks, weights, layout)
                return pd.DataFrame({"tree": [tree], "part": [part], "root": [total[:2].tolist()], "splits": [found.tobytes()]})

            got = blocks.select("block", "rows", "values", "labels").mapInArrow(count, "tree int, part int, counts binary")
            made = got.groupBy("tree", "part").applyInPandas(choose, "tree int, part int, root array<long>, splits binary")
            by_tree: dict[int, list] = {}
            # At most 2,048 splits a tree: the level of the model.
            for r in sorted(made.collect(), key=lambda r: (r["tree"], r["part"])):
                by_tree.setdefault(r["tree"], []).append(np.frombuffer(r["splits"], SPLIT))
                if depth == 0:
                    roots[r["tree"]] = r["root"]
            for tree, parts in by_tree.items():
                trees[tree].grow(np.concatenate(parts), layout)
            state.unpersist()
    finally:
        blocks.unpersist()
    done = [g.finished(roots[t], weights, layout.entries) for t, g in enumerate(trees)]
    importance = sum((i / i.sum() for _, _, i in done if i.sum() > 0), np.zeros(layout.entries))
    importance = importance / (importance.sum() or 1.0)
    return ForestModel(layout, edges, [(levels, leaves) for levels, leaves, _ in done], importance)


def score_block(values: np.ndarray, trees: list[tuple[list[Level], np.ndarray]]) -> np.ndarray:
    """The mean over all trees of the share of class 1 in a row's leaf."""
    rows = values.shape[1]
    flat, out = np.ascontiguousarray(values).ravel(), np.zeros(rows)
    for levels, leaves in trees:
        if not levels:
            out += leaves[0]
            continue
        at, node = np.arange(rows), np.zeros(rows, np.int64)
        for level in levels:
            node = step(flat, rows, at, node, level)
            ended = node < 0
            out[at[ended]] += leaves[-1 - node[ended]]
            at, node = at[~ended], node[~ended]
    return out / len(trees)


class ForestModel(Model, MLWritable, MLReadable):
    """Adds the columns that a classifier of Spark ML adds."""

    state = Param(Params._dummy(), "state", "layout, bins and importance as JSON")

    def __init__(self, layout: Layout | None = None, edges: list | None = None, trees: list | None = None, importance: np.ndarray | None = None) -> None:
        super().__init__()
        if layout is not None:
            self._set(state=json.dumps({"numbers": layout.numbers, "widths": layout.widths, "edges": [e.tolist() for e in edges], "importance": importance.tolist()}))
        self.trees = trees
        self._sent: Any = None

    @property
    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def layout(self) -> Layout:
        return Layout(self.learned["numbers"], tuple(self.learned["widths"]))

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.learned["importance"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layout, edges = self.layout, [np.array(e) for e in self.learned["edges"]]
        if self._sent is None:
            self._sent = dataset.sparkSession.sparkContext.broadcast(self.trees)
        sent = self._sent

        @F.arrow_udf("double")
        def share(x: pa.Array, p: pa.Array) -> pa.Array:
            values = coded(_matrix(x, layout.numbers), _matrix(p, len(layout.widths)), edges, layout)
            return pa.array(score_block(values, sent.value))

        entries, x, p = layout.columns(FEATURES)
        names = [*dataset.columns]
        inputs = dataset.select("*", entries).select(*[f"`{n}`" for n in names], x, p)
        scored = inputs.withColumn("_forest_share", share("_forest_numbers", "_forest_places"))
        one, other = F.col("_forest_share"), 1 - F.col("_forest_share")
        return scored.select(
            *[f"`{n}`" for n in names],
            array_to_vector(F.array(other * len(self.trees), one * len(self.trees))).alias("rawPrediction"),
            array_to_vector(F.array(other, one)).alias("probability"),
            (one > 0.5).cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        """A row per tree and level; the leaves are level -1."""
        spark, rows = self.sparkSession, []
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        for tree, (levels, leaves) in enumerate(self.instance.trees):
            rows.append((tree, -1, None, None, None, None, leaves.tolist()))
            rows += [(tree, d, *(a.tolist() for a in level), None) for d, level in enumerate(levels)]
        kind = "tree int, level int, `column` array<long>, base array<int>, span array<int>, kids array<long>, leaves array<double>"
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(join_path(path, "trees"))


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel()
        model._resetUid(metadata["uid"])
        model._set(state=metadata["paramMap"]["state"])
        kind, trees = model.layout.kind, {}
        # The model itself, as the driver had it when it was fitted.
        for r in sorted(self.sparkSession.read.parquet(join_path(path, "trees")).collect(), key=lambda r: (r["tree"], r["level"])):
            if r["level"] < 0:
                trees[r["tree"]] = ([], np.array(r["leaves"]))
                continue
            arrays = (np.array(r["column"], np.int64), np.array(r["base"], kind), np.array(r["span"], kind), np.array(r["kids"], np.int64))
            trees[r["tree"]][0].append(Level(*arrays))
        model.trees = [trees[t] for t in sorted(trees)]
        return model
