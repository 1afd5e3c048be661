"""The forest over binned rows, against plain counting and Spark ML's forest."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.config import RiskConfig, ScaleLimits
from riskloom.models import classifiers, forest, stages
from riskloom.models.encoder import TabularEncoder

CFG = RiskConfig(model_name="random_forest", limits=ScaleLimits(forest_rows=500, forest_rows_per_task=100))
LAYOUT = forest.Layout(2, (3, 2))


@pytest.fixture(scope="module")
def rows(spark):
    """900 rows; the label follows x, the letter and some noise."""
    rng = np.random.default_rng(4)
    x, z, letter, u = rng.normal(size=900), rng.normal(size=900), rng.integers(0, 4, 900), rng.random(900)
    label = (u < 0.1 + 0.6 * (x > 0.3) + 0.25 * (letter == 2)).astype(int)
    data = [(float(a), float(b), "abcd"[c], int(y)) for a, b, c, y in zip(x, z, letter, label)]
    return spark.createDataFrame(data, "x double, z double, letter string, is_fraud int")


@pytest.fixture(scope="module")
def ready(rows):
    return stages.prepare(rows, CFG)


@pytest.fixture(scope="module")
def fitted(rows, ready):
    return stages.fit(rows, CFG, ready)


def scores(model, vectors):
    made = model.transform(vectors).select(vector_to_array("probability")[1].alias("s"), "_label").collect()
    return np.array([r["s"] for r in made]), np.array([r["_label"] for r in made])


def area(s, y):
    order = np.argsort(np.argsort(s)) + 1
    n = y.sum()
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_many_rows_are_fitted_on_binned_rows(fitted, ready):
    model = fitted.pipeline.stages[-1]
    assert isinstance(model, forest.ForestModel) and len(model.trees) == 200
    assert max(len(levels) for levels, _ in model.trees) <= 12
    assert model.featureImportances.toArray().sum() == pytest.approx(1)
    assert {f["feature"] for f in fitted.top_features[:2]} <= {"x", "z", "letter_c"}
    few = ready.counts, ready.encoder, ScaleLimits(forest_rows=900)
    assert not forest.fits(*few) and forest.fits(ready.counts, ready.encoder, ScaleLimits(forest_rows=899))


def test_scores_are_like_those_of_spark_ml(fitted, ready):
    own, label = scores(fitted.pipeline.stages[-1], ready.vectors)
    theirs, again = scores(classifiers.classifier(CFG, ready.rows).fit(ready.vectors), ready.vectors)
    assert (label == again).all() and ((own >= 0) & (own <= 1)).all()
    assert abs(area(own, label) - area(theirs, label)) < 0.02
    assert np.corrcoef(own, theirs)[0, 1] > 0.98 and abs(own.mean() - theirs.mean()) < 0.02


def test_saved_forest_scores_the_same(spark, fitted, ready, tmp_path):
    model = fitted.pipeline.stages[-1]
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert (scores(loaded, ready.vectors)[0] == scores(model, ready.vectors)[0]).all()
    assert loaded.featureImportances == model.featureImportances
    columns = model.transform(ready.vectors).columns
    assert columns == [*ready.vectors.columns, "rawPrediction", "probability", "prediction"]


def test_a_row_is_stored_in_a_byte_per_column(ready):
    layout = forest.Layout.of(ready.encoder)
    blocks = forest.stored_blocks(ready.vectors, forest.bin_edges(ready.vectors, layout), layout)
    held = blocks.agg(F.sum("rows"), F.sum(F.length("values")), F.sum(F.length("labels"))).first()
    assert tuple(held) == (900, 900 * (layout.numbers + 1), 900)


def test_bags_and_choices_do_not_depend_on_tasks():
    assert (forest.bag(1, 2, 3, 1000) == forest.bag(1, 2, 3, 1000)).all()
    drawn = forest.bag(1, 2, 3, 200_000)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    picks = forest.chosen(1, 2, 3, 0, 5000, 30)
    assert picks.shape == (5000, 6) and (np.diff(picks, axis=1) > 0).all()
    assert np.bincount(picks.ravel(), minlength=30) == pytest.approx(1000, rel=0.2)


def test_level_counts_and_best_split_against_plain_counting():
    rng = np.random.default_rng(7)
    n, weights = 4000, np.array([0.7, 2.0])
    values = np.stack([rng.integers(0, 32, n), rng.integers(0, 5, n), rng.integers(0, 4, n), rng.integers(0, 3, n)]).astype(np.uint8)
    label = (rng.random(n) < 0.2 + 0.5 * (values[2] == 2)).astype(np.int64)
    seed, tree = 3, 5
    blocks = [(b, 2000, np.ascontiguousarray(values[:, s]).ravel(), label[s]) for b, s in ((0, slice(0, 2000)), (1, slice(2000, n)))]
    ((part, payload),) = forest._level_counts(blocks, seed, tree, [], 1, LAYOUT)
    picks = forest.chosen(seed, tree, 0, part, 1, LAYOUT.entries)
    found = forest.best_splits(np.frombuffer(payload, np.int32).astype(np.int64), picks, weights, LAYOUT)[0]

    count = np.concatenate([forest.bag(seed, tree, b, 2000) for b in (0, 1)])
    by_class = lambda rows: np.array([(count * rows * (label == c)).sum() for c in (0, 1)])
    impurity = lambda c: 1 - (((c * weights) / (c * weights).sum()) ** 2).sum()
    total, best = by_class(np.ones(n)), (-1, None)
    entry = {2 + i: values[2] == i + 1 for i in range(3)} | {5 + i: values[3] == i + 1 for i in range(2)}
    for f in picks[0]:
        for right in ([values[f] > b for b in range(31)] if f < 2 else [entry[f]]):
            r = by_class(right)
            if min(r.sum(), (total - r).sum()) < 5:
                continue
            share = (r * weights).sum() / (total * weights).sum()
            gain = impurity(total) - share * impurity(r) - (1 - share) * impurity(total - r)
            if gain > best[0] + 1e-12:
                best = gain, (f, r)
    assert found["gain"] == pytest.approx(best[0])
    assert found["feature"] == best[1][0] and (found["right"] == best[1][1]).all()
    column, base, span = LAYOUT.split_of(np.array([found["feature"]]), np.array([found["bin"]]))
    goes = (values[column[0]] - base[0]) < span[0]
    assert (by_class(goes) == best[1][1]).all()


def test_leaves_that_agree_are_merged():
    """A root whose left child splits into two leaves of class 0."""
    grown, weights = forest._Growing(), np.ones(2)
    root = np.zeros(1, forest.SPLIT)
    root[0] = (0, 3, 0.2, (80, 10), (5, 60))
    grown.grow(root, LAYOUT)
    assert grown.open == 2
    below = np.zeros(2, forest.SPLIT)
    below[0], below[1] = (1, 1, 0.01, (50, 0), (30, 10)), (-1, 0, -1, (0, 0), (0, 0))
    grown.grow(below, LAYOUT)
    levels, leaves, importance = grown.finished([85, 70], weights, LAYOUT.entries)
    assert len(levels) == 1 and leaves == pytest.approx([10 / 90, 60 / 65])
    assert importance.tolist() == pytest.approx([0.2 * 155, 0, 0, 0, 0, 0, 0])
    assert levels[0].kids.tolist() == [-1, -2]
    values = np.array([[3, 4], [0, 0], [0, 0], [0, 0]], np.uint8)
    assert forest.score_block(values, [(levels, leaves)]) == pytest.approx([10 / 90, 60 / 65])


def test_places_and_numbers_of_a_vector(spark):
    rows = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (None, None)], "n double, c string")
    cfg = RiskConfig(min_category_count=1)
    encoder = TabularEncoder(cfg).fit(rows)
    layout = forest.Layout.of(encoder)
    more = rows.unionByName(spark.createDataFrame([(9.0, "unseen")], rows.schema))
    entries, x, p = layout.columns("features")
    got = encoder.transform(more).select(entries).select(x, p).collect()
    assert [r["_forest_places"] for r in got] == [[1], [2], [2], [2], [0]]
    assert [len(r["_forest_numbers"]) for r in got] == [1] * 5
