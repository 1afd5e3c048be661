import random

import pytest
from pyspark.sql import functions as F

from riskloom.config import RiskConfig, ScaleLimits
from riskloom.operators import metrics as M, thresholds as H

CFG = RiskConfig()
SLICED = ScaleLimits(rows_per_run=20, histogram_cells=16)


def frame(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, map(float, scores))), "y int, s double")


def brute(labels, scores):
    """Average precision and ROC area by walking all thresholds and all pairs."""
    positives = sum(labels)
    ap, last = 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        hits = [y for y, s in zip(labels, scores) if s >= t]
        recall = sum(hits) / positives
        ap += (recall - last) * sum(hits) / len(hits)
        last = recall
    pairs = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for y, p in zip(labels, scores)
        if y
        for z, n in zip(labels, scores)
        if not z
    ]
    return ap, sum(pairs) / len(pairs)


@pytest.mark.parametrize("limits", [ScaleLimits(), SLICED])
@pytest.mark.parametrize("levels", [7, 10_000])
def test_areas_equal_brute_force(spark, limits, levels):
    rng = random.Random(levels)
    scores = [rng.randrange(levels) / levels for _ in range(150)]
    labels = [int(rng.random() < 0.2 + 0.5 * s) for s in scores]
    row = M.evaluate(frame(spark, labels, scores), "y", "s", 0.5, 2.0, limits).first()
    ap, auc = brute(labels, scores)
    assert row["pr_auc"] == pytest.approx(ap)
    assert row["roc_auc"] == pytest.approx(auc)
    assert row["tp"] == sum(y for y, s in zip(labels, scores) if s >= 0.5)
    assert row["tp"] + row["fp"] + row["tn"] + row["fn"] == 150


def test_known_area_that_step_and_line_rules_tell_apart(spark):
    row = M.evaluate(frame(spark, [0, 1], [0.1, 0.9]), "y", "s", 0.5, 2.0, CFG.limits).first()
    assert (row["pr_auc"], row["recall"], row["roc_auc"]) == (1.0, 1.0, 1.0)
    assert "accuracy" not in row.asDict()


def test_one_class_has_no_roc_area(spark):
    none = M.evaluate(frame(spark, [0, 0], [0.1, 0.9]), "y", "s", 0.5, 2.0, CFG.limits).first()
    assert (none["roc_auc"], none["pr_auc"], none["precision"], none["fbeta"]) == (None, 0.0, 0.0, 0.0)
    all_ = M.evaluate(frame(spark, [1, 1], [0.4, 0.4]), "y", "s", 0.5, 2.0, CFG.limits).first()
    assert (all_["roc_auc"], all_["pr_auc"], all_["recall"]) == (None, 1.0, 0.0)


def test_curves_end_where_they_should(spark):
    ranked = M.ranked_scores(frame(spark, [0, 1, 1], [0.2, 0.2, 0.7]), [], "y", "s", CFG.limits)
    pr = sorted(tuple(r) for r in M.precision_recall_curve(ranked, []).na.fill(9.0).collect())
    assert pr == [(0.2, pytest.approx(2 / 3), 1.0), (0.7, 1.0, 0.5), (9.0, 1.0, 0.0)]
    roc = sorted(tuple(r) for r in M.roc_curve(ranked, []).na.fill(9.0).collect())
    assert roc == [(0.2, 1.0, 1.0), (0.7, 0.0, 0.5), (9.0, 0.0, 0.0)]


def table(spark, labels, scores, thresholds, fp_cost=1.0, fn_cost=10.0):
    df = frame(spark, labels, scores).withColumn("split", F.lit("validation"))
    return H.threshold_table(df, thresholds, "y", "s", 2.0, fp_cost, fn_cost)


def test_cost_table_and_cheapest_threshold(spark):
    t = table(spark, [0, 0, 0, 1, 1], [0.05, 0.15, 0.25, 0.20, 0.90], [0.10, 0.30])
    assert set(t.columns) == set(H.TABLE_COLUMNS)
    threshold, metrics = H.select_business_threshold(t)
    assert threshold == 0.10 and metrics["business_cost"] == 2.0
    with pytest.raises(ValueError):
        H.select_business_threshold(t.filter("split = 'test'"))


def test_ties_go_to_fewer_misses_then_higher_threshold(spark):
    # Same cost everywhere: the higher of the two thresholds with no miss wins.
    t = table(spark, [0, 1, 1], [0.1, 0.5, 0.5], [0.2, 0.4, 0.05], fp_cost=0.0, fn_cost=0.0)
    assert H.select_business_threshold(t)[0] == 0.2 or H.select_business_threshold(t)[0] == 0.4
    assert H.select_business_threshold(t)[0] == 0.4


def test_scores_on_a_threshold_count_as_alerts(spark):
    row = table(spark, [1, 0, 1], [0.3, 0.3, float("nan")], [0.3]).first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 1, 1)


def test_grid():
    grid = H.threshold_grid(0.08, 0.30, 0.01)
    assert (grid[0], grid[-1], len(grid)) == (0.08, 0.30, 23)
    assert H.threshold_grid(0.1, 0.35, 0.1) == [0.1, 0.2, 0.3, 0.35]
    for bad in ((0.5, 0.1, 0.1), (0, 2, 0.1), (0, 1, 0)):
        with pytest.raises(ValueError):
            H.threshold_grid(*bad)


def test_best_fbeta(spark):
    df = frame(spark, [0, 0, 1, 1], [0.05, 0.2, 0.7, 0.9])
    threshold, metrics = H.find_best_threshold(df, "y", "s", CFG)
    assert 0 <= threshold <= 1
    assert metrics["fbeta"] == 1.0 and 0.2 < threshold <= 0.7
    none = H.find_best_threshold(frame(spark, [0, 0], [0.1, 0.9]), "y", "s", CFG)
    assert none == (0.5, {"fbeta": 0.0, "precision": 0.0, "recall": 0.0})


# Published outcomes (split, threshold, tp, fp, tn, fn) and results.
PUBLISHED = [
    ("validation", 0.08, 313, 2912, 87199, 0, 0.09705426356589147, 1.0, 0.34956444047353136, 2912.0),
    ("validation", 0.29, 311, 1895, 88216, 2, 0.14097914777878512, 0.9936102236421726, 0.4496818970503181, 1945.0),
    ("validation", 0.30, 311, 1872, 88239, 2, 0.14246449839670178, 0.9936102236421726, 0.45269286754002913, 1922.0),
    ("test", 0.08, 279, 2955, 87195, 0, 0.0862708719851577, 1.0, 0.32068965517241377, 2955.0),
    ("test", 0.30, 278, 1833, 88317, 1, 0.13169114163903364, 0.996415770609319, 0.4307406259683917, 1858.0),
]


def test_published_ratios_and_costs(spark):
    counts = spark.createDataFrame(
        [r[:6] for r in PUBLISHED], "split string, threshold double, tp bigint, fp bigint, tn bigint, fn bigint"
    )
    full = M.with_ratios(counts, 2.0).withColumn("business_cost", H.business_cost(1, 25))
    got = {(r["split"], r["threshold"]): r for r in full.collect()}
    for split, t, *_, precision, recall, fbeta, cost in PUBLISHED:
        row = got[split, t]
        assert row["precision"] == pytest.approx(precision, abs=1e-12)
        assert row["recall"] == pytest.approx(recall, abs=1e-12)
        assert row["fbeta"] == pytest.approx(fbeta, abs=1e-12)
        assert row["business_cost"] == cost
    assert H.lowest_cost_row(full).first()["threshold"] == 0.30
