"""Classifiers by name, class weights and feature importance."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import RiskConfig, ScaleLimits
from riskloom.models.encoder import FEATURES, TabularEncoderModel
from riskloom.roles import LABEL, WEIGHT

HELD_OUT = "_held_out"


def class_counts(df: DataFrame, target: str) -> dict[int, int]:
    flag = F.col(target).cast("int")
    return {r["c"]: r["n"] for r in df.groupBy(flag.alias("c")).agg(F.count("*").alias("n")).collect()}


def balanced_weight(target: str, counts: dict[int, int]) -> Column:
    """rows / (classes * rows of the class)."""
    rows, classes = sum(counts.values()), len(counts)
    weight = F.lit(None).cast("double")
    for label, count in counts.items():
        weight = F.when(F.col(target).cast("int") == label, rows / (classes * count)).otherwise(weight)
    return weight


def _logistic_regression(cfg: RiskConfig, rows: int) -> Estimator:
    # The balanced weights add up to ``rows``, so 1/rows is the unit L2 penalty
    # of an objective that sums, rather than averages, the losses.
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=1000,
        regParam=1.0 / rows,
        elasticNetParam=0.0,
        standardization=False,
    )


def _random_forest(cfg: RiskConfig, rows: int) -> Estimator:
    return RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=200,
        maxDepth=12,
        minInstancesPerNode=5,
        seed=cfg.seed,
        # More nodes per pass over the data, and no tree walk to find a row's node.
        maxMemoryInMB=1024,
        cacheNodeIds=True,
    )


#: Boosting holds out a share of the rows, and stops when the loss there no longer falls, if
#: there are more than so many.
STOPPING_ROWS, HELD_OUT_SHARE, STOPPING_TOLERANCE = 10_000, 0.1, 1e-3


def _gradient_boosting(cfg: RiskConfig, rows: int) -> Estimator:
    model = GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, stepSize=0.05, maxIter=250, seed=cfg.seed
    )
    if rows <= STOPPING_ROWS:
        return model
    return model.setParams(validationIndicatorCol=HELD_OUT, validationTol=STOPPING_TOLERANCE)


def with_held_out_rows(vectors: DataFrame, estimator: Estimator, cfg: RiskConfig) -> DataFrame:
    """Adds the column of held-out rows where the estimator stops by one."""
    watched = estimator.hasParam("validationIndicatorCol") and estimator.isSet("validationIndicatorCol")
    return vectors.withColumn(HELD_OUT, F.rand(cfg.seed) < HELD_OUT_SHARE) if watched else vectors


def spread(vectors: DataFrame, rows: int, limits: ScaleLimits) -> DataFrame:
    """Rows dealt to so many tasks that none fits on more than ``fit_rows_per_task`` of them.

    Vectors are small when stored, so a scan gives them to few tasks; but a classifier keeps
    more of each row, a forest two numbers per tree. Few rows stay as the scan gives them.
    """
    tasks = -(-rows // limits.fit_rows_per_task)
    return vectors.repartition(tasks) if tasks > 1 else vectors


@contextmanager
def kept_spread(vectors: DataFrame, rows: int, limits: ScaleLimits) -> Iterator[DataFrame]:
    """``spread`` for the time of a fit: a classifier plans its input several times, before and
    after the fit, so what was dealt lies on the executors' disks and is shuffled once."""
    dealt = spread(vectors, rows, limits)
    if dealt is vectors:
        yield vectors
        return
    dealt.persist(StorageLevel.DISK_ONLY)
    try:
        yield dealt
    finally:
        dealt.unpersist()


BUILDERS: dict[str, Callable[[RiskConfig, int], Estimator]] = {
    "logistic_regression": _logistic_regression,
    "random_forest": _random_forest,
    "hist_gradient_boosting": _gradient_boosting,
}


def classifier(cfg: RiskConfig, rows: int) -> Estimator:
    if cfg.model_name not in BUILDERS:
        raise ValueError(f"unknown model {cfg.model_name!r}; choose from {sorted(BUILDERS)}")
    return BUILDERS[cfg.model_name](cfg, rows)


def positive_score(scored: DataFrame) -> Column:
    """Positive-class probability, else the logistic of the decision score."""
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    return 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))


def top_features(model: Any, encoder: TabularEncoderModel, count: int = 20) -> list[dict[str, Any]]:
    """The inputs of largest absolute coefficient or importance."""
    values = getattr(model, "coefficients", None)
    if values is None:
        values = getattr(model, "featureImportances", None)
    if values is None or len(values) != encoder.width:
        return []
    # A model vector lives on the driver anyway; this only ranks its entries.
    values = values.toArray()
    best = np.argsort(-np.abs(values), kind="stable")[:count].tolist()
    names = encoder.names(best)
    return [
        {"feature": names[i], "importance": float(values[i]), "absolute_importance": abs(float(values[i]))}
        for i in best
    ]
