"""Column descriptions and the early stop of boosting."""

import random

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from riskloom.config import RiskConfig
from riskloom.models import classifiers
from riskloom.models.encoder import FEATURES
from riskloom.operators import profile
from riskloom.roles import LABEL


def test_nan_is_as_missing_as_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a"), (-0.0, "b"), (0.0, "c")], "x double, y string")
    for approximate in (False, True):
        got = {r["column"]: (r["missing_rate"], r["nunique"]) for r in profile.column_quality(df, approximate=approximate).collect()}
        assert got == {"x": (0.4, 2), "y": (0.2, 3)}
    assert [r["missing_rate"] for r in profile.missing_rates(df, ["x"]).collect()] == [0.4]


def test_boosting_stops_early_on_many_rows(spark):
    cfg = RiskConfig(model_name="hist_gradient_boosting")
    few, many = (classifiers.classifier(cfg, n) for n in (10_000, 10_001))
    assert not few.isSet("validationIndicatorCol") and many.isSet("validationIndicatorCol")
    rng = random.Random(3)
    rows = [(Vectors.dense([rng.random(), rng.random()]), float(rng.random() < 0.5)) for _ in range(400)]
    kind = T.StructType([T.StructField(FEATURES, VectorUDT()), T.StructField(LABEL, T.DoubleType())])
    vectors = spark.createDataFrame(rows, kind)
    assert classifiers.with_held_out_rows(vectors, few, cfg) is vectors
    watched = classifiers.with_held_out_rows(vectors, many, cfg)
    assert 10 < watched.filter(classifiers.HELD_OUT).count() < 90
    # there is nothing to learn, so the loss on held-out rows soon rises
    assert many.setMaxIter(60).fit(watched).getNumTrees < 60
