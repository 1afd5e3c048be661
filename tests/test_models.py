from collections import Counter
from datetime import timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from helpers import DAY, days
from riskloom.config import RiskConfig, ScaleLimits
from riskloom.models import classifiers, stages
from riskloom.models.encoder import INFREQUENT, ROW, TabularEncoder
from riskloom.operators.cleaning import clean
from riskloom.roles import SOURCE_POS
from riskloom.session import pin

CFG = RiskConfig(max_rows=None)
SCHEMA = (
    f"{SOURCE_POS} bigint, date timestamp, transaction_id string, card_id bigint, "
    "merchant_id bigint, amount double, merchant_state string, is_fraud int"
)


@pytest.fixture(scope="module")
def twelve(spark):
    cards = [1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3]
    merchants = [100, 101, 100, 102, 100, 103, 103, 104, 100, 105, 105, 106]
    amounts = [5, 7, 100, 6, 8, 120, 9, 11, 4, 130, 10, 12]
    states = ["SP", "SP", "RJ", "SP", "RJ", "RJ", "SP", "SP", "SP", "RJ", "SP", "RJ"]
    labels = [0, 0, 1, 0, 0, 1, 0, 0, 0, 1, 0, 0]
    rows = [
        (i, t, str(i), c, m, float(a), s, y)
        for i, (t, c, m, a, s, y) in enumerate(zip(days(12), cards, merchants, amounts, states, labels))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_whole_fit_on_twelve_rows(twelve):
    model = stages.fit(twelve, CFG)
    scored = model.score(twelve).select(classifiers.positive_score(model.score(twelve)).alias("s"))
    scores = [r["s"] for r in scored.collect()]
    assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    assert {"amount", "merchant_state", "previous_amount"} <= set(model.input_columns)
    assert not {"card_id", "merchant_id", "transaction_id", "date", "is_fraud"} & set(model.input_columns)
    assert 0 < len(model.top_features) <= 20


def test_missing_target_is_an_error(twelve):
    with pytest.raises(ValueError, match="target"):
        stages.prepare(twelve.drop("is_fraud"), CFG)


@pytest.mark.parametrize("name", ["random_forest", "hist_gradient_boosting"])
def test_tree_builders_carry_their_settings(name):
    model = classifiers.classifier(CFG.with_(model_name=name), 100)
    if name == "random_forest":
        assert (model.getNumTrees(), model.getMaxDepth(), model.getMinInstancesPerNode()) == (200, 12, 5)
    else:
        assert (model.getStepSize(), model.getMaxIter()) == (0.05, 250)


def test_unknown_model_is_an_error():
    with pytest.raises(ValueError, match="unknown model"):
        classifiers.classifier(CFG.with_(model_name="guess"), 1)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    counts = classifiers.class_counts(df, "y")
    weights = df.select("y", classifiers.balanced_weight("y", counts).alias("w")).distinct().collect()
    assert {r["y"]: r["w"] for r in weights} == {0: pytest.approx(4 / 6), 1: 2.0}


def test_logistic_penalty_minimizes_the_summed_objective(spark, twelve):
    """At the optimum the gradient of sum(weight * loss) + |b|^2 / 2 vanishes."""
    ready = stages.prepare(twelve, CFG)
    model = classifiers.classifier(CFG, ready.rows).fit(ready.vectors)
    rows = ready.vectors.select(vector_to_array("features").alias("x"), "_label", "_weight").collect()
    x = np.array([r["x"] for r in rows])
    y, w = (np.array([r[c] for r in rows]) for c in ("_label", "_weight"))
    beta = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    assert np.abs(x.T @ (w * (p - y)) + beta).max() < 1e-3
    assert abs((w * (p - y)).sum()) < 1e-3


@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(broadcast_rows=0, histogram_cells=8)])
def test_encoder_against_plain_numbers(spark, limits):
    rng = np.random.default_rng(2)
    n = 200
    numbers = [None if i % 9 == 0 else float(v) for i, v in enumerate(rng.normal(5, 3, n))]
    letters = [None if i % 11 == 0 else "aaaabbbbc"[i % 9] if i > 3 else f"rare{i}" for i in range(n)]
    rows = list(zip(range(n), numbers, letters, [7.0] * n, [None] * n, [None] * n))
    df = spark.createDataFrame(
        rows, "k int, num double, letter string, same double, void double, hollow string"
    )
    model = TabularEncoder(CFG.with_(limits=limits)).fit(df.drop("k"))
    assert model.input_columns == ["num", "same", "letter"]
    names = ["num", "same", "letter_a", "letter_b", "letter_c", f"letter_{INFREQUENT}"]
    assert model.names(range(model.width)) == dict(enumerate(names))
    extra = spark.createDataFrame([(1000, None, "never seen", None, None, None)], df.schema)
    out = {
        r["k"]: np.array(r["v"])
        for r in model.transform(df.unionByName(extra))
        .select("k", vector_to_array("features").alias("v"))
        .collect()
    }
    known = np.array([v for v in numbers if v is not None])
    filled = np.array([np.median(known) if v is None else v for v in numbers])
    tally = Counter(v for v in letters if v is not None)
    mode = min(tally, key=lambda v: (-tally[v], v))
    letters = [mode if v is None else v for v in letters]
    for i in range(n):
        assert out[i][0] == pytest.approx((filled[i] - filled.mean()) / filled.std())
        assert out[i][1] == 0.0
        hot = "abc".find(letters[i]) if len(letters[i]) == 1 else 3
        assert list(out[i][2:]) == [float(j == hot) for j in range(4)]
    assert list(out[1000][2:]) == [0.0] * 4


def wide_categories(spark, rows=300):
    rng = np.random.default_rng(5)
    data = []
    for i in range(rows):
        letter = "ab"[i % 2] if i % 3 else f"v{rng.integers(0, 40)}"
        data.append((i, letter, None if i % 7 == 0 else f"n{i % 12}", f"infrequent{'_' * (i % 2)}" if i % 4 else f"r{i}", str(i % 5), float(i)))
    return spark.createDataFrame(data, "k int, a string, b string, c string, d string, x double")


@pytest.mark.parametrize("head", [0, 3])
def test_long_form_equals_the_broadcast_form(spark, head):
    df = wide_categories(spark)
    short = TabularEncoder(CFG).fit(df.drop("k"))
    long = TabularEncoder(CFG.with_(limits=ScaleLimits(broadcast_rows=head, rows_per_run=4))).fit(df.drop("k"))
    assert {k: v for k, v in short.learned.items() if k != "broadcast_rows"} == {k: v for k, v in long.learned.items() if k != "broadcast_rows"}
    assert short.names(range(short.width)) == long.names(range(long.width))
    assert long.names([long.width - 1 - 5])[long.width - 6] == "c_infrequent__"  # two values have the shorter names
    extra = spark.createDataFrame([(900, "new", "new", None, None, None)], df.schema)
    both = df.union(extra)
    rows = [
        {r["k"]: list(r["v"]) for r in m.transform(both).select("k", vector_to_array("features").alias("v")).collect()}
        for m in (short, long)
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 301
    assert long.transform(both).columns == [*both.columns, "features"]
    # a column that the input lacks counts as missing
    lacking = [{r["k"]: list(r["v"]) for r in m.transform(df.drop("b")).select("k", vector_to_array("features").alias("v")).collect()} for m in (short, long)]
    assert lacking[0] == lacking[1]


def exchanges(df):
    """Shuffles of the plan as Spark would run it, and what they carry."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if " Exchange hashpartitioning" in line]


def test_long_form_has_the_same_shuffles_for_any_number_of_columns(spark):
    df = wide_categories(spark).withColumn(ROW, F.monotonically_increasing_id())
    found = []
    for columns in (["a"], ["a", "b", "c", "d"]):
        own = df.select(ROW, *columns)
        model = TabularEncoder(CFG.with_(limits=ScaleLimits(broadcast_rows=1000))).fit(own.drop(ROW))
        found.append(len(exchanges(model.slots(pin(own)))))
        assert all(f"hashpartitioning({ROW}" in line for line in exchanges(model.slots(pin(own))))
    assert found == [1, 1]  # (row, slot) by row; a vocabulary that fits is broadcast
    tail = [
        len(exchanges(TabularEncoder(CFG.with_(limits=ScaleLimits(broadcast_rows=2))).fit(df.select(*c)).slots(pin(df.select(ROW, *c)))))
        for c in (["a"], ["a", "b", "c", "d"])
    ]
    assert tail[0] == tail[1] <= 3


def test_saved_pipeline_scores_raw_rows_alike(spark, twelve, tmp_path):
    model = stages.fit(twelve, CFG)
    path = str(tmp_path / "model")
    model.pipeline.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    # Later rows look back at the saved training rows.
    later = [
        (100 + i, DAY + timedelta(days=30 + i), f"n{i}", c, 1, a, "SP", 0)
        for i, (c, a) in enumerate([(1, 50.0), (1, 60.0), (9, 5.0)])
    ]
    new = spark.createDataFrame(later, SCHEMA).drop("is_fraud")

    def scores(pipeline):
        out = pipeline.transform(new)
        rows = out.select(
            "transaction_id", "transactions_seen_before", "previous_amount",
            classifiers.positive_score(out).alias("s"),
        ).collect()
        return {r[0]: (r[1], r[2], pytest.approx(r[3])) for r in rows}

    assert scores(model.pipeline) == scores(loaded)
    seen = {k: v[:2] for k, v in scores(loaded).items()}
    assert seen == {"n0": (4, 6.0), "n1": (5, 50.0), "n2": (0, None)}


def test_cleaner_stage_matches_clean(spark, twelve):
    stage = stages.TransactionCleaner(CFG)
    assert stage.transform(twelve).columns == clean(twelve, CFG).columns


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest"])
def test_no_task_of_a_fit_holds_more_than_its_bound_of_rows(spark, twelve, name, monkeypatch):
    """A stored table of few bytes is one partition, whatever its rows."""
    cfg = CFG.with_(model_name=name, limits=ScaleLimits(fit_rows_per_task=3))
    ready = stages.prepare(twelve, cfg)
    assert ready.vectors.rdd.getNumPartitions() < 4
    given = []

    class Watched:
        def hasParam(self, name):
            return False

        def fit(self, vectors):
            given.append(vectors)
            return classifiers.classifier(cfg, ready.rows).fit(vectors)

    monkeypatch.setattr(stages, "classifier", lambda *_: Watched())
    stages.fit(twelve, cfg, ready)
    sizes = given[0].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 4 and sum(sizes) == 12 and max(sizes) <= 4


def test_few_training_rows_stay_as_they_are_stored(twelve):
    vectors = twelve.select("amount")
    assert classifiers.spread(vectors, 12, ScaleLimits()) is vectors


def test_dealt_rows_are_kept_for_the_time_of_a_fit(twelve, monkeypatch):
    """The classifier plans its input several times; each time would shuffle all rows again."""
    cfg = CFG.with_(limits=ScaleLimits(fit_rows_per_task=3))
    ready = stages.prepare(twelve, cfg)
    given = []

    class Watched:
        def hasParam(self, name):
            return False

        def fit(self, vectors):
            given.append((vectors, vectors.storageLevel.useDisk))
            return classifiers.classifier(cfg, ready.rows).fit(vectors)

    monkeypatch.setattr(stages, "classifier", lambda *_: Watched())
    stages.fit(twelve, cfg, ready)
    [(vectors, kept)] = given
    assert kept and not vectors.storageLevel.useDisk
