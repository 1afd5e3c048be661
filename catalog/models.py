"""Imputation, encoding, classifiers and scoring jobs on the event transactions."""

from __future__ import annotations

from dataclasses import replace
from uuid import uuid4

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from catalog.domain import CFG, TX_SQL, rounded, split_sql, table, transactions
from catalog.registry import query
from riskloom.models import stages
from riskloom.models.classifiers import balanced_weight, class_counts
from riskloom.models.encoder import (
    TabularEncoder,
    TabularEncoderModel,
    category_counts,
    category_index,
    numeric_statistics,
)
from riskloom.operators.limits import riskiest_rows
from riskloom.operators.metrics import evaluate
from riskloom.operators.split import temporal_split
from riskloom.operators.thresholds import configured_table, lowest_cost_row
from riskloom.plans.scoring import PREDICTION_COLUMNS, ScoringService, save_model
from riskloom.plans.training import SCORE, choose_threshold, compare_models, score_later_splits
from riskloom.roles import feature_groups
from riskloom.session import ensure_checkpoint_dir, join_path, pin
from riskloom.streaming.scoring import record_stream, scored_records, start_scoring

_GAP_AMOUNT = "CASE WHEN event_id % 19 <> 0 THEN value END"


def _amounts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id AS pos", f"{_GAP_AMOUNT} AS amount")


@query(
    "numeric_scaling",
    f"""WITH a AS (SELECT event_id AS pos, {_GAP_AMOUNT} AS amount FROM events),
    filled AS (SELECT pos, coalesce(amount, (SELECT median(amount) FROM a)) AS v FROM a)
    SELECT pos, round((v - avg(v) OVER ()) / stddev_pop(v) OVER (), 6) AS amount_scaled
    FROM filled""",
)
def _(spark, sf_dir):
    df = _amounts(spark, sf_dir)
    learned = {"numeric": numeric_statistics(df, ["amount"], CFG.limits), "categorical": []}
    scaled = TabularEncoderModel(learned).scaled(df)
    return rounded(scaled.select("pos", F.col("_n_amount").alias("amount_scaled")), ["amount_scaled"])


_CATEGORY = """CASE WHEN event_id % 23 <> 0 THEN CAST(CAST(floor(value) AS BIGINT) AS {text}) END"""


@query(
    "category_index",
    f"""WITH raw AS (SELECT {_CATEGORY.format(text='VARCHAR')} AS v FROM events),
    counts AS (SELECT v, count(*) AS n FROM raw GROUP BY v),
    fill AS (SELECT v FROM counts WHERE v IS NOT NULL ORDER BY n DESC, v LIMIT 1),
    totals AS (SELECT coalesce(v, (SELECT v FROM fill)) AS value, CAST(sum(n) AS BIGINT) AS "rows"
               FROM counts GROUP BY 1),
    widths AS (SELECT count(*) FILTER (WHERE "rows" >= 10) AS frequent,
               count(*) FILTER (WHERE "rows" < 10) AS rare FROM totals)
    SELECT 'category' AS feature, value, "rows", CAST("rows" < 10 AS INTEGER) AS is_rare,
      CAST(CASE WHEN "rows" < 10 THEN frequent ELSE
        count(*) FILTER (WHERE "rows" >= 10) OVER (ORDER BY value) - 1 END AS INTEGER) AS "index",
      CAST(frequent + least(rare, 1) AS INTEGER) AS slots
    FROM totals, widths""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        F.expr(_CATEGORY.format(text="STRING")).alias("category")
    )
    counts = pin(category_counts(df, ["category"]))
    index = category_index(counts, CFG.min_category_count)
    return index.frame.withColumn("is_rare", F.col("is_rare").cast("int"))


@query(
    "balanced_weights",
    """SELECT is_fraud, n_rows, round(sum(n_rows) OVER () / (2.0 * n_rows), 6) AS weight FROM (
      SELECT CAST(event_type = 'error' AS INTEGER) AS is_fraud, count(*) AS n_rows
      FROM events GROUP BY 1)""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    weight = balanced_weight("is_fraud", class_counts(tx, "is_fraud"))
    weighted = tx.select("is_fraud", weight.alias("weight"))
    groups = weighted.groupBy("is_fraud", "weight").agg(F.count("*").alias("n_rows"))
    return rounded(groups, ["weight"])


# ---- classifiers: checked by rows, as their numbers depend on the optimizer -------


def _labelled(spark, sf_dir) -> DataFrame:
    """Transactions with a category and without the column that is the label."""
    code = F.regexp_extract("props", r"(\d+)", 1).alias("mcc")
    return transactions(spark, sf_dir, code).drop("use_chip")


def _splits(spark, sf_dir) -> DataFrame:
    return pin(temporal_split(_labelled(spark, sf_dir), CFG))


def _train(splits: DataFrame) -> DataFrame:
    return splits.filter("split = 'train'").drop("split")


def _scored(spark, sf_dir, model_name: str) -> tuple[stages.FittedModel, DataFrame]:
    cfg = CFG.with_(model_name=model_name)
    splits = _splits(spark, sf_dir)
    model = stages.fit(_train(splits), cfg)
    return model, score_later_splits(splits, model, cfg)


_EVALUATED: dict[tuple[str, str, str], list] = {}


def _evaluated(spark, sf_dir, model_name: str) -> DataFrame:
    """Two rows of metrics; each model is fitted once per session and folder."""
    key = spark.sparkContext.applicationId, sf_dir, model_name
    if key not in _EVALUATED:
        _, scored = _scored(spark, sf_dir, model_name)
        threshold, _ = choose_threshold(
            configured_table(scored, CFG, CFG.target, SCORE), scored, CFG
        )
        found = evaluate(scored, CFG.target, SCORE, threshold, CFG.beta, CFG.limits, ("split",))
        _EVALUATED[key] = [found.collect(), found.schema]
    return spark.createDataFrame(*_EVALUATED[key])


_MCC = "regexp_extract(props, '([0-9]+)', 1)"


def _places_sql(feature: str, before: str) -> str:
    """CTE of a category's one-hot places, which come after ``before`` entries."""
    return f"""{feature}_n AS (SELECT {feature} AS v, count(*) AS n FROM t GROUP BY 1),
    {feature}_fill AS (SELECT v FROM {feature}_n WHERE v IS NOT NULL ORDER BY n DESC, v LIMIT 1),
    {feature}_all AS (SELECT coalesce(v, (SELECT v FROM {feature}_fill)) AS v, sum(n) AS n FROM {feature}_n GROUP BY 1),
    {feature}_width AS (SELECT count(*) FILTER (WHERE n >= 10) AS frequent, max(CAST(n < 10 AS INTEGER)) AS rare FROM {feature}_all),
    {feature}_at AS (SELECT v, {before} + CASE WHEN n < 10 THEN frequent
      ELSE count(*) FILTER (WHERE n >= 10) OVER (ORDER BY v) - 1 END AS place FROM {feature}_all, {feature}_width)"""


_VECTORS_SQL = f"""WITH {TX_SQL}, {split_sql('tx')},
    t AS (SELECT transaction_id, amount, {_MCC} AS mcc, {_CATEGORY.format(text='VARCHAR')} AS band
      FROM parts JOIN events ON event_id = pos WHERE split = 'train'),
    {_places_sql('mcc', '1')},
    {_places_sql('band', '1 + (SELECT frequent + rare FROM mcc_width)')},
    filled AS (SELECT *, coalesce(amount, (SELECT median(amount) FROM t)) AS a FROM t),
    z AS (SELECT *, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS scaled FROM filled)
    SELECT transaction_id, CAST(2 + CAST(scaled <> 0 AS INTEGER) AS INTEGER) AS n_entries, round(scaled + 2, 6) AS entry_sum,
      CAST(m.place AS VARCHAR) || ',' || CAST(b.place AS VARCHAR) AS places
    FROM z JOIN mcc_at m ON m.v = coalesce(z.mcc, (SELECT v FROM mcc_fill))
      JOIN band_at b ON b.v = coalesce(z.band, (SELECT v FROM band_fill))"""


def _vectors(spark, sf_dir, cfg) -> DataFrame:
    """The encoded training rows: entries, their sum, and the places of the one-hot ones."""
    rows = transactions(spark, sf_dir, F.expr(_MCC).alias("mcc"), F.expr(_CATEGORY.format(text="STRING")).alias("band"))
    train = _train(pin(temporal_split(rows.drop("use_chip"), CFG)))
    encoded = TabularEncoder(cfg).fit(train).transform(train).withColumn("v", vector_to_array("features"))
    places = F.filter(F.sequence(F.lit(1), F.size("v") - 1), lambda i: F.get("v", i) != 0)
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return encoded.select(
        "transaction_id",
        F.size(F.filter("v", lambda x: x != 0)).alias("n_entries"),
        F.round(total, 6).alias("entry_sum"),
        F.array_join(places.cast("array<string>"), ",").alias("places"),
    )


@query("feature_vectors", _VECTORS_SQL)
def _(spark, sf_dir):
    return _vectors(spark, sf_dir, CFG)


@query("feature_vectors_in_long_form", _VECTORS_SQL)
def _(spark, sf_dir):
    """The same with a vocabulary beyond the broadcast bound, all but its ten commonest values."""
    return _vectors(spark, sf_dir, CFG.with_(limits=replace(CFG.limits, broadcast_rows=10, rows_per_run=20)))


@query("logistic_regression")
def _(spark, sf_dir):
    return _evaluated(spark, sf_dir, "logistic_regression")


@query("random_forest")
def _(spark, sf_dir):
    return _evaluated(spark, sf_dir, "random_forest")


@query("gradient_boosting")
def _(spark, sf_dir):
    return _evaluated(spark, sf_dir, "hist_gradient_boosting")


@query("top_features")
def _(spark, sf_dir):
    model = stages.fit(_train(_splits(spark, sf_dir)), CFG)
    # At most 20 entries of the fitted coefficient vector.
    return spark.createDataFrame(
        model.top_features, "feature string, importance double, absolute_importance double"
    )


@query("fit_and_score")
def _(spark, sf_dir):
    _, scored = _scored(spark, sf_dir, "logistic_regression")
    return scored


@query("compare_models")
def _(spark, sf_dir):
    return compare_models(_splits(spark, sf_dir), CFG)


_FITTED: dict[tuple[str, str], ScoringService] = {}


def _service(spark, sf_dir) -> ScoringService:
    """The scoring service of a folder, fitted once per session."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _FITTED:
        model, scored = _scored(spark, sf_dir, "logistic_regression")
        row = lowest_cost_row(configured_table(scored, CFG, CFG.target, SCORE)).first()
        _FITTED[key] = ScoringService(model.pipeline, {"threshold": row["threshold"]}, {}, CFG)
    return _FITTED[key]


def _raw(spark, sf_dir) -> DataFrame:
    """The transactions as raw text, the way they arrive for scoring."""
    money = F.concat(F.lit("$"), F.col("amount").cast("string"))
    time = F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return (
        _labelled(spark, sf_dir)
        .drop("is_fraud")
        .withColumns({"amount": money, "date": time})
    )


@query("predict_frame")
def _(spark, sf_dir):
    return _service(spark, sf_dir).predict_frame(_raw(spark, sf_dir))


# What does not depend on the optimizer: each row comes back once, with a decision that
# follows from its score.
_ROWS_SQL = """SELECT CAST(event_id AS VARCHAR) AS transaction_id, round(value, 6) AS amount,
  1 AS score_in_range, 1 AS decision_follows FROM events"""


def _rows(predictions: DataFrame) -> DataFrame:
    score, limit = F.col("fraud_score"), F.col("threshold")
    return predictions.select(
        "transaction_id",
        F.round(F.regexp_replace(F.col("amount").cast("string"), r"\$", "").cast("double"), 6).alias("amount"),
        score.between(0, 1).cast("int").alias("score_in_range"),
        (F.col("is_fraud_predicted").cast("int") == (score >= limit).cast("int")).cast("int").alias("decision_follows"),
    )


@query("predict_frame_rows", _ROWS_SQL)
def _(spark, sf_dir):
    return _rows(_service(spark, sf_dir).predict_frame(_raw(spark, sf_dir)))


@query("predict_csv_rows", _ROWS_SQL)
def _(spark, sf_dir):
    folder = join_path(ensure_checkpoint_dir(spark), f"predict-{uuid4().hex}")
    _raw(spark, sf_dir).drop("_source_pos").write.option("header", True).csv(folder)
    return _rows(_service(spark, sf_dir).predict_csv(spark, folder))


@query(
    "fit_and_score_rows",
    f"""WITH {TX_SQL}, {split_sql('tx')}
    SELECT split, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS positives, count(*) AS scores_in_range
    FROM parts WHERE split <> 'train' GROUP BY split""",
)
def _(spark, sf_dir):
    _, scored = _scored(spark, sf_dir, "logistic_regression")
    return scored.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(CFG.target).cast("long")).alias("positives"),
        F.count_if(F.col(SCORE).between(0, 1)).alias("scores_in_range"),
    )


_COUNTS_SQL = f"""WITH {TX_SQL}, {split_sql('tx')}
    SELECT split, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS positives
    FROM parts WHERE split <> 'train' GROUP BY split"""


def _counts(found: DataFrame, *more: str) -> DataFrame:
    return found.select(
        *more,
        "split",
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).cast("long").alias("n_rows"),
        (F.col("tp") + F.col("fn")).cast("long").alias("positives"),
    )


@query("logistic_regression_counts", _COUNTS_SQL)
def _(spark, sf_dir):
    return _counts(_evaluated(spark, sf_dir, "logistic_regression"))


@query("random_forest_counts", _COUNTS_SQL)
def _(spark, sf_dir):
    return _counts(_evaluated(spark, sf_dir, "random_forest"))


@query("gradient_boosting_counts", _COUNTS_SQL)
def _(spark, sf_dir):
    return _counts(_evaluated(spark, sf_dir, "hist_gradient_boosting"))


@query("compare_models_counts", f"SELECT * FROM (SELECT unnest(['logistic_regression', 'random_forest']) AS model), ({_COUNTS_SQL})")
def _(spark, sf_dir):
    return _counts(compare_models(_splits(spark, sf_dir), CFG), "model")


@query(
    "column_roles",
    """SELECT column_name AS name, CASE WHEN column_name = 'ts' OR contains(column_name, '_id') THEN 'left out'
      WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'BOOLEAN') THEN 'numeric' ELSE 'categorical' END AS role
    FROM information_schema.columns WHERE table_name = 'events'""",
)
def _(spark, sf_dir):
    """What becomes of each column of the events as a model input."""
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "date")
    groups = feature_groups(events.schema, CFG)
    role = {**dict.fromkeys(groups.numeric, "numeric"), **dict.fromkeys(groups.categorical, "categorical")}
    rows = [("ts" if c == "date" else c, role.get(c, "left out")) for c in events.columns]
    return spark.createDataFrame(rows, "name string, role string")


@query("predict_records")
def _(spark, sf_dir):
    """Records as JSON text in, the three prediction columns out."""
    records = _raw(spark, sf_dir).drop("_source_pos")
    text = records.select(F.to_json(F.struct(*records.columns)).alias("json"))
    parsed = text.select(F.from_json("json", records.schema).alias("r")).select("r.*")
    return _service(spark, sf_dir).predict_frame(parsed).select(*PREDICTION_COLUMNS)


@query(
    "predict_records_rows",
    """SELECT count(*) AS n_rows, count(*) AS scores_in_range, count(*) AS decisions_follow FROM events""",
)
def _(spark, sf_dir):
    """A record each, as JSON text: only the three prediction columns come back."""
    records = _raw(spark, sf_dir).drop("_source_pos")
    text = records.select(F.to_json(F.struct(*records.columns)).alias("json"))
    parsed = text.select(F.from_json("json", records.schema).alias("r")).select("r.*")
    out = _service(spark, sf_dir).predict_frame(parsed).select(*PREDICTION_COLUMNS)
    follows = F.col("is_fraud_predicted").cast("int") == (F.col("fraud_score") >= F.col("threshold")).cast("int")
    return out.agg(F.count("*").alias("n_rows"), F.count_if(F.col("fraud_score").between(0, 1)).alias("scores_in_range"), F.count_if(follows).alias("decisions_follow"))


def _saved(spark, sf_dir) -> ScoringService:
    """The fitted service written to a folder and read again, its history in buckets."""
    service = _service(spark, sf_dir)
    path = join_path(ensure_checkpoint_dir(spark), f"model-{uuid4().hex}")
    save_model(service.pipeline, service.metadata, spark, path)
    return ScoringService.load(spark, path, {}, CFG)


@query("saved_model_rows", _ROWS_SQL)
def _(spark, sf_dir):
    return _rows(_saved(spark, sf_dir).predict_frame(_raw(spark, sf_dir)))


@query("stream_scored_rows", _ROWS_SQL)
def _(spark, sf_dir):
    """Records that arrive as JSON files, scored by a stream until none is left."""
    folder = join_path(ensure_checkpoint_dir(spark), f"stream-{uuid4().hex}")
    records = _raw(spark, sf_dir).drop("_source_pos")
    records.write.json(join_path(folder, "in"))
    arriving = record_stream(spark, join_path(folder, "in"), records.schema)
    start_scoring(arriving, _service(spark, sf_dir), join_path(folder, "out"), join_path(folder, "state")).awaitTermination()
    return _rows(scored_records(spark, join_path(folder, "out")))


@query("predict_csv")
def _(spark, sf_dir):
    """Transactions written as CSV, read back, scored and persisted with their scores."""
    folder = join_path(ensure_checkpoint_dir(spark), f"predict-{uuid4().hex}")
    source, target = join_path(folder, "in"), join_path(folder, "out")
    _raw(spark, sf_dir).drop("_source_pos").write.option("header", True).csv(source)
    _service(spark, sf_dir).predict_csv(spark, source, target, fmt="parquet")
    return spark.read.parquet(target)


@query("riskiest_predictions")
def _(spark, sf_dir):
    scored = _service(spark, sf_dir).predict_frame(_raw(spark, sf_dir))
    return riskiest_rows(scored, 20, "fraud_score", "transaction_id")
