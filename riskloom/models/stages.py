"""The learned scoring steps as Spark ML stages, and how they are fitted."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.config import RiskConfig
from riskloom.models.classifiers import (
    balanced_weight,
    class_counts,
    classifier,
    kept_spread,
    top_features,
    with_held_out_rows,
)
from riskloom.models.encoder import FEATURES, TabularEncoder, TabularEncoderModel
from riskloom.models.forest import fit_forest, fits
from riskloom.operators.cleaning import clean
from riskloom.operators.history import (
    BUCKET,
    FeatureHistory,
    all_features,
    bucket_count,
    in_buckets,
)
from riskloom.roles import LABEL, WEIGHT, Roles, feature_groups
from riskloom.session import join_path, pin


class TransactionCleaner(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cleaning as a stage, so that a saved model accepts raw transactions."""

    config = Param(Params._dummy(), "config", "settings as JSON")

    def __init__(self, cfg: RiskConfig | None = None) -> None:
        super().__init__()
        self._set(config=(cfg or RiskConfig()).to_json())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean(dataset, RiskConfig.from_json(self.getOrDefault(self.config)))


class HistoryFeaturesModel(Model, MLWritable, MLReadable):
    """Adds row features and the features that look back at the training rows."""

    config = Param(Params._dummy(), "config", "settings as JSON")
    roles = Param(Params._dummy(), "roles", "column names found in training as JSON")
    last_micros = Param(Params._dummy(), "last_micros", "last training time, or missing")
    has_missing_time = Param(Params._dummy(), "has_missing_time", "training rows without time")
    buckets = Param(Params._dummy(), "buckets", "folders of a saved history")
    schemas = Param(Params._dummy(), "schemas", "columns of its two tables as JSON")

    def __init__(
        self,
        cfg: RiskConfig | None = None,
        roles: Roles | None = None,
        history: FeatureHistory | None = None,
    ) -> None:
        super().__init__()
        self._set(config=(cfg or RiskConfig()).to_json())
        self._set(roles=json.dumps(asdict(roles or Roles(None, None, None, None))))
        if history is not None:
            self._set(last_micros=history.last_micros, has_missing_time=history.has_missing_time)
        self.history = history

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limits = RiskConfig.from_json(self.getOrDefault(self.config)).limits
        # Roles are those of training; a column the input lacks plays none.
        fitted = json.loads(self.getOrDefault(self.roles))
        roles = Roles(**{k: v if v in dataset.columns else None for k, v in fitted.items()})
        past = None
        if self.history is not None and roles.group and roles.time and roles.amount:
            past = self.history.for_batch(dataset, roles, limits)
        return all_features(dataset, roles, limits, past)

    def write(self) -> MLWriter:
        return _HistoryWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _HistoryReader()


class _HistoryWriter(MLWriter):
    def __init__(self, instance: HistoryFeaturesModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        """Both forms of the history lie in folders by bucket of the group."""
        model, kept = self.instance, self.instance.history
        if kept is not None:
            limits = RiskConfig.from_json(model.getOrDefault(model.config)).limits
            roles = Roles(**json.loads(model.getOrDefault(model.roles)))
            buckets = bucket_count(kept.rows.count(), limits)
            tables = {"history": kept.rows.drop(BUCKET), "history_compact": kept.compact.drop(BUCKET)}
            for name, rows in tables.items():
                out = in_buckets(rows, roles, buckets, limits).write.partitionBy(BUCKET)
                # Artifacts are hashed file by file, so no file may grow too large.
                out.option("maxRecordsPerFile", 10_000_000).parquet(join_path(path, name))
            schemas = {name: rows.schema.jsonValue() for name, rows in tables.items()}
            model._set(buckets=buckets, schemas=json.dumps(schemas))
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession)


class _HistoryReader(MLReader):
    def load(self, path: str) -> HistoryFeaturesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        params = metadata["paramMap"]
        model = HistoryFeaturesModel(
            RiskConfig.from_json(params["config"]), Roles(**json.loads(params["roles"]))
        )
        model._resetUid(metadata["uid"])
        if "has_missing_time" in params:
            facts = {k: params[k] for k in ("last_micros", "has_missing_time")}
            model._set(**facts)
            model._set(buckets=params["buckets"], schemas=params["schemas"])
            rows, compact = (
                self.sparkSession.read.schema(T.StructType.fromJson(schema).add(BUCKET, T.IntegerType())).parquet(join_path(path, name))
                for name, schema in json.loads(params["schemas"]).items()
            )
            model.history = FeatureHistory(rows, compact, buckets=params["buckets"], **facts)
        return model


@dataclass(frozen=True)
class FittedModel:
    """A scoring pipeline and what the audit wants to know about it."""

    pipeline: PipelineModel
    input_columns: list[str]
    top_features: list[dict]

    def score(self, cleaned: DataFrame) -> DataFrame:
        """Apply the stages after cleaning to rows that are clean already."""
        return PipelineModel(self.pipeline.stages[1:]).transform(cleaned)


@dataclass(frozen=True)
class PreparedTraining:
    """Everything the classifiers share, computed and written once."""

    rows: int
    counts: dict[int, int]
    history: HistoryFeaturesModel
    encoder: TabularEncoderModel
    vectors: DataFrame


def prepare(train: DataFrame, cfg: RiskConfig) -> PreparedTraining:
    """Features of the training rows, without history of their own before them."""
    if cfg.target not in train.columns:
        raise ValueError(f"no target column {cfg.target!r}")
    roles = Roles.of(train.columns)
    counts = class_counts(train, cfg.target)
    history = None
    if roles.group and roles.time and roles.amount:
        history = FeatureHistory.of(train, roles)
        history = replace(history, compact=pin(history.compact))
    featured = all_features(train, roles, cfg.limits)
    groups = feature_groups(featured.schema, cfg)
    featured = pin(featured.select(cfg.target, *groups.numeric, *groups.categorical))
    encoder = TabularEncoder(cfg).fit(featured)
    vectors = pin(
        encoder.transform(featured).select(
            FEATURES,
            F.col(cfg.target).cast("double").alias(LABEL),
            balanced_weight(cfg.target, counts).alias(WEIGHT),
        )
    )
    return PreparedTraining(
        sum(counts.values()), counts, HistoryFeaturesModel(cfg, roles, history), encoder, vectors
    )


def fit(train: DataFrame, cfg: RiskConfig, ready: PreparedTraining | None = None) -> FittedModel:
    """Fit the configured classifier on clean training rows."""
    ready = ready or prepare(train, cfg)
    if cfg.model_name == "random_forest" and fits(ready.counts, ready.encoder, cfg.limits):
        model = fit_forest(ready.vectors, ready.counts, ready.encoder, cfg.seed, cfg.limits)
    else:
        estimator = classifier(cfg, ready.rows)
        with kept_spread(with_held_out_rows(ready.vectors, estimator, cfg), ready.rows, cfg.limits) as rows:
            model = estimator.fit(rows)
    stages = [TransactionCleaner(cfg), ready.history, ready.encoder, model]
    return FittedModel(
        PipelineModel(stages),
        ready.encoder.input_columns,
        top_features(model, ready.encoder),
    )
