"""Score raw transactions with a saved model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.config import CLEAN_ID_NAMES, RiskConfig
from riskloom.functions.features import decision
from riskloom.models.classifiers import positive_score
from riskloom.operators.cleaning import clean_values, with_row_position
from riskloom.operators.enrich import enrich
from riskloom.roles import MATCH_POS, ORIGINAL, SOURCE_POS, first_present, normalize_headers
from riskloom.session import join_path, path_exists, pin
from riskloom.sources.files import read_csv
from riskloom.sources.sinks import read_document, write_document

PREDICTION_COLUMNS = ("fraud_score", "is_fraud_predicted", "threshold")
DEFAULT_THRESHOLD = 0.5


def save_model(
    pipeline: PipelineModel, metadata: Mapping[str, Any], spark: SparkSession, path: str
) -> None:
    pipeline.write().overwrite().save(join_path(path, "pipeline"))
    write_document(spark, dict(metadata), join_path(path, "model_metadata"))


@dataclass(frozen=True)
class ScoringService:
    """A fitted pipeline with its operating threshold."""

    pipeline: PipelineModel
    metadata: Mapping[str, Any]
    dimensions: Mapping[str, DataFrame]
    cfg: RiskConfig

    @property
    def threshold(self) -> float:
        return float(self.metadata.get("threshold", DEFAULT_THRESHOLD))

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        path: str,
        dimensions: Mapping[str, DataFrame] | None = None,
        cfg: RiskConfig | None = None,
    ) -> "ScoringService":
        """``dimensions`` (cards, users, mcc) are joined to the rows before scoring."""
        saved = join_path(path, "pipeline")
        if not path_exists(spark, saved):
            raise FileNotFoundError(f"no model in {path}; train one first")
        about = join_path(path, "model_metadata")
        metadata = read_document(spark, about) if path_exists(spark, about) else {}
        return cls(PipelineModel.load(saved), metadata, dimensions or {}, cfg or RiskConfig())

    def predict_frame(self, records: DataFrame) -> DataFrame:
        """The input columns, the score, the decision and the threshold: one row per input row.

        Values are cleaned row by row and each dimension gives its first match, so no row is
        lost or repeated. Rows that repeat a transaction id are one transaction: the first
        of them is scored and counts in the look-back, the others get its score. Rows
        without an id are scored each.
        """
        named = [c for c in records.columns if c != SOURCE_POS]
        kept = with_row_position(records).withColumn(ORIGINAL, F.struct(*[F.col(f"`{c}`") for c in named]))
        wide = enrich(
            normalize_headers(kept),
            self.cfg,
            self.dimensions.get("cards"),
            self.dimensions.get("users"),
            self.dimensions.get("mcc"),
            first_match=True,
            row_key=SOURCE_POS,
        )
        # Stored once: positions stay what they are, and the history reads only some columns.
        cleaned = pin(clean_values(wide, self.cfg).drop(MATCH_POS))
        learned = PipelineModel(self.pipeline.stages[1:])
        key = first_present(cleaned.columns, CLEAN_ID_NAMES)
        again = None
        if key is not None:
            ids = cleaned.filter(F.col(key).isNotNull()).groupBy(key)
            again = pin(ids.agg(F.min(SOURCE_POS).alias("_first"), F.count("*").alias("_n")).filter("_n > 1"))
        if again is None or again.isEmpty():
            return self._decided(learned.transform(cleaned))
        repeated = cleaned.join(again.select(key, "_first"), key).filter(F.col(SOURCE_POS) != F.col("_first"))
        repeated = pin(repeated.select(SOURCE_POS, "_first", ORIGINAL))
        first = cleaned.join(repeated.select(SOURCE_POS), SOURCE_POS, "left_anti").select(cleaned.columns)
        scored = learned.transform(first)
        scored = pin(scored.select(SOURCE_POS, ORIGINAL, positive_score(scored).alias("_score")))
        others = repeated.join(
            scored.select(F.col(SOURCE_POS).alias("_first"), "_score"), "_first"
        ).select(SOURCE_POS, ORIGINAL, "_score")
        return self._decided(scored.unionByName(others), F.col("_score"))

    def _decided(self, scored: DataFrame, score: Column | None = None) -> DataFrame:
        score = positive_score(scored) if score is None else score
        return scored.select(
            f"{ORIGINAL}.*",
            score.alias("fraud_score"),
            decision(score, self.threshold).alias("is_fraud_predicted"),
            F.lit(self.threshold).alias("threshold"),
        )

    def predict_records(
        self, spark: SparkSession, records: Sequence[Mapping[str, Any]]
    ) -> DataFrame:
        """Score free-form records given in memory; the three prediction columns."""
        if not records:
            raise ValueError("at least one record is needed")
        frame = spark.createDataFrame([dict(r) for r in records])
        return self.predict_frame(frame).select(*PREDICTION_COLUMNS)

    def predict_csv(
        self, spark: SparkSession, source: str, target: str | None = None, fmt: str = "csv"
    ) -> DataFrame:
        """Score a CSV; optionally write all columns with the predictions."""
        predictions = self.predict_frame(read_csv(spark, source))
        if target is not None:
            writer = predictions.write.mode("overwrite").option("header", True)
            writer.format(fmt).save(target)
        return predictions
