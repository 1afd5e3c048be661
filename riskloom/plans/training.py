"""The training job: from raw tables to a recorded, audited model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import RiskConfig
from riskloom.models import stages
from riskloom.models.classifiers import positive_score
from riskloom.operators import audit
from riskloom.functions.cleaning import null_texts
from riskloom.operators.cleaning import clean, clean_values, with_row_position
from riskloom.operators.enrich import (
    enrich,
    first_labelled,
    join_labels,
    keyed_transactions,
    labels_frame,
)
from riskloom.operators.limits import first_rows
from riskloom.operators.metrics import evaluate
from riskloom.operators.split import split_at, split_bounds, split_summary
from riskloom.operators.thresholds import (
    configured_table,
    find_best_threshold,
    select_business_threshold,
)
from riskloom.plans import tracking as K
from riskloom.plans.scoring import save_model
from riskloom.plans.store import RunStore
from riskloom.roles import MATCH_POS, SOURCE_POS, Roles, first_present
from riskloom.session import join_path, pin, pinned_scope
from riskloom.sources import artifacts, sinks
from riskloom import config as C

SCORE = "fraud_score"


@dataclass(frozen=True)
class Training:
    """What a run produced; the frames are pinned or small."""

    model: stages.FittedModel
    splits: DataFrame
    scored: DataFrame
    table: DataFrame
    threshold: float
    metrics: dict[str, dict[str, Any]]
    report: dict[str, Any]
    dataset: dict[str, Any]
    time_column: str


def supervised_splits(raw: Mapping[str, DataFrame], cfg: RiskConfig) -> DataFrame:
    """Join, clean and split the raw tables into one stored table.

    A first pass over ids and times alone settles which rows survive cleaning and
    where the parts begin. The wide rows are then shuffled once, by id, and
    written once, with a folder per part that later steps read by itself.
    """
    tx = keyed_transactions(with_row_position(raw["transactions"]))
    labels = labels_frame(raw["labels"], cfg)
    dimensions = (raw.get("cards"), raw.get("users"), raw.get("mcc"))
    # What is labelled has one row per id, and is dealt by it already.
    wide = enrich(first_labelled(tx, labels, cfg), cfg, *dimensions, first_match=True, row_key="transaction_id")
    time = Roles.of(wide.columns).time
    if time is None:
        raise ValueError("no time column to split by")
    if time not in tx.columns:
        # The time comes from a dimension, so the first pass needs the joins too.
        cleaned = pin(clean(wide, cfg))
        return pin(split_at(cleaned, split_bounds(cleaned, cfg, time)), by=["split"])

    narrow = join_labels(tx.select("transaction_id", time, SOURCE_POS), labels)
    kept = pin(clean(narrow, cfg).select("transaction_id", time, SOURCE_POS))
    bounds = split_bounds(kept, cfg, time)
    # Ids are distinct already, except those that cleaning turns into the missing id.
    unnamed = kept.filter(F.col("transaction_id").isNull()).select(SOURCE_POS).first()
    named = null_texts(F.col("transaction_id")).isNotNull()
    once = named if unnamed is None else named | (F.col(SOURCE_POS) == F.lit(unnamed[0]))
    cleaned = clean_values(wide.filter(once), cfg).drop(MATCH_POS)
    return pin(split_at(cleaned, bounds), by=["split"])


def score_later_splits(
    splits: DataFrame, model: stages.FittedModel, cfg: RiskConfig
) -> DataFrame:
    """(split, target, score) of validation and test, each with training history only."""
    parts = []
    for split in K.SCORED_SPLITS:
        scored = model.score(splits.filter(F.col("split") == split).drop("split"))
        parts.append(
            scored.select(
                F.lit(split).alias("split"),
                F.col(cfg.target).cast("int").alias(cfg.target),
                positive_score(scored).alias(SCORE),
            )
        )
    return pin(parts[0].unionByName(parts[1]))


def choose_threshold(
    table: DataFrame, scored: DataFrame, cfg: RiskConfig
) -> tuple[float, dict[str, float]]:
    """The operating threshold, from validation rows only."""
    if cfg.threshold_strategy == "business_cost":
        return select_business_threshold(table)
    validation = scored.filter(F.col("split") == "validation")
    return find_best_threshold(validation, cfg.target, SCORE, cfg)


def fit_rows(splits: DataFrame, cfg: RiskConfig) -> DataFrame:
    """The training rows, or the first ``max_rows`` of them; other parts stay whole."""
    rows = splits.filter(F.col("split") == "train").drop("split")
    if cfg.max_rows is None:
        return rows
    return pin(first_rows(with_row_position(rows), cfg.max_rows, cfg.limits))


def train(
    splits: DataFrame, cfg: RiskConfig, ready: stages.PreparedTraining | None = None
) -> Training:
    """Fit on train, choose the threshold on validation, evaluate and audit both."""
    roles = Roles.of(splits.columns)
    model = stages.fit(fit_rows(splits, cfg), cfg, ready)
    scored = score_later_splits(splits, model, cfg)
    table = pin(configured_table(scored, cfg, cfg.target, SCORE))
    threshold, _ = choose_threshold(table, scored, cfg)
    metrics = {
        r["split"]: {k: v for k, v in r.asDict().items() if k != "split"}
        for r in evaluate(
            scored, cfg.target, SCORE, threshold, cfg.beta, cfg.limits, ("split",)
        ).collect()
    }
    facts = audit.gather(
        splits,
        roles.time,
        first_present(splits.columns, C.TRANSACTION_ID_NAMES),
        model.input_columns,
        validation_roc_auc=metrics["validation"]["roc_auc"],
        test_roc_auc=metrics["test"]["roc_auc"],
        threshold=threshold,
        top_features=model.top_features,
    )
    dataset: dict[str, Any] = {}
    for row in split_summary(splits, roles.time, cfg.target).collect():
        dataset |= {
            f"{row['split']}_rows": row["rows"],
            f"{row['split']}_positive_rate": row["positive_rate"],
            f"{row['split']}_time_min": row["start"].isoformat(),
            f"{row['split']}_time_max": row["end"].isoformat(),
        }
    return Training(
        model,
        splits,
        scored,
        table,
        threshold,
        metrics,
        audit.report(facts, cfg),
        dataset,
        roles.time,
    )


def describe(result: Training, cfg: RiskConfig, run_id: str) -> dict[str, Any]:
    """The metadata document of a run."""
    costs = {
        s: m["fp"] * cfg.false_positive_cost + m["fn"] * cfg.false_negative_cost
        for s, m in result.metrics.items()
    }
    return {
        "run_id": run_id,
        "model_name": cfg.model_name,
        "threshold": result.threshold,
        "validation_metrics": result.metrics["validation"],
        "test_metrics": result.metrics["test"],
        "time_column": result.time_column,
        "training_max_rows": cfg.max_rows,
        "strict_leakage_prevention": cfg.strict_leakage,
        "dataset": result.dataset,
        "threshold_selection": {
            "strategy": cfg.threshold_strategy,
            "false_positive_cost": cfg.false_positive_cost,
            "false_negative_cost": cfg.false_negative_cost,
            "analysis_start": cfg.grid_start,
            "analysis_stop": cfg.grid_stop,
            "analysis_step": cfg.grid_step,
        },
        "operational_costs": costs,
        "leakage_audit_status": result.report["status"],
    }


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    cfg: RiskConfig,
    promote: bool = False,
    overwrite_baseline: bool = False,
) -> str:
    """Train, save below ``root/runs/<run id>``, record the run; returns the run id.

    What the job pinned on its way is dropped when it ends."""
    with pinned_scope(spark):
        return _run(spark, raw, root, cfg, promote, overwrite_baseline)


def _run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    cfg: RiskConfig,
    promote: bool,
    overwrite_baseline: bool,
) -> str:
    started = datetime.now(timezone.utc)
    run_id = K.new_run_id(cfg.model_name)
    store = RunStore(spark, root, cfg.limits)
    folder = store.run_directory(run_id)
    result = train(supervised_splits(raw, cfg), cfg)
    metadata = describe(result, cfg, run_id)

    save_model(result.model.pipeline, metadata, spark, folder)
    by_split = {s: result.table.filter(F.col("split") == s) for s in K.SCORED_SPLITS}
    sinks.write_threshold_csv(
        by_split["validation"], by_split["test"], join_path(folder, "threshold_analysis.csv")
    )
    report = audit.report_frame(spark, result.report)
    sinks.write_json_rows(report.coalesce(1), join_path(folder, "leakage_audit.json"))

    completed = datetime.now(timezone.utc)
    metadata["run"] = {
        "run_id": run_id,
        "started_at_utc": started.isoformat(),
        "completed_at_utc": completed.isoformat(),
        "duration_seconds": (completed - started).total_seconds(),
        "pipeline_sha256": artifacts.folder_digest(spark, join_path(folder, "pipeline")),
        "pipeline_archived": True,
    }
    sinks.write_document(spark, metadata, join_path(folder, "metadata.json"))
    store.record(
        metadata,
        result.report,
        run_row(spark, metadata, result.report),
        metric_frame(spark, metadata),
        K.threshold_rows(result.table, F.lit(run_id)),
        run_artifacts(spark, run_id, folder),
    )
    if promote:
        store.promote(run_id, overwrite_baseline)
    return run_id


def run_row(
    spark: SparkSession, metadata: Mapping[str, Any], report: Mapping[str, Any]
) -> DataFrame:
    """The ``training_runs`` row of a finished run."""
    run, data, chosen = metadata["run"], metadata["dataset"], metadata["threshold_selection"]
    row = {
        "run_id": run["run_id"],
        "started_at": datetime.fromisoformat(run["started_at_utc"]),
        "completed_at": datetime.fromisoformat(run["completed_at_utc"]),
        "duration_seconds": float(run["duration_seconds"]),
        "model_name": metadata["model_name"],
        "selected_threshold": float(metadata["threshold"]),
        "threshold_strategy": chosen["strategy"],
        "false_positive_cost": float(chosen["false_positive_cost"]),
        "false_negative_cost": float(chosen["false_negative_cost"]),
        "audit_status": report["status"],
        "audit_warning_count": len(report.get("warnings", [])),
        "training_max_rows": metadata["training_max_rows"],
        "train_rows": data["train_rows"],
        "validation_rows": data["validation_rows"],
        "test_rows": data["test_rows"],
        "train_positive_rate": float(data["train_positive_rate"]),
        "validation_positive_rate": float(data["validation_positive_rate"]),
        "test_positive_rate": float(data["test_positive_rate"]),
        "strict_leakage_prevention": metadata["strict_leakage_prevention"],
        "pipeline_sha256": run["pipeline_sha256"],
        "run_directory": f"runs/{run['run_id']}",
        "metadata": sinks.document_text(metadata),
        "leakage_audit": sinks.document_text(report),
        "created_at": datetime.now(timezone.utc),
    }
    # Decimals arrive as doubles and are cast to the declared precision.
    loose = {
        f.name: "double" if f.dataType.typeName() == "decimal" else f.dataType.simpleString()
        for f in K.table_schema("training_runs").fields
    }
    schema = ", ".join(f"{n} {t}" for n, t in loose.items())
    return K.conform(spark.createDataFrame([tuple(row[n] for n in loose)], schema), "training_runs")


def metric_frame(spark: SparkSession, metadata: Mapping[str, Any]) -> DataFrame:
    """The two ``run_metrics`` rows of a finished run."""
    kinds = {m: "bigint" if m in ("tp", "fp", "tn", "fn") else "double" for m in K.METRIC_NAMES}
    struct = "struct<" + ", ".join(f"{m}: {t}" for m, t in kinds.items()) + ">"

    def values(split: str) -> tuple:
        metrics = {
            **metadata[f"{split}_metrics"],
            "business_cost": metadata["operational_costs"][split],
        }
        return tuple(
            None if metrics.get(m) is None else int(metrics[m]) if t == "bigint" else float(metrics[m])
            for m, t in kinds.items()
        )

    wide = spark.createDataFrame(
        [(metadata["run"]["run_id"], values("validation"), values("test"))],
        f"run_id string, validation {struct}, test {struct}",
    )
    return K.metric_rows(wide)


def run_artifacts(spark: SparkSession, run_id: str, folder: str) -> DataFrame:
    """One row per artifact; each artifact is a folder of part files written by Spark."""
    found = artifacts.folder_inventory(spark, folder)
    return found.select(
        F.lit(run_id).alias("run_id"),
        artifacts.artifact_type(F.col("name")).alias("artifact_type"),
        F.concat(F.lit(f"runs/{run_id}/"), F.col("name")).alias("uri"),
        "sha256",
        "size_bytes",
        F.current_timestamp().alias("created_at"),
    )


def compare_models(
    splits: DataFrame, cfg: RiskConfig, names: Sequence[str] = C.COMPARED_MODELS
) -> DataFrame:
    """Metrics per model and split, each model at its own F-beta threshold.

    The encoded training rows are computed once and shared by all models. The result has two
    rows per model; all that was pinned for them is dropped.
    """
    spark, found, schema = splits.sparkSession, [], None
    with pinned_scope(spark):
        rows = fit_rows(splits, cfg)
        ready = stages.prepare(rows, cfg)
        for name in names:
            one = cfg.with_(model_name=name)
            model = stages.fit(rows, one, ready)
            scored = score_later_splits(splits, model, one)
            validation = scored.filter(F.col("split") == "validation")
            threshold, _ = find_best_threshold(validation, cfg.target, SCORE, one)
            metrics = evaluate(
                scored, cfg.target, SCORE, threshold, cfg.beta, cfg.limits, ("split",)
            ).withColumn("model", F.lit(name))
            found += metrics.collect()
            schema = metrics.schema
    return spark.createDataFrame(found, schema)
