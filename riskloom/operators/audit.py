"""Leakage checks on the split and on the chosen model inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import RiskConfig
from riskloom.roles import POST_EVENT_NAMES, SENSITIVE_NAMES, SNAPSHOT_NAMES

REPORT_SCHEMA = """
    status string,
    checks struct<
        temporal_order_valid: boolean,
        duplicate_transaction_ids_across_splits: bigint,
        target_selected_as_feature: boolean,
        high_roc_auc_warning: boolean,
        threshold_at_analysis_boundary: boolean,
        limited_training_window: boolean>,
    split_boundaries struct<
        train_max: string, validation_min: string, validation_max: string, test_min: string>,
    selected_input_columns array<string>,
    top_model_features array<struct<
        feature: string, importance: double, absolute_importance: double>>,
    risk_columns struct<
        snapshot: array<string>, post_event: array<string>, sensitive: array<string>>,
    failures array<string>,
    warnings array<string>,
    recommendations array<string>
    """


def temporal_order(splits: DataFrame, time: str) -> DataFrame:
    """One row: the four inner boundaries and whether the parts are in order."""

    def edge(fn, split: str):
        return fn(F.when(F.col("split") == split, F.col(time)))

    edges = splits.agg(
        edge(F.max, "train").alias("train_max"),
        edge(F.min, "validation").alias("validation_min"),
        edge(F.max, "validation").alias("validation_max"),
        edge(F.min, "test").alias("test_min"),
    )
    in_order = (F.col("train_max") < F.col("validation_min")) & (
        F.col("validation_max") < F.col("test_min")
    )
    return edges.withColumn("temporal_order_valid", F.coalesce(in_order, F.lit(False)))


def shared_ids(splits: DataFrame, key: str) -> DataFrame:
    """How many ids each pair of parts has in common, added up.

    An id found in n parts is shared by n(n-1)/2 pairs, so one small
    aggregation per id replaces the pairwise intersections.
    """
    seen = [
        F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "validation", "test")
    ]
    parts = F.col("train") + F.col("validation") + F.col("test")
    pairs = parts * (parts - 1) / 2
    return (
        splits.groupBy(F.col(key).cast("string").alias("_id"))
        .agg(*seen)
        .agg(F.coalesce(F.sum(pairs), F.lit(0.0)).cast("bigint").alias("shared_ids"))
    )


@dataclass(frozen=True)
class AuditInput:
    """The facts a report is written from; all of them are small."""

    order: Mapping[str, Any]
    shared_ids: int
    selected: Sequence[str]
    validation_roc_auc: float | None
    test_roc_auc: float | None
    threshold: float
    top_features: Sequence[Mapping[str, Any]] = ()


def gather(
    splits: DataFrame, time: str, key: str | None, selected: Sequence[str], **facts
) -> AuditInput:
    order = temporal_order(splits, time).first().asDict()
    shared = shared_ids(splits, key).first()[0] if key else 0
    return AuditInput(order=order, shared_ids=shared, selected=sorted(selected), **facts)


@dataclass(frozen=True)
class Rule:
    """A finding: when it holds and what it concerns, as SQL over the one-row facts, and the
    settings and functions of this library that bear on it."""

    code: str
    severity: str
    holds: str
    concerns: str
    settings: str


#: Severity "fail" blocks a run, "warning" asks for a look. A finding is reported as its code and
#: what it concerns, a recommendation as its code and settings. The closeness of a threshold to
#: an edge of the grid is a fixed value.
RULES = (
    Rule("label_as_input", "fail", "array_contains(selected, target)", "target", "RiskConfig.target, roles.columns_to_drop"),
    Rule("ids_in_several_parts", "fail", "shared_ids > 0", "concat(shared_ids, ' shared')", "operators.cleaning.first_per_key"),
    Rule("parts_out_of_order", "fail", "NOT in_order", "'train_max, validation_min, validation_max, test_min'", "operators.split.temporal_split"),
    Rule("snapshot_inputs", "warning", "size(snapshot) > 0", "array_join(snapshot, ', ')", "RiskConfig.strict_leakage"),
    Rule("post_event_inputs", "warning", "size(post_event) > 0", "array_join(post_event, ', ')", "RiskConfig.strict_leakage"),
    Rule("sensitive_inputs", "warning", "size(sensitive) > 0", "array_join(sensitive, ', ')", "roles.SENSITIVE_NAMES"),
    Rule("ranking_too_good", "warning", "best_area >= area_limit", "concat('area ', format_number(best_area, 3))", "RiskConfig.roc_auc_warning, top_model_features"),
    Rule("threshold_at_edge", "warning", "exists(edges, e -> abs(threshold - e) <= 1e-8 + 1e-5 * abs(e))", "concat('threshold ', threshold)", "RiskConfig.grid_start, grid_stop"),
    Rule("bounded_training", "warning", "bounded", "'max_rows'", "RiskConfig.max_rows, jobs.py train --max-rows"),
)

FACTS = """in_order boolean, shared_ids bigint, selected array<string>, target string,
    snapshot array<string>, post_event array<string>, sensitive array<string>, best_area double,
    area_limit double, threshold double, edges array<double>, bounded boolean"""


def findings(facts: DataFrame) -> DataFrame:
    """One row per rule that holds for the one-row ``facts``: code, severity, concerns, settings."""
    rules = [
        F.struct(
            F.lit(r.code).alias("code"), F.lit(r.severity).alias("severity"),
            F.coalesce(F.expr(r.holds), F.lit(False)).alias("holds"),
            F.expr(f"string({r.concerns})").alias("concerns"), F.lit(r.settings).alias("settings"),
        )
        for r in RULES
    ]
    return facts.select(F.inline(F.array(*rules))).filter("holds").drop("holds")


def report(facts: AuditInput, cfg: RiskConfig) -> dict[str, Any]:
    """Status, checks and findings; see RULES."""
    selected = sorted(set(facts.selected))
    kinds = {"snapshot": SNAPSHOT_NAMES, "post_event": POST_EVENT_NAMES, "sensitive": SENSITIVE_NAMES}
    risks = {kind: [c for c in selected if c in names] for kind, names in kinds.items()}
    areas = [a for a in (facts.validation_roc_auc, facts.test_roc_auc) if a is not None]
    row = {
        "in_order": bool(facts.order["temporal_order_valid"]),
        "shared_ids": int(facts.shared_ids),
        "selected": selected,
        "target": cfg.target,
        **risks,
        "best_area": float(max(areas)) if areas else None,
        "area_limit": float(cfg.roc_auc_warning),
        "threshold": float(facts.threshold),
        "edges": [float(cfg.grid_start), float(cfg.grid_stop)],
        "bounded": cfg.max_rows is not None,
    }
    found = [r.asDict() for r in findings(SparkSession.active().createDataFrame([row], FACTS)).collect()]
    held = {r["code"] for r in found}
    said = {level: [f"{r['code']}: {r['concerns']}" for r in found if r["severity"] == level] for level in ("fail", "warning")}
    return {
        "status": next((level for level, texts in said.items() if texts), "pass"),
        "checks": {  # fixed values: names that readers of the report know
            "temporal_order_valid": row["in_order"],
            "duplicate_transaction_ids_across_splits": row["shared_ids"],
            "target_selected_as_feature": "label_as_input" in held,
            "high_roc_auc_warning": "ranking_too_good" in held,
            "threshold_at_analysis_boundary": "threshold_at_edge" in held,
            "limited_training_window": "bounded_training" in held,
        },
        "split_boundaries": {
            edge: at.isoformat() if at is not None else None
            for edge, at in facts.order.items()
            if edge != "temporal_order_valid"
        },
        "selected_input_columns": selected,
        "top_model_features": [dict(f) for f in facts.top_features],
        "risk_columns": risks,
        "failures": said["fail"],
        "warnings": said["warning"],
        "recommendations": [f"{r['code']}: {r['settings']}" for r in found if r["severity"] == "warning"],
    }


def report_frame(spark: SparkSession, content: Mapping[str, Any]) -> DataFrame:
    return spark.createDataFrame([dict(content)], REPORT_SCHEMA)
