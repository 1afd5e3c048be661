"""Run history: five tables, the comparison index and the fact view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from riskloom.config import ScaleLimits
from riskloom.operators.ordering import running_sums
from riskloom.session import pin

# The declared tables.
SCHEMAS = {
    "training_runs": """
        run_id string, started_at timestamp, completed_at timestamp,
        duration_seconds decimal(16,6), model_name string, selected_threshold decimal(10,8),
        threshold_strategy string, false_positive_cost decimal(18,6),
        false_negative_cost decimal(18,6), audit_status string, audit_warning_count int,
        training_max_rows bigint, train_rows bigint, validation_rows bigint, test_rows bigint,
        train_positive_rate double, validation_positive_rate double, test_positive_rate double,
        strict_leakage_prevention boolean, pipeline_sha256 string, run_directory string,
        metadata string, leakage_audit string, created_at timestamp""",
    "run_metrics": """
        run_id string, split string, threshold decimal(10,8), precision double, recall double,
        f1 double, fbeta double, pr_auc double, roc_auc double, tp bigint, fp bigint, tn bigint,
        fn bigint, business_cost decimal(20,6)""",
    "threshold_evaluations": """
        run_id string, split string, threshold decimal(10,8), precision double, recall double,
        f1 double, fbeta double, tp bigint, fp bigint, tn bigint, fn bigint, alerts bigint,
        alert_rate double, business_cost decimal(20,6), cost_per_record double""",
    "run_artifacts": """
        run_id string, artifact_type string, uri string, sha256 string, size_bytes bigint,
        created_at timestamp""",
    "baseline_promotions": """
        id bigint, run_id string, promoted_at timestamp, audit_status string,
        pipeline_sha256 string, is_active boolean, metadata string""",
}
KEYS = {
    "training_runs": ("run_id",),
    "run_metrics": ("run_id", "split"),
    "threshold_evaluations": ("run_id", "split", "threshold"),
    "run_artifacts": ("run_id", "artifact_type", "uri"),
    "baseline_promotions": ("id",),
}
METRIC_NAMES = (
    "threshold",
    "precision",
    "recall",
    "f1",
    "fbeta",
    "pr_auc",
    "roc_auc",
    "tp",
    "fp",
    "tn",
    "fn",
    "business_cost",
)
AUDIT_STATES = ("pass", "warning", "fail")
PROMOTION_STATES = (*AUDIT_STATES, "not_available")
SCORED_SPLITS = ("validation", "test")
LEADERBOARD_METRICS = (
    "test_pr_auc",
    "test_fbeta",
    "test_recall",
    "test_precision",
    "validation_pr_auc",
)
LEADERBOARD_COLUMNS = (
    "run_id",
    "model_name",
    "threshold",
    "test_pr_auc",
    "test_fbeta",
    "test_recall",
    "test_precision",
    "audit_status",
)


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table, in order, cast to their declared types."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(name).fields]
    )


def new_run_id(model_name: str) -> str:
    """Sortable by time, unlikely to repeat."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    return f"{stamp}_{model_name.strip().lower().replace(' ', '_')}_{uuid4().hex[:8]}"


# ---- rows of the tables -------------------------------------------------------


def metric_rows(runs: DataFrame) -> DataFrame:
    """Two rows per run from ``validation`` and ``test`` metric structs beside its id."""
    both = F.array(
        *[
            F.struct(F.lit(s).alias("split"), *[F.col(f"{s}.{m}").alias(m) for m in METRIC_NAMES])
            for s in SCORED_SPLITS
        ]
    )
    return conform(runs.select("run_id", F.inline(both)), "run_metrics")


def threshold_rows(table: DataFrame, run_id: Column) -> DataFrame:
    return conform(table.withColumn("run_id", run_id), "threshold_evaluations")


def absent_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new rows whose key is not in the table yet."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return existing.unionByName(absent_rows(new, existing, keys))


def upsert_last(
    existing: DataFrame, new: DataFrame, key: str, existing_order: Column | None = None
) -> DataFrame:
    """Union in which the last row per key stays; new rows come after existing ones."""
    order = existing_order if existing_order is not None else F.lit(0)
    both = existing.withColumns({"_new": F.lit(0), "_at": order}).unionByName(
        new.withColumns({"_new": F.lit(1), "_at": order})
    )
    last = Window.partitionBy(key).orderBy(F.col("_new").desc(), F.col("_at").desc())
    return (
        both.withColumn("_nth", F.row_number().over(last))
        .filter("_nth = 1")
        .drop("_nth", "_new", "_at")
    )


def promote(promotions: DataFrame, candidate: DataFrame) -> DataFrame:
    """The promotions after ``candidate`` (one row, no id) became the only active one.

    A promotion of the same run and hash is activated again rather than repeated.
    """
    same = ["run_id", "pipeline_sha256"]
    chosen = candidate.select(*same, F.lit(True).alias("_chosen"))
    updated = (
        promotions.join(F.broadcast(chosen), same, "left")
        .withColumn("is_active", F.coalesce("_chosen", F.lit(False)))
        .select(*promotions.columns)
    )
    last_id = promotions.select(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    added = (
        absent_rows(candidate, promotions, same)
        .withColumns({"is_active": F.lit(True), "id": last_id + 1})
        .select(*promotions.columns)
    )
    return updated.unionByName(added)


def delete_runs(
    tables: Mapping[str, DataFrame], deleted: DataFrame
) -> dict[str, DataFrame]:
    """Remove runs with their rows; promotions stay but no longer name the run."""
    gone = deleted.select("run_id").distinct()
    out = {}
    for name, df in tables.items():
        if name == "baseline_promotions":
            marked = df.join(gone.withColumn("_gone", F.lit(True)), "run_id", "left")
            out[name] = marked.withColumn(
                "run_id", F.when(F.col("_gone").isNull(), F.col("run_id"))
            ).select(*df.columns)
        else:
            out[name] = df.join(gone, "run_id", "left_anti")
    return out


# ---- checks -------------------------------------------------------------------


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rule, violations) of the declared domains and keys."""

    def outside(column: str, allowed: Sequence[str]) -> Column:
        return F.count_if(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))

    domain = {
        "training_runs": ("audit_status", AUDIT_STATES),
        "run_metrics": ("split", SCORED_SPLITS),
        "threshold_evaluations": ("split", SCORED_SPLITS),
        "baseline_promotions": ("audit_status", PROMOTION_STATES),
    }
    checks = []

    def add(name: str, rule: str, counted: DataFrame) -> None:
        checks.append(
            counted.select(
                F.lit(name).alias("table"), F.lit(rule).alias("rule"), F.col("violations")
            )
        )

    for name, df in tables.items():
        if name in domain:
            column, allowed = domain[name]
            add(name, f"{column}_domain", df.agg(outside(column, allowed).alias("violations")))
        repeated = df.groupBy(*KEYS[name]).agg(F.count("*").alias("n"))
        add(name, "key_unique", repeated.agg(F.count_if(F.col("n") > 1).alias("violations")))
        if name == "baseline_promotions":
            extra = F.greatest(F.count_if(F.col("is_active")) - 1, F.lit(0))
            add(name, "one_active", df.agg(extra.alias("violations")))
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


# ---- rollups and the fact view --------------------------------------------------


def metrics_by_split(run_metrics: DataFrame) -> DataFrame:
    """One row per run with ``validation_*`` and ``test_*`` columns."""
    return (
        run_metrics.groupBy("run_id")
        .pivot("split", list(SCORED_SPLITS))
        .agg(*[F.max(m).alias(m) for m in METRIC_NAMES])
    )


def threshold_rollup(evaluations: DataFrame) -> DataFrame:
    """Count, range and ordered list of the evaluated thresholds per run."""
    entry = F.struct(
        "split",
        "threshold",
        *[c for c in evaluations.columns if c not in ("run_id", "split", "threshold")],
    )
    return evaluations.groupBy("run_id").agg(
        F.count("*").alias("threshold_evaluation_count"),
        F.min("threshold").alias("threshold_min"),
        F.max("threshold").alias("threshold_max"),
        F.array_sort(F.collect_list(entry)).alias("threshold_evaluations"),
    )


def artifact_rollup(artifacts: DataFrame) -> DataFrame:
    entry = F.struct("artifact_type", "uri", "sha256", "size_bytes", "created_at")
    return artifacts.groupBy("run_id").agg(
        F.count("*").alias("artifact_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("artifact_total_size_bytes"),
        F.array_sort(F.collect_list(entry)).alias("artifacts"),
    )


def promotion_rollup(promotions: DataFrame) -> DataFrame:
    """Per run: how often promoted, whether active, last time, newest first."""
    entry = F.struct(
        "promoted_at",
        F.col("id").alias("promotion_id"),
        "audit_status",
        "pipeline_sha256",
        "is_active",
        "metadata",
    )
    return (
        promotions.filter(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(
            F.count("*").alias("baseline_promotion_count"),
            F.bool_or("is_active").alias("is_active_baseline"),
            F.max("promoted_at").alias("last_promoted_at"),
            F.sort_array(F.collect_list(entry), asc=False).alias("baseline_promotions"),
        )
    )


def dense_ranks(
    df: DataFrame, value: str, out: str, limits: ScaleLimits, descending: bool, by=()
) -> DataFrame:
    """Add a dense rank, missing values last, from the running count of distinct values."""
    keys = [*by, value]
    distinct = pin(df.select(*keys).filter(F.col(value).isNotNull()).distinct())
    counted = running_sums(
        distinct.withColumn("_one", F.lit(1)), by, value, ["_one"], limits, descending
    )
    ranks = counted.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], (F.col("_one_before") + 1).alias(out)
    )
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in by]
    known = df.filter(F.col(value).isNotNull()).join(ranks, [*same, F.col(value) == F.col(f"_r_{value}")], "left")
    # Rows without a value are not joined, where they would all meet in one task.
    missing = df.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast(ranks.schema[out].dataType))
    ranked = known.select(*df.columns, out).unionByName(missing)
    # Missing values share the rank after the last one.
    sizes = distinct.groupBy(*[F.col(k).alias(f"_s_{k}") for k in by]).agg(
        F.count("*").alias("_n")
    )
    if by:
        same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in by]
        ranked = ranked.join(sizes, same, "left")
    else:
        ranked = ranked.withColumn("_n", sizes.scalar())
    after_last = F.coalesce("_n", F.lit(0)) + 1
    return ranked.withColumn(out, F.coalesce(out, after_last).cast("int")).select(*df.columns, out)


# Rank column, ranked column, highest first, ranked within.
RANKS = (
    ("test_pr_auc_rank", "test_pr_auc", True, ()),
    ("test_fbeta_rank", "test_fbeta", True, ()),
    ("test_business_cost_rank", "test_business_cost", False, ()),
    ("model_test_pr_auc_rank", "test_pr_auc", True, ("model_name",)),
)


def run_ranks(fact: DataFrame, limits: ScaleLimits, rows: int) -> DataFrame:
    """The four ranks per run, on the ranked columns alone."""
    narrow = fact.select("run_id", "model_name", "test_pr_auc", "test_fbeta", "test_business_cost")
    if rows > limits.rows_per_run:
        narrow = pin(narrow)
        for out, value, descending, by in RANKS:
            narrow = dense_ranks(narrow, value, out, limits, descending, by)
    else:
        for out, value, descending, by in RANKS:
            order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
            rank = F.dense_rank().over(Window.partitionBy(*by).orderBy(order))
            narrow = narrow.withColumn(out, rank)
    return narrow.select("run_id", *[r[0] for r in RANKS])


def fact_model_runs(
    tables: Mapping[str, DataFrame], limits: ScaleLimits, rows: int | None = None
) -> DataFrame:
    """One analytical row per run: settings, metrics, lists and ranks."""
    runs = tables["training_runs"]
    rows = runs.count() if rows is None else rows
    fact = (
        runs.join(metrics_by_split(tables["run_metrics"]), "run_id", "left")
        .join(threshold_rollup(tables["threshold_evaluations"]), "run_id", "left")
        .join(artifact_rollup(tables["run_artifacts"]), "run_id", "left")
        .join(promotion_rollup(tables["baseline_promotions"]), "run_id", "left")
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(False)
    defaults = {
        "threshold_evaluation_count": zero,
        "artifact_count": zero,
        "artifact_total_size_bytes": zero,
        "baseline_promotion_count": zero,
        "is_active_baseline": none,
    }
    lists = ("threshold_evaluations", "artifacts", "baseline_promotions")
    filled = fact.withColumns(
        {c: F.coalesce(F.col(c), v) for c, v in defaults.items()}
        | {c: F.coalesce(F.col(c), F.array().cast(fact.schema[c].dataType)) for c in lists}
    )
    return filled.join(run_ranks(filled, limits, rows), "run_id")


# ---- comparison index -----------------------------------------------------------

_INDEXED_METRICS = ("precision", "recall", "f1", "fbeta", "pr_auc", "roc_auc", "tp", "fp", "fn")


def index_row(
    spark: SparkSession,
    metadata: Mapping[str, Any],
    report: Mapping[str, Any],
    run_directory: str,
) -> DataFrame:
    """The flat 40-column comparison row of one finished run."""
    run, chosen = metadata["run"], metadata["threshold_selection"]
    data = metadata["dataset"]
    values: list[tuple[str, str, Any]] = [
        ("run_id", "string", run["run_id"]),
        ("completed_at_utc", "string", run["completed_at_utc"]),
        ("duration_seconds", "double", run["duration_seconds"]),
        ("model_name", "string", metadata["model_name"]),
        ("threshold", "double", metadata["threshold"]),
        ("threshold_strategy", "string", chosen["strategy"]),
        ("false_positive_cost", "double", chosen["false_positive_cost"]),
        ("false_negative_cost", "double", chosen["false_negative_cost"]),
    ]
    for split in SCORED_SPLITS:
        metrics = metadata[f"{split}_metrics"]
        values += [(f"{split}_{m}", "double", metrics[m]) for m in _INDEXED_METRICS]
        values.append(
            (f"{split}_business_cost", "double", metadata["operational_costs"][split])
        )
    values += [
        ("audit_status", "string", report["status"]),
        ("audit_warning_count", "int", len(report.get("warnings", []))),
        ("training_max_rows", "bigint", metadata["training_max_rows"]),
    ]
    values += [(f"{s}_rows", "bigint", data[f"{s}_rows"]) for s in ("train", *SCORED_SPLITS)]
    values += [
        (f"{s}_positive_rate", "double", data[f"{s}_positive_rate"])
        for s in ("train", *SCORED_SPLITS)
    ]
    values += [
        ("strict_leakage_prevention", "boolean", metadata["strict_leakage_prevention"]),
        ("pipeline_sha256", "string", run["pipeline_sha256"]),
        ("run_directory", "string", run_directory),
    ]
    schema = ", ".join(f"{n} {t}" for n, t, _ in values)
    row = tuple(
        float(v) if t == "double" and v is not None else v for _, t, v in values
    )
    return spark.createDataFrame([row], schema)


def run_index(index: DataFrame) -> DataFrame:
    """Newest run first."""
    return index.orderBy(F.col("completed_at_utc").desc())


def leaderboard(index: DataFrame, metric: str = "test_pr_auc", count: int = 10) -> DataFrame:
    if metric not in LEADERBOARD_METRICS:
        raise ValueError(f"rank by one of {LEADERBOARD_METRICS}")
    return (
        index.orderBy(F.col(metric).desc_nulls_last(), "run_id")
        .limit(count)
        .select(*LEADERBOARD_COLUMNS)
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The model of highest validation PR-AUC."""
    return (
        metrics.filter(F.col("split") == "validation")
        .agg(F.max_by("model", "pr_auc").alias("model"), F.max("pr_auc").alias("pr_auc"))
    )


def comparison(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("split", F.col("pr_auc").desc())


def long_metrics(
    metrics: DataFrame, names: Sequence[str] = ("pr_auc", "recall", "precision", "f1", "fbeta")
) -> DataFrame:
    """One row per model, split and metric."""
    return metrics.unpivot(["model", "split"], list(names), "metric", "value")
