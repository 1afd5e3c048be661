"""Run history: one run per event type, with its metrics, thresholds and promotions."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from catalog.domain import (
    CFG,
    RATIOS_SQL,
    TX_SQL,
    rounded,
    split_sql,
    stamp,
    tied_score,
    transactions,
)
from catalog.registry import query
from riskloom.operators.metrics import evaluate
from riskloom.operators.split import temporal_split
from riskloom.operators.thresholds import business_cost, configured_table
from riskloom.plans import tracking as K
from riskloom.plans.store import RunStore
from riskloom.plans.training import metric_frame, run_artifacts, run_row
from riskloom.session import create_if_absent, ensure_checkpoint_dir, join_path, path_exists, pin
from riskloom.sources.artifacts import ARTIFACT_TYPES, artifact_type

# ---- the tables in SQL ----------------------------------------------------------

_BASE_SQL = f"""{TX_SQL},
{split_sql('tx')},
scored AS (
  SELECT 'run_' || use_chip AS run_id, use_chip AS model_name, split, date,
         CAST(amount > 30 AS INTEGER) AS flag, CAST((pos * 7919) % 1000 AS DOUBLE) / 1000 AS score
  FROM parts),
grid AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM generate_series(8, 30) g(i)),
outcomes AS (
  SELECT run_id, split, threshold,
         count(*) FILTER (WHERE score >= threshold AND flag = 1) AS tp,
         count(*) FILTER (WHERE score >= threshold AND flag = 0) AS fp,
         count(*) FILTER (WHERE score < threshold AND flag = 0) AS tn,
         count(*) FILTER (WHERE score < threshold AND flag = 1) AS fn
  FROM scored, grid WHERE split <> 'train' GROUP BY 1, 2, 3),
evaluations AS (
  SELECT run_id, split, threshold, {RATIOS_SQL}, tp, fp, tn, fn, tp + fp AS alerts,
    (tp + fp) / CAST(tp + fp + tn + fn AS DOUBLE) AS alert_rate,
    CAST(fp + 25 * fn AS DOUBLE) AS business_cost,
    (fp + 25 * fn) / CAST(tp + fp + tn + fn AS DOUBLE) AS cost_per_record FROM outcomes),
chosen AS (
  SELECT run_id, threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id
      ORDER BY business_cost, fn, fp, threshold DESC) AS k
    FROM evaluations WHERE split = 'validation') WHERE k = 1),
counts AS (
  SELECT run_id, split, score, sum(flag) AS pos_n, sum(1 - flag) AS neg_n
  FROM scored WHERE split <> 'train' GROUP BY 1, 2, 3),
ranked AS (
  SELECT *, sum(pos_n) OVER w AS c_tp, sum(neg_n) OVER w AS c_fp FROM counts
  WINDOW w AS (PARTITION BY run_id, split ORDER BY score DESC)),
areas AS (
  SELECT run_id, split, sum(pos_n * (c_tp / CAST(c_tp + c_fp AS DOUBLE))) / sum(pos_n) AS pr_auc,
    sum(neg_n * (c_tp - 0.5 * pos_n)) / CAST(sum(pos_n) * sum(neg_n) AS DOUBLE) AS roc_auc
  FROM ranked GROUP BY 1, 2),
run_metrics AS (
  SELECT e.run_id, e.split, e.threshold, precision, recall, f1, fbeta, pr_auc, roc_auc,
    tp, fp, tn, fn, business_cost
  FROM evaluations e JOIN chosen c ON e.run_id = c.run_id AND e.threshold = c.threshold
  JOIN areas a ON e.run_id = a.run_id AND e.split = a.split),
training_runs AS (
  SELECT s.run_id, model_name, strftime(min(date), '%Y-%m-%d %H:%M:%S') AS started_at,
    strftime(max(date), '%Y-%m-%d %H:%M:%S') AS completed_at,
    epoch_us(max(date)) AS completed_us, max(c.threshold) AS threshold,
    count(*) FILTER (WHERE split = 'train') AS train_rows,
    count(*) FILTER (WHERE split = 'validation') AS validation_rows,
    count(*) FILTER (WHERE split = 'test') AS test_rows,
    avg(flag) FILTER (WHERE split = 'train') AS train_positive_rate,
    CASE WHEN max(c.threshold) IN (0.08, 0.3) THEN 'warning' ELSE 'pass' END AS audit_status
  FROM scored s JOIN chosen c ON s.run_id = c.run_id GROUP BY 1, 2),
run_artifacts AS (
  SELECT run_id, CASE name WHEN 'pipeline' THEN 'pipeline' WHEN 'model_metadata' THEN 'metadata_table'
      WHEN 'metadata.json' THEN 'metadata_json' WHEN 'threshold_analysis.csv' THEN 'threshold_analysis'
      WHEN 'leakage_audit.json' THEN 'leakage_audit' ELSE 'other' END AS artifact_type,
    'runs/' || run_id || '/' || name AS uri, sha256(sha256(content)) AS sha256, octet_length(encode(content)) AS size_bytes
  FROM (SELECT *, run_id || ' ' || name || ' ' || CAST(train_rows AS VARCHAR) || chr(10) AS content
    FROM training_runs, (SELECT unnest(['pipeline', 'model_metadata', 'metadata.json',
      'threshold_analysis.csv', 'leakage_audit.json', 'notes.txt']) AS name))),
best AS (
  SELECT run_id FROM run_metrics WHERE split = 'test' ORDER BY pr_auc DESC, run_id LIMIT 1),
promotions AS (
  SELECT completed_us AS id, run_id, completed_at AS promoted_at,
    audit_status, sha256(run_id) AS pipeline_sha256, run_id = (SELECT run_id FROM best) AS is_active
  FROM training_runs WHERE model_name <> 'click'),
all_promotions AS (
  SELECT * FROM promotions
  UNION ALL SELECT (SELECT max(id) FROM promotions) + 1, r.run_id, completed_at, audit_status, sha256(r.run_id), true
  FROM training_runs r JOIN best USING (run_id) WHERE r.run_id NOT IN (SELECT run_id FROM promotions))"""


# ---- the same tables in Spark ---------------------------------------------------

_KEYS = ["run_id", "split"]


def _scored(spark, sf_dir) -> DataFrame:
    parts = temporal_split(transactions(spark, sf_dir), CFG)
    return parts.select(
        F.concat(F.lit("run_"), "use_chip").alias("run_id"),
        F.col("use_chip").alias("model_name"),
        "split",
        "date",
        (F.col("amount") > 30).cast("int").alias("flag"),
        tied_score().alias("score"),
    )


def _later(scored: DataFrame) -> DataFrame:
    return scored.filter("split <> 'train'")


def _evaluations(scored: DataFrame) -> DataFrame:
    table = configured_table(_later(scored), CFG, "flag", "score", _KEYS)
    return K.threshold_rows(table, F.col("run_id"))


def _chosen(evaluations: DataFrame) -> DataFrame:
    """The cheapest validation threshold per run: the smallest of ordered structs."""
    order = F.struct("business_cost", "fn", "fp", (-F.col("threshold")).alias("down"))
    return (
        evaluations.filter("split = 'validation'")
        .groupBy("run_id")
        .agg(F.min_by(F.col("threshold").cast("double"), order).alias("threshold"))
    )


def _metrics(scored: DataFrame, chosen: DataFrame) -> DataFrame:
    rows = _later(scored).join(chosen, "run_id")
    table = evaluate(
        rows, "flag", "score", "threshold", CFG.beta, CFG.limits, [*_KEYS, "threshold"]
    )
    cost = business_cost(CFG.false_positive_cost, CFG.false_negative_cost)
    priced = table.withColumn("business_cost", cost)
    side = F.struct(*K.METRIC_NAMES)
    wide = priced.groupBy("run_id").agg(
        *[F.first(F.when(F.col("split") == s, side), True).alias(s) for s in K.SCORED_SPLITS]
    )
    return K.metric_rows(wide)


def _runs(scored: DataFrame, chosen: DataFrame) -> DataFrame:
    rows = [
        F.count_if(F.col("split") == s).alias(f"{s}_rows")
        for s in ("train", "validation", "test")
    ]
    rates = [
        F.avg(F.when(F.col("split") == s, F.col("flag"))).alias(f"{s}_positive_rate")
        for s in ("train", "validation", "test")
    ]
    base = scored.groupBy("run_id", "model_name").agg(
        F.min("date").alias("started_at"), F.max("date").alias("completed_at"), *rows, *rates
    )
    edge = F.col("threshold").isin(CFG.grid_start, CFG.grid_stop)
    seconds = (
        F.unix_micros("completed_at") - F.unix_micros("started_at")
    ).cast("decimal(20,0)") / 1000000
    full = base.join(chosen, "run_id").withColumns(
        {
            "duration_seconds": seconds,
            "selected_threshold": F.col("threshold"),
            "threshold_strategy": F.lit(CFG.threshold_strategy),
            "false_positive_cost": F.lit(CFG.false_positive_cost),
            "false_negative_cost": F.lit(CFG.false_negative_cost),
            "audit_status": F.when(edge, "warning").otherwise("pass"),
            "audit_warning_count": edge.cast("int"),
            "training_max_rows": F.lit(None),
            "strict_leakage_prevention": F.lit(CFG.strict_leakage),
            "pipeline_sha256": F.sha2("run_id", 256),
            "run_directory": F.concat(F.lit("runs/"), "run_id"),
            "metadata": F.to_json(F.struct("run_id", "model_name")),
            "leakage_audit": F.lit("{}"),
            "created_at": F.col("completed_at"),
        }
    )
    return K.conform(full, "training_runs")


def _content(run_id: str, name: str, train_rows: int) -> str:
    return f"{run_id} {name} {train_rows}\n"


def _artifacts(runs: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(n) for n in (*ARTIFACT_TYPES, "notes.txt")])
    rows = runs.withColumn("name", F.explode(names))
    content = F.concat("run_id", F.lit(" "), "name", F.lit(" "), F.col("train_rows").cast("string"), F.lit("\n"))
    return K.conform(
        rows.withColumns(
            {
                "artifact_type": artifact_type(F.col("name")),
                "uri": F.concat_ws("/", F.lit("runs"), "run_id", "name"),
                "sha256": F.sha2(F.sha2(content, 256), 256),
                "size_bytes": F.octet_length(content),
            }
        ),
        "run_artifacts",
    )


def recorded(spark, sf_dir) -> RunStore:
    """A store in which each run was recorded with its files, as a training job does it, and
    promoted; the best one last."""
    scored = pin(_scored(spark, sf_dir))
    evaluations = pin(_evaluations(scored))
    chosen = pin(_chosen(evaluations))
    # One row per run and per run and split: there are as many runs as event types.
    runs = _runs(scored, chosen).withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("started_at", "completed_at")}).collect()
    metrics = {(r["run_id"], r["split"]): r for r in _metrics(scored, chosen).collect()}
    store = RunStore(spark, join_path(ensure_checkpoint_dir(spark), f"runs-{uuid4().hex}"))
    for r in sorted(runs, key=lambda r: r["completed_at"]):
        run_id, folder = r["run_id"], store.run_directory(r["run_id"])
        for name in (*ARTIFACT_TYPES, "notes.txt"):
            create_if_absent(spark, join_path(folder, name), _content(run_id, name, r["train_rows"]))
        about = {
            "model_name": r["model_name"],
            "threshold": float(r["selected_threshold"]),
            "training_max_rows": r["training_max_rows"],
            "strict_leakage_prevention": r["strict_leakage_prevention"],
            **{f"{s}_metrics": {m: metrics[run_id, s][m] for m in K.METRIC_NAMES} for s in K.SCORED_SPLITS},
            "threshold_selection": {
                "strategy": r["threshold_strategy"],
                "false_positive_cost": float(r["false_positive_cost"]),
                "false_negative_cost": float(r["false_negative_cost"]),
            },
            "operational_costs": {s: float(metrics[run_id, s]["business_cost"]) for s in K.SCORED_SPLITS},
            "dataset": {f"{s}_{c}": r[f"{s}_{c}"] for s in ("train", *K.SCORED_SPLITS) for c in ("rows", "positive_rate")},
            "run": {
                "run_id": run_id,
                **{f"{c}_utc": datetime.fromisoformat(r[c]).isoformat() + "+00:00" for c in ("started_at", "completed_at")},
                "duration_seconds": float(r["duration_seconds"]),
                "pipeline_sha256": r["pipeline_sha256"],
            },
        }
        report = {"status": r["audit_status"], "warnings": ["threshold_at_edge"] * r["audit_warning_count"]}
        own = evaluations.filter(F.col("run_id") == run_id)
        store.record(about, report, run_row(spark, about, report), metric_frame(spark, about), own, run_artifacts(spark, run_id, folder))
    best = max(runs, key=lambda r: (metrics[r["run_id"], "test"]["pr_auc"], [-ord(c) for c in r["run_id"]]))
    for r in [*sorted(runs, key=lambda r: r["completed_at"]), best]:
        store.promote(r["run_id"], overwrite=True)
    return store


_RECORDED: dict[tuple[str, str], RunStore] = {}


def _store(spark, sf_dir) -> RunStore:
    """The recorded store of a folder, made once per session as long as it is there."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _RECORDED or not path_exists(spark, _RECORDED[key].root):
        _RECORDED[key] = recorded(spark, sf_dir)
    return _RECORDED[key]


def _promotions(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every run but one promoted once when it ended; then the best one made active."""
    past = K.conform(
        runs.filter("model_name <> 'click'").withColumns(
            {
                "id": F.unix_micros("completed_at"),
                "promoted_at": F.col("completed_at"),
                "is_active": F.lit(False),
            }
        ),
        "baseline_promotions",
    )
    best = metrics.filter("split = 'test'").agg(
        F.max_by("run_id", F.struct("pr_auc", "run_id")).alias("best")
    )
    candidate = runs.join(best, F.col("run_id") == F.col("best")).select(
        "run_id",
        F.col("completed_at").alias("promoted_at"),
        "audit_status",
        "pipeline_sha256",
        "metadata",
    )
    return K.promote(past, candidate)


def run_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The five tables, written out as a store would have them."""
    scored = pin(_scored(spark, sf_dir))
    evaluations = pin(_evaluations(scored))
    chosen = pin(_chosen(evaluations))
    metrics = pin(_metrics(scored, chosen))
    runs = pin(_runs(scored, chosen))
    return {
        "training_runs": runs,
        "run_metrics": metrics,
        "threshold_evaluations": evaluations,
        "run_artifacts": _artifacts(runs),
        "baseline_promotions": pin(_promotions(runs, metrics)),
    }


_METRIC_DOUBLES = ["precision", "recall", "f1", "fbeta", "pr_auc", "roc_auc"]


def _double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "training_runs",
    f"""WITH {_BASE_SQL} SELECT run_id, model_name, started_at, completed_at,
      threshold AS selected_threshold, audit_status, train_rows, validation_rows, test_rows,
      round(train_positive_rate, 6) AS train_positive_rate FROM training_runs""",
)
def _(spark, sf_dir):
    """The rows of recorded runs."""
    runs = _store(spark, sf_dir).table("training_runs")
    shown = _double(runs, "selected_threshold").withColumns(
        {c: stamp(F.col(c)) for c in ("started_at", "completed_at")}
    )
    return rounded(shown, ["train_positive_rate"]).select(
        "run_id",
        "model_name",
        "started_at",
        "completed_at",
        "selected_threshold",
        "audit_status",
        "train_rows",
        "validation_rows",
        "test_rows",
        "train_positive_rate",
    )


_SHOW_METRICS = ", ".join(f"round({m}, 6) AS {m}" for m in _METRIC_DOUBLES)


@query(
    "run_metrics",
    f"""WITH {_BASE_SQL} SELECT run_id, split, threshold, {_SHOW_METRICS},
    tp, fp, tn, fn, business_cost FROM run_metrics""",
)
def _(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    metrics = _metrics(scored, _chosen(_evaluations(scored)))
    return rounded(_double(metrics, "threshold", "business_cost"), _METRIC_DOUBLES)


@query(
    "threshold_evaluations",
    f"""WITH {_BASE_SQL} SELECT run_id, split, threshold, round(precision, 6) AS precision,
      round(recall, 6) AS recall, round(f1, 6) AS f1, round(fbeta, 6) AS fbeta, tp, fp, tn, fn,
      alerts, round(alert_rate, 6) AS alert_rate, business_cost,
      round(cost_per_record, 6) AS cost_per_record FROM evaluations""",
)
def _(spark, sf_dir):
    rows = _double(_evaluations(_scored(spark, sf_dir)), "threshold", "business_cost")
    ratios = ["precision", "recall", "f1", "fbeta", "alert_rate", "cost_per_record"]
    return rounded(rows, ratios)


@query(
    "run_artifacts",
    f"""WITH {_BASE_SQL} SELECT run_id, artifact_type, uri, sha256, size_bytes FROM run_artifacts""",
)
def _(spark, sf_dir):
    """The inventory of the files that lie in the runs' folders."""
    return _store(spark, sf_dir).table("run_artifacts").drop("created_at")


@query(
    "baseline_promotions",
    f"""WITH {_BASE_SQL} SELECT id, run_id, promoted_at, audit_status, pipeline_sha256,
      CAST(is_active AS INTEGER) AS is_active FROM promotions
    UNION ALL SELECT (SELECT max(id) FROM promotions) + 1, r.run_id, completed_at, audit_status,
      sha256(r.run_id), 1 FROM training_runs r JOIN best USING (run_id)
      WHERE r.run_id NOT IN (SELECT run_id FROM promotions)""",
)
def _(spark, sf_dir):
    tables = run_tables(spark, sf_dir)
    shown = tables["baseline_promotions"].withColumns(
        {"promoted_at": stamp(F.col("promoted_at")), "is_active": F.col("is_active").cast("int")}
    )
    return shown.drop("metadata")


_PIVOT_SQL = ",\n      ".join(
    f"round(CAST(max({m}) FILTER (WHERE split = '{s}') AS DOUBLE), 6) AS {s}_{m}"
    for s in K.SCORED_SPLITS
    for m in K.METRIC_NAMES
)


@query(
    "metrics_by_split",
    f"WITH {_BASE_SQL} SELECT run_id, {_PIVOT_SQL} FROM run_metrics GROUP BY run_id",
)
def _(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    wide = K.metrics_by_split(_metrics(scored, _chosen(_evaluations(scored))))
    return rounded(wide, [c for c in wide.columns if c != "run_id"])


@query(
    "threshold_rollup",
    f"""WITH {_BASE_SQL} SELECT run_id, count(*) AS threshold_evaluation_count,
      min(threshold) AS threshold_min, max(threshold) AS threshold_max,
      string_agg(split || ':' || CAST(CAST(round(threshold * 100) AS INTEGER) AS VARCHAR) || ':' ||
        CAST(alerts AS VARCHAR), ',' ORDER BY split, threshold) AS listed
    FROM evaluations GROUP BY run_id""",
)
def _(spark, sf_dir):
    rolled = K.threshold_rollup(_evaluations(_scored(spark, sf_dir)))
    listed = F.transform(
        "threshold_evaluations",
        lambda e: F.concat_ws(":", e["split"], F.round(e["threshold"] * 100).cast("int"), e["alerts"]),
    )
    return _double(rolled, "threshold_min", "threshold_max").select(
        "run_id",
        "threshold_evaluation_count",
        "threshold_min",
        "threshold_max",
        F.array_join(listed, ",").alias("listed"),
    )


@query(
    "artifact_rollup",
    f"""WITH {_BASE_SQL} SELECT run_id, count(*) AS artifact_count,
      CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS artifact_total_size_bytes,
      string_agg(artifact_type || '=' || uri, ',' ORDER BY artifact_type, uri) AS listed
    FROM run_artifacts GROUP BY run_id""",
)
def _(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    rolled = K.artifact_rollup(_artifacts(_runs(scored, _chosen(_evaluations(scored)))))
    listed = F.transform("artifacts", lambda a: F.concat_ws("=", a["artifact_type"], a["uri"]))
    return rolled.withColumn("listed", F.array_join(listed, ",")).drop("artifacts")


@query(
    "promotion_rollup",
    f"""WITH {_BASE_SQL} SELECT run_id, count(*) AS baseline_promotion_count,
      CAST(bool_or(is_active) AS INTEGER) AS is_active_baseline,
      max(promoted_at) AS last_promoted_at,
      string_agg(CAST(id AS VARCHAR), ',' ORDER BY promoted_at DESC) AS listed
    FROM all_promotions GROUP BY run_id""",
)
def _(spark, sf_dir):
    rolled = K.promotion_rollup(run_tables(spark, sf_dir)["baseline_promotions"])
    listed = F.transform("baseline_promotions", lambda p: p["promotion_id"].cast("string"))
    return rolled.select(
        "run_id",
        "baseline_promotion_count",
        F.col("is_active_baseline").cast("int").alias("is_active_baseline"),
        stamp(F.col("last_promoted_at")).alias("last_promoted_at"),
        F.array_join(listed, ",").alias("listed"),
    )


_FACT_SQL = f"""{_BASE_SQL},
wide AS (SELECT run_id, {_PIVOT_SQL} FROM run_metrics GROUP BY run_id),
fact AS (
  SELECT r.run_id, r.model_name, r.audit_status, r.train_rows, w.validation_pr_auc, w.test_pr_auc,
    w.test_fbeta, w.test_recall, w.test_precision, w.test_business_cost, r.threshold, r.completed_at,
    (SELECT count(*) FROM evaluations e WHERE e.run_id = r.run_id) AS threshold_evaluation_count,
    (SELECT count(*) FROM run_artifacts a WHERE a.run_id = r.run_id) AS artifact_count,
    (SELECT CAST(coalesce(sum(size_bytes), 0) AS BIGINT) FROM run_artifacts a
      WHERE a.run_id = r.run_id) AS artifact_total_size_bytes,
    (SELECT count(*) FROM all_promotions p WHERE p.run_id = r.run_id) AS baseline_promotion_count,
    CAST((SELECT coalesce(bool_or(is_active), false) FROM all_promotions p
      WHERE p.run_id = r.run_id) AS INTEGER) AS is_active_baseline,
    (SELECT string_agg(split || ':' || CAST(CAST(round(e.threshold * 100) AS INTEGER) AS VARCHAR), ',' ORDER BY split, e.threshold)
      FROM evaluations e WHERE e.run_id = r.run_id) AS thresholds_listed,
    (SELECT string_agg(artifact_type || '=' || sha256, ',' ORDER BY artifact_type, uri)
      FROM run_artifacts a WHERE a.run_id = r.run_id) AS artifacts_listed,
    coalesce((SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY promoted_at DESC, id DESC)
      FROM all_promotions p WHERE p.run_id = r.run_id), '') AS promotions_listed
  FROM training_runs r LEFT JOIN wide w ON w.run_id = r.run_id)"""


@query(
    "fact_model_runs",
    f"""WITH {_FACT_SQL} SELECT * EXCLUDE (threshold, completed_at, test_recall, test_precision,
      validation_pr_auc),
      dense_rank() OVER (ORDER BY test_pr_auc DESC NULLS LAST) AS test_pr_auc_rank,
      dense_rank() OVER (ORDER BY test_fbeta DESC NULLS LAST) AS test_fbeta_rank,
      dense_rank() OVER (ORDER BY test_business_cost NULLS LAST) AS test_business_cost_rank,
      dense_rank() OVER (PARTITION BY model_name ORDER BY test_pr_auc DESC NULLS LAST)
        AS model_test_pr_auc_rank FROM fact""",
)
def _(spark, sf_dir):
    fact = K.fact_model_runs(run_tables(spark, sf_dir), CFG.limits)
    shown = rounded(fact, ["test_pr_auc", "test_fbeta", "test_business_cost"])
    return shown.select(
        "run_id",
        "model_name",
        "audit_status",
        "train_rows",
        "test_pr_auc",
        "test_fbeta",
        "test_business_cost",
        "threshold_evaluation_count",
        "artifact_count",
        "artifact_total_size_bytes",
        "baseline_promotion_count",
        F.col("is_active_baseline").cast("int").alias("is_active_baseline"),
        F.array_join(F.transform("threshold_evaluations", lambda e: F.concat_ws(":", e["split"], F.round(e["threshold"] * 100).cast("int"))), ",").alias("thresholds_listed"),
        F.array_join(F.transform("artifacts", lambda a: F.concat_ws("=", a["artifact_type"], a["sha256"])), ",").alias("artifacts_listed"),
        F.array_join(F.transform("baseline_promotions", lambda p: p["promotion_id"].cast("string")), ",").alias("promotions_listed"),
        *[r[0] for r in K.RANKS],
    )


_RANKS_SQL = """dense_rank() OVER (ORDER BY test_pr_auc DESC NULLS LAST) AS test_pr_auc_rank,
      dense_rank() OVER (ORDER BY test_fbeta DESC NULLS LAST) AS test_fbeta_rank,
      dense_rank() OVER (ORDER BY test_business_cost NULLS LAST) AS test_business_cost_rank,
      dense_rank() OVER (PARTITION BY model_name ORDER BY test_pr_auc DESC NULLS LAST) AS model_test_pr_auc_rank"""


@query("run_ranks", f"WITH {_FACT_SQL} SELECT run_id, {_RANKS_SQL} FROM fact")
def _(spark, sf_dir):
    """The four ranks by counting distinct values, as for a history of any length."""
    scored = _scored(spark, sf_dir)
    chosen = _chosen(_evaluations(scored))
    wide = K.metrics_by_split(_metrics(scored, chosen)).join(_runs(scored, chosen).select("run_id", "model_name"), "run_id")
    narrow = pin(wide.select("run_id", "model_name", "test_pr_auc", "test_fbeta", "test_business_cost"))
    ranked = K.run_ranks(narrow, replace(CFG.limits, rows_per_run=1), narrow.count())
    return ranked.select("run_id", *[r[0] for r in K.RANKS])


def _index(spark, sf_dir) -> DataFrame:
    """The comparison index of all runs, from the stored tables."""
    scored = _scored(spark, sf_dir)
    chosen = _chosen(_evaluations(scored))
    wide = K.metrics_by_split(_metrics(scored, chosen))
    joined = _runs(scored, chosen).join(wide, "run_id")
    return _double(joined, "selected_threshold").withColumns(
        {"threshold": F.col("selected_threshold"), "completed_at_utc": stamp(F.col("completed_at"))}
    )


@query(
    "run_leaderboard",
    f"""WITH {_FACT_SQL} SELECT run_id, model_name, threshold, test_pr_auc, test_fbeta,
      test_recall, test_precision, audit_status FROM fact ORDER BY test_pr_auc DESC, run_id LIMIT 3""",
)
def _(spark, sf_dir):
    rows = K.leaderboard(_index(spark, sf_dir), "test_pr_auc", 3)
    return rounded(rows, ["test_pr_auc", "test_fbeta", "test_recall", "test_precision"])


@query(
    "run_index",
    f"""WITH {_FACT_SQL} SELECT run_id, completed_at AS completed_at_utc, model_name, threshold, audit_status,
      validation_pr_auc, test_pr_auc, test_fbeta, test_recall, test_precision, test_business_cost, train_rows,
      'runs/' || run_id AS run_directory FROM fact ORDER BY completed_at DESC""",
)
def _(spark, sf_dir):
    """The index of the recorded runs."""
    index = _store(spark, sf_dir).index()
    shown = ["validation_pr_auc", "test_pr_auc", "test_fbeta", "test_recall", "test_precision", "test_business_cost"]
    at = stamp(F.col("completed_at_utc").cast("timestamp")).alias("completed_at_utc")
    return rounded(index.select("run_id", at, "model_name", "threshold", "audit_status", *shown, "train_rows", "run_directory"), shown)


@query(
    "promoted_runs",
    f"""WITH {_BASE_SQL} SELECT run_id, audit_status, sha256(run_id) AS pipeline_sha256,
      CAST(run_id = (SELECT run_id FROM best) AS INTEGER) AS is_active FROM training_runs""",
)
def _(spark, sf_dir):
    """Every recorded run was promoted once, the best one twice: it is active, and there once."""
    rows = _store(spark, sf_dir).table("baseline_promotions")
    return rows.select("run_id", "audit_status", "pipeline_sha256", F.col("is_active").cast("int").alias("is_active"))


def _model_metrics(spark, sf_dir) -> DataFrame:
    scored = _scored(spark, sf_dir)
    metrics = _metrics(scored, _chosen(_evaluations(scored)))
    return metrics.withColumn("model", F.col("run_id"))


@query(
    "best_model",
    f"""WITH {_BASE_SQL} SELECT run_id AS model, round(pr_auc, 6) AS pr_auc FROM run_metrics
    WHERE split = 'validation' ORDER BY run_metrics.pr_auc DESC LIMIT 1""",
)
def _(spark, sf_dir):
    return rounded(K.best_model(_model_metrics(spark, sf_dir)), ["pr_auc"])


@query(
    "model_comparison",
    f"""WITH {_BASE_SQL} SELECT run_id AS model, split, round(pr_auc, 6) AS pr_auc,
      round(fbeta, 6) AS fbeta FROM run_metrics ORDER BY split, run_metrics.pr_auc DESC""",
)
def _(spark, sf_dir):
    shown = K.comparison(_model_metrics(spark, sf_dir)).select("model", "split", "pr_auc", "fbeta")
    return rounded(shown, ["pr_auc", "fbeta"])


@query(
    "long_metrics",
    f"""WITH {_BASE_SQL}, m AS (SELECT run_id AS model, split, pr_auc, recall, precision, f1, fbeta
      FROM run_metrics)
    SELECT model, split, metric, round(value, 6) AS value FROM m
    UNPIVOT (value FOR metric IN (pr_auc, recall, precision, f1, fbeta))""",
)
def _(spark, sf_dir):
    return rounded(K.long_metrics(_model_metrics(spark, sf_dir)), ["value"])


@query(
    "table_violations",
    f"""WITH {_BASE_SQL}, n AS (SELECT (SELECT count(*) FROM training_runs) AS runs,
      (SELECT count(*) FROM evaluations WHERE tp < 5) AS few, (SELECT count(*) FROM evaluations WHERE fp = 0) AS exact_,
      (SELECT count(*) FROM all_promotions WHERE audit_status = 'pass' OR is_active) AS active)
    SELECT 'training_runs' AS "table", 'audit_status_domain' AS rule, runs AS violations FROM n
    UNION ALL SELECT 'training_runs', 'key_unique', runs FROM n
    UNION ALL SELECT 'run_metrics', 'split_domain', 2 * runs FROM n
    UNION ALL SELECT 'run_metrics', 'key_unique', runs FROM n
    UNION ALL SELECT 'threshold_evaluations', 'split_domain', exact_ FROM n
    UNION ALL SELECT 'threshold_evaluations', 'key_unique', few FROM n
    UNION ALL SELECT 'run_artifacts', 'key_unique', runs FROM n
    UNION ALL SELECT 'baseline_promotions', 'audit_status_domain', 0 FROM n
    UNION ALL SELECT 'baseline_promotions', 'key_unique', 0 FROM n
    UNION ALL SELECT 'baseline_promotions', 'one_active', greatest(active - 1, 0) FROM n""",
)
def _(spark, sf_dir):
    """All rules on all tables, with faults planted in rows of each."""
    t = run_tables(spark, sf_dir)
    runs, metrics, rows, files, past = (t[n] for n in ("training_runs", "run_metrics", "threshold_evaluations", "run_artifacts", "baseline_promotions"))
    exact = rows.filter("fp = 0").withColumns({"split": F.lit("train"), "threshold": F.col("threshold") + F.when(F.col("split") == "test", 1).otherwise(2)})
    return K.violations(
        {
            "training_runs": runs.unionByName(runs.withColumn("audit_status", F.col("model_name"))),
            "run_metrics": metrics.unionByName(metrics.withColumn("split", F.lit("train"))),
            "threshold_evaluations": rows.unionByName(rows.filter("tp < 5")).unionByName(K.conform(exact, "threshold_evaluations")),
            "run_artifacts": files.unionByName(files.filter("artifact_type = 'other'")),
            "baseline_promotions": past.withColumn("is_active", (F.col("audit_status") == "pass") | F.col("is_active")),
        }
    )


@query(
    "delete_runs",
    f"""WITH {_BASE_SQL}
    SELECT 'training_runs' AS "table", count(*) AS n_rows, count(*) AS named FROM training_runs WHERE run_id <> 'run_purchase'
    UNION ALL SELECT 'run_metrics', count(*), count(*) FROM run_metrics WHERE run_id <> 'run_purchase'
    UNION ALL SELECT 'threshold_evaluations', count(*), count(*) FROM evaluations WHERE run_id <> 'run_purchase'
    UNION ALL SELECT 'run_artifacts', count(*), count(*) FROM run_artifacts WHERE run_id <> 'run_purchase'
    UNION ALL SELECT 'baseline_promotions', count(*), count(*) FILTER (WHERE run_id <> 'run_purchase') FROM training_runs
    UNION ALL SELECT 'run_index', count(*), count(*) FROM training_runs WHERE run_id <> 'run_purchase'""",
)
def _(spark, sf_dir):
    """A run deleted from the store: gone from all tables and the index, nameless in promotions."""
    store = recorded(spark, sf_dir)
    store.delete("run_purchase")
    counts = [
        df.agg(F.count("*").alias("n_rows"), F.count("run_id").alias("named")).select(F.lit(name).alias("table"), "n_rows", "named")
        for name, df in {**store.tables(), "run_index": store.index()}.items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out
