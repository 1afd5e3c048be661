"""Ranking metrics, threshold tables and the choice of a threshold."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import (
    CFG,
    GRID_SQL,
    RANKED_SQL,
    RATIOS_SQL,
    SCORED_SQL,
    rounded,
    scored,
    tied_score,
    transactions,
)
from catalog.registry import query
from riskloom.functions.features import decision
from riskloom.operators import metrics as M, thresholds as H

_LABEL, _SCORE = "is_fraud", "score"
_RATIOS = ["precision", "recall", "f1", "fbeta"]


@query(
    "decision",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id,
    CAST(CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000 >= 0.3 AS INTEGER) AS is_fraud_predicted
    FROM events""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    hit = decision(tied_score(), 0.3)
    return tx.select("transaction_id", hit.alias("is_fraud_predicted"))


@query(
    "confusion_counts",
    f"""WITH {GRID_SQL} SELECT split, tp, fp, tn, fn FROM outcomes WHERE threshold = 0.3""",
)
def _(spark, sf_dir):
    return M.confusion_counts(scored(spark, sf_dir), ["split"], _LABEL, _SCORE, 0.3)


@query(
    "classification_metrics",
    f"""WITH {GRID_SQL}, r AS (SELECT split, threshold, {RATIOS_SQL} FROM outcomes)
    SELECT split, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, round(fbeta, 6) AS fbeta FROM r WHERE threshold = 0.3""",
)
def _(spark, sf_dir):
    counts = M.confusion_counts(scored(spark, sf_dir), ["split"], _LABEL, _SCORE, 0.3)
    return rounded(M.with_ratios(counts, CFG.beta), _RATIOS).select("split", *_RATIOS)


def _ranked(spark, sf_dir):
    return M.ranked_scores(scored(spark, sf_dir), ["split"], _LABEL, _SCORE, CFG.limits)


@query(
    "average_precision",
    f"""WITH {RANKED_SQL}
    SELECT split, round(sum(pos_n * (tp / CAST(tp + fp AS DOUBLE))) / sum(pos_n), 6) AS pr_auc
    FROM ranked GROUP BY split""",
)
def _(spark, sf_dir):
    return rounded(M.ranking_areas(_ranked(spark, sf_dir), ["split"]), ["pr_auc"]).drop("roc_auc")


@query(
    "roc_auc",
    f"""WITH {RANKED_SQL}
    SELECT split, round(sum(neg_n * (tp_before + 0.5 * pos_n)) /
      CAST(sum(pos_n) * sum(neg_n) AS DOUBLE), 6) AS roc_auc FROM ranked GROUP BY split""",
)
def _(spark, sf_dir):
    return rounded(M.ranking_areas(_ranked(spark, sf_dir), ["split"]), ["roc_auc"]).drop("pr_auc")


@query(
    "precision_recall_curve",
    f"""WITH {RANKED_SQL}
    SELECT split, score AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
      round(tp / CAST(p AS DOUBLE), 6) AS recall FROM ranked JOIN totals USING (split)
    UNION ALL SELECT split, NULL, 1.0, 0.0 FROM totals""",
)
def _(spark, sf_dir):
    curve = M.precision_recall_curve(_ranked(spark, sf_dir), ["split"])
    return rounded(curve, ["precision", "recall"])


@query(
    "roc_curve",
    f"""WITH {RANKED_SQL}
    SELECT score AS threshold, round(fp / CAST(n AS DOUBLE), 6) AS fpr,
      round(tp / CAST(p AS DOUBLE), 6) AS tpr
    FROM ranked JOIN totals USING (split) WHERE split = 'test'
    UNION ALL SELECT NULL, 0.0, 0.0""",
)
def _(spark, sf_dir):
    test = scored(spark, sf_dir).filter("split = 'test'")
    ranked = M.ranked_scores(test, [], _LABEL, _SCORE, CFG.limits)
    return rounded(M.roc_curve(ranked, []), ["fpr", "tpr"])


@query(
    "evaluation",
    f"""WITH {RANKED_SQL},
    areas AS (SELECT split, sum(pos_n * (tp / CAST(tp + fp AS DOUBLE))) / sum(pos_n) AS pr_auc,
      sum(neg_n * (tp_before + 0.5 * pos_n)) / CAST(sum(pos_n) * sum(neg_n) AS DOUBLE) AS roc_auc
      FROM ranked GROUP BY split),
    outcomes AS (SELECT split, count(*) FILTER (WHERE score >= 0.12 AND is_fraud = 1) AS tp,
      count(*) FILTER (WHERE score >= 0.12 AND is_fraud = 0) AS fp,
      count(*) FILTER (WHERE score < 0.12 AND is_fraud = 0) AS tn,
      count(*) FILTER (WHERE score < 0.12 AND is_fraud = 1) AS fn FROM scored GROUP BY split),
    r AS (SELECT split, tp, fp, tn, fn, {RATIOS_SQL} FROM outcomes)
    SELECT split, CAST(0.12 AS DOUBLE) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, round(fbeta, 6) AS fbeta, round(pr_auc, 6) AS pr_auc,
      round(roc_auc, 6) AS roc_auc, tp, fp, tn, fn FROM r JOIN areas USING (split)""",
)
def _(spark, sf_dir):
    table = M.evaluate(
        scored(spark, sf_dir), _LABEL, _SCORE, 0.12, CFG.beta, CFG.limits, ("split",)
    )
    return rounded(table, [*_RATIOS, "pr_auc", "roc_auc"])


_TABLE_SQL = f"""{GRID_SQL},
cost_table AS (
  SELECT split, threshold, {RATIOS_SQL}, tp, fp, tn, fn, tp + fp AS alerts,
    (tp + fp) / CAST(tp + fp + tn + fn AS DOUBLE) AS alert_rate,
    CAST(fp + 25 * fn AS DOUBLE) AS business_cost,
    (fp + 25 * fn) / CAST(tp + fp + tn + fn AS DOUBLE) AS cost_per_record
  FROM outcomes)"""


def _table(spark, sf_dir):
    return H.configured_table(scored(spark, sf_dir), CFG, _LABEL, _SCORE)


@query(
    "threshold_table",
    f"""WITH {_TABLE_SQL}
    SELECT split, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, round(fbeta, 6) AS fbeta, tp, fp, tn, fn, alerts,
      round(alert_rate, 6) AS alert_rate, business_cost,
      round(cost_per_record, 6) AS cost_per_record FROM cost_table""",
)
def _(spark, sf_dir):
    return rounded(_table(spark, sf_dir), [*_RATIOS, "alert_rate", "cost_per_record"])


@query(
    "threshold_grid",
    f"""WITH {GRID_SQL} SELECT threshold, CAST(sum(tp + fp) AS BIGINT) AS alerts
    FROM outcomes GROUP BY threshold""",
)
def _(spark, sf_dir):
    return _table(spark, sf_dir).groupBy("threshold").agg(F.sum("alerts").alias("alerts"))


@query(
    "business_cost",
    f"""WITH {_TABLE_SQL} SELECT split, business_cost FROM cost_table WHERE threshold = 0.12""",
)
def _(spark, sf_dir):
    counts = M.confusion_counts(scored(spark, sf_dir), ["split"], _LABEL, _SCORE, 0.12)
    cost = H.business_cost(CFG.false_positive_cost, CFG.false_negative_cost)
    return counts.select("split", cost.alias("business_cost"))


@query(
    "lowest_cost_threshold",
    f"""WITH {_TABLE_SQL} SELECT threshold, business_cost, tp, fp, tn, fn FROM cost_table
    WHERE split = 'validation' ORDER BY business_cost, fn, fp, threshold DESC LIMIT 1""",
)
def _(spark, sf_dir):
    row = H.lowest_cost_row(_table(spark, sf_dir))
    return row.select("threshold", "business_cost", "tp", "fp", "tn", "fn")


_CANDIDATES_SQL = f"""{SCORED_SQL},
candidates AS (
  SELECT DISTINCT unnest(quantile_cont(score, [{', '.join(f'{i / 100}' for i in range(1, 100))}]))
    AS threshold
  FROM scored WHERE split = 'validation')"""


def _validation(spark, sf_dir):
    return scored(spark, sf_dir).filter("split = 'validation'")


@query(
    "candidate_thresholds",
    f"WITH {_CANDIDATES_SQL} SELECT round(threshold, 6) AS threshold FROM candidates",
)
def _(spark, sf_dir):
    found = H.candidate_thresholds(_validation(spark, sf_dir), _SCORE, CFG.limits)
    # At most 99 numbers, found by distributed order statistics.
    return rounded(spark.createDataFrame([(t,) for t in found], "threshold double"), ["threshold"])


@query(
    "best_fbeta_threshold",
    f"""WITH {_CANDIDATES_SQL},
    outcomes AS (SELECT threshold,
      count(*) FILTER (WHERE score >= threshold AND is_fraud = 1) AS tp,
      count(*) FILTER (WHERE score >= threshold AND is_fraud = 0) AS fp,
      count(*) FILTER (WHERE score < threshold AND is_fraud = 1) AS fn
      FROM scored, candidates WHERE split = 'validation' GROUP BY threshold),
    r AS (SELECT threshold, {RATIOS_SQL} FROM outcomes)
    SELECT round(threshold, 6) AS threshold, round(fbeta, 6) AS fbeta,
      round(precision, 6) AS precision, round(recall, 6) AS recall
    FROM r WHERE precision >= 0.05 ORDER BY r.fbeta DESC, r.threshold LIMIT 1""",
)
def _(spark, sf_dir):
    validation = _validation(spark, sf_dir)
    table = H.threshold_table(
        validation,
        H.candidate_thresholds(validation, _SCORE, CFG.limits),
        _LABEL,
        _SCORE,
        CFG.beta,
        CFG.false_positive_cost,
        CFG.false_negative_cost,
        keys=(),
    )
    names = ["threshold", "fbeta", "precision", "recall"]
    return rounded(H.best_fbeta_row(table, CFG.min_precision).select(*names), names)
