"""Ranking and decision metrics from one table of distinct scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import ScaleLimits
from riskloom.functions.features import confusion_ratios, decision
from riskloom.operators.ordering import running_sums
from riskloom.session import pin


def score_counts(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    positive = F.col(label).cast("bigint")
    return df.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.sum(positive).alias("positives"), F.sum(1 - positive).alias("negatives")
    )


def ranked_scores(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    score: str,
    limits: ScaleLimits,
) -> DataFrame:
    """Distinct scores with the counts at and above each: ``tp`` and ``fp``.

    The scored rows are read once; everything after that is on the stored counts.
    """
    counts = pin(score_counts(df, keys, label, score))
    sums = running_sums(
        counts, keys, "score", ("positives", "negatives"), limits, descending=True
    )
    return sums.withColumns(
        {
            "tp": F.col("positives_before") + F.col("positives"),
            "fp": F.col("negatives_before") + F.col("negatives"),
        }
    )


def _area_columns() -> dict[str, Column]:
    positives, negatives = F.sum("positives"), F.sum("negatives")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    ranked_above = F.col("positives_before") + 0.5 * F.col("positives")
    return {
        # Step-wise sum over distinct scores; 0 if nothing is positive.
        "pr_auc": F.coalesce(
            F.sum(F.col("positives") * precision) / F.nullif(positives, F.lit(0)), F.lit(0.0)
        ),
        # Ties count half; undefined with one class.
        "roc_auc": F.sum(F.col("negatives") * ranked_above)
        / F.nullif(positives * negatives, F.lit(0)),
    }


def ranking_areas(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average precision and ROC area per key."""
    return ranked.groupBy(*keys).agg(*[c.alias(n) for n, c in _area_columns().items()])


def confusion_counts(
    df: DataFrame, keys: Sequence[str], label: str, score: str, threshold
) -> DataFrame:
    """tp, fp, tn, fn of the decision ``score >= threshold``."""
    hit = decision(F.col(score), threshold) == 1
    real = F.col(label).cast("int") == 1
    return df.groupBy(*keys).agg(
        F.count_if(hit & real).alias("tp"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & ~real).alias("tn"),
        F.count_if(~hit & real).alias("fn"),
    )


def with_ratios(counts: DataFrame, beta: float) -> DataFrame:
    return counts.withColumns(confusion_ratios(beta))


def evaluate(
    df: DataFrame,
    label: str,
    score: str,
    threshold: float | str,
    beta: float,
    limits: ScaleLimits,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All metrics per key from the ranked scores, in one aggregation.

    ``threshold`` is a number, or the key column that holds it.
    """
    ranked = ranked_scores(df, keys, label, score, limits)
    own = isinstance(threshold, str)
    at = F.col(threshold).cast("double") if own else F.lit(float(threshold))
    hit = decision(F.col("score"), at) == 1

    def total(condition: Column, count: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(count))), F.lit(0))

    totals = ranked.groupBy(*keys).agg(
        total(hit, "positives").alias("tp"),
        total(hit, "negatives").alias("fp"),
        total(~hit, "negatives").alias("tn"),
        total(~hit, "positives").alias("fn"),
        *[c.alias(n) for n, c in _area_columns().items()],
    )
    return with_ratios(totals.withColumn("threshold", at), beta).select(
        *[k for k in keys if k != "threshold"],
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
    )


def precision_recall_curve(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One point per distinct score, and the closing point (precision 1, recall 0)."""
    totals = _totals(ranked, keys)
    points = _beside(ranked, totals, keys).select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.coalesce(F.col("tp") / F.nullif(F.col("_pos"), F.lit(0)), F.lit(1.0)).alias("recall"),
    )
    end = totals.select(
        *[F.col(f"_k_{k}").alias(k) for k in keys],
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def roc_curve(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One point per distinct score, and the origin."""
    totals = _totals(ranked, keys)
    points = _beside(ranked, totals, keys).select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("fp") / F.nullif(F.col("_neg"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("_pos"), F.lit(0))).alias("tpr"),
    )
    origin = totals.select(
        *[F.col(f"_k_{k}").alias(k) for k in keys],
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def _totals(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ranked.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.sum("positives").alias("_pos"), F.sum("negatives").alias("_neg")
    )


def _beside(ranked: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals next to every point; without keys they are two scalar subqueries."""
    if not keys:
        return ranked.withColumns({c: totals.select(c).scalar() for c in ("_pos", "_neg")})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return ranked.join(totals, same)
