"""Row-wise feature expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def calendar_features(time: Column) -> dict[str, Column]:
    """Calendar fields of the event time; the flags are 0 where it is missing."""
    weekday = F.weekday(time)
    hour = F.hour(time)
    return {
        "transaction_hour": hour,
        "transaction_dayofweek": weekday,
        "transaction_month": F.month(time),
        "is_weekend": _flag(weekday >= 5),
        "is_night": _flag(hour.between(0, 5)),
    }


def amount_features(amount: Column) -> dict[str, Column]:
    size = F.abs(amount)
    return {"amount_abs": size, "amount_log1p": F.log1p(size)}


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0 where the denominator is 0."""
    return F.coalesce(numerator / F.nullif(denominator, F.lit(0).cast("double")), F.lit(0.0))


def decision(score: Column, threshold) -> Column:
    """1 where the score reaches the threshold (inclusive)."""
    at = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce((score >= at) & ~F.isnan(score), F.lit(False)).cast("int")


def confusion_ratios(beta: float) -> dict[str, Column]:
    """Precision, recall, F1 and F-beta from columns tp, fp, fn."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    b2 = float(beta) ** 2
    return {
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        "fbeta": safe_ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp),
    }
