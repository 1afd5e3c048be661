"""First-N selections with an explicit order: exactly N rows, whatever repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import ScaleLimits
from riskloom.operators.ordering import rank_values
from riskloom.roles import SOURCE_POS

#: UTF-8 bytes of a text that fit into one positive bigint.
TEXT_STEP = 7


def order_keys(df: DataFrame, column: str) -> list[Column]:
    """Bigint or double columns that order rows as ``column`` does, missing values first."""
    kind = dict(df.dtypes)[column]
    value = F.col(f"`{column}`")
    present = value.isNotNull().cast("bigint")
    if kind == "string":
        raw = value.cast("binary")
        longest = df.agg(F.max(F.octet_length(value))).first()[0] or 0
        steps = range(1, longest + 1, TEXT_STEP)
        padded = [F.rpad(F.hex(F.substring(raw, at, TEXT_STEP)), 2 * TEXT_STEP, "0") for at in steps]
        texts = [F.conv(x, 16, 10).cast("bigint") for x in padded]
        return [present, *texts, F.octet_length(value).cast("bigint")]
    if kind.startswith(("timestamp", "date")):
        return [present, F.unix_micros(value.cast("timestamp"))]
    if kind in ("double", "float") or kind.startswith("decimal"):
        return [present, value.cast("double")]
    return [present, value.cast("bigint")]


def take(df: DataFrame, count: int, keys: Sequence[Column], limits: ScaleLimits) -> DataFrame:
    """Exactly the first ``count`` rows by ``keys``; rows equal in all keys are interchangeable.

    The key of the last row is an order statistic, so the rows before it are taken by a
    plain filter; only the rows that share it go on to the next key.
    """
    if count <= 0:
        return df.limit(0)
    if not keys:
        return df.limit(count)
    first, *rest = keys
    known = first.isNotNull()
    ranked = rank_values(
        df.select(first.alias("_k")), ["_k"], lambda rows: [count - 1] if rows > count else [], limits
    )["_k"]
    if ranked.rows == count:
        return df.filter(known)
    if ranked.rows < count:
        missing = df.filter(first.isNull())
        return df.filter(known).unionByName(take(missing, count - ranked.rows, rest, limits)) if ranked.rows else take(df, count, rest, limits)
    last = F.lit(ranked.at[count - 1])
    before = df.filter(first < last)
    same = df.filter(first == last)
    return before.unionByName(take(same, count - before.count(), rest, limits))


def first_rows(
    df: DataFrame,
    count: int | None,
    limits: ScaleLimits,
    position: str = SOURCE_POS,
) -> DataFrame:
    """The first ``count`` rows in source order; ``None`` keeps all.

    No sort, and no task that sees all rows. Of rows that repeat the last position as many
    are kept as make up the count; rows without a position come last.
    """
    if count is None:
        return df
    if count <= 0:
        raise ValueError("count must be positive or None")
    return take(df, count, [F.col(f"`{position}`").cast("bigint")], limits)


def earliest_rows(
    df: DataFrame, count: int, time: str, tie: str, limits: ScaleLimits
) -> DataFrame:
    """The ``count`` earliest rows; missing times come last, equal times go by ``tie``.

    Few rows are a per-task top-k merged at the end. Many are taken by a filter up to the
    time of the last one, and among the rows of that time by their ``tie``, with the same
    result.
    """
    if count <= limits.histogram_cells:
        return df.orderBy(F.col(time).asc_nulls_last(), F.col(tie).asc_nulls_first()).limit(count)
    micros = F.unix_micros(F.col(f"`{time}`").cast("timestamp"))
    return take(df, count, [micros, *order_keys(df, tie)], limits)


def riskiest_rows(df: DataFrame, count: int, score: str, tie: str) -> DataFrame:
    """The ``count`` highest scores, a per-task top-k merged at the end."""
    return df.orderBy(F.col(score).desc(), F.col(tie)).limit(count)
