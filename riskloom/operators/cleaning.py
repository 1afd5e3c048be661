"""Cleaning of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.config import RiskConfig
from riskloom.functions import cleaning as X
from riskloom.roles import (
    MATCH_POS,
    PARSED_DATE_MARKS,
    RESERVED,
    SOURCE_POS,
    Roles,
    first_present,
    normalize_headers,
)
from riskloom import config as C


def clean_values(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Normalize headers, missing values, money, dates and the label, row by row."""
    named = normalize_headers(df)
    amount = Roles.of(named.columns).amount
    replaced: dict[str, Column] = {}
    for field in named.schema.fields:
        name, kind = field.name, field.dataType
        if name in RESERVED:
            continue
        value = F.col(name)
        if isinstance(kind, T.StringType):
            value = X.null_texts(value)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = X.without_nan(value)
        if name == amount:
            value = X.parse_money(value, kind)
        elif name == cfg.target:
            value = X.label_flag(value)
        elif any(mark in name for mark in PARSED_DATE_MARKS):
            value = X.parse_time(value, kind)
        elif not isinstance(kind, (T.StringType, T.DoubleType, T.FloatType)):
            continue
        replaced[name] = value
    return named.withColumns(replaced) if replaced else named


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in the given order; missing keys form one group.

    The rank filter is applied before the shuffle as well, so a frequent key
    sends at most one row per task.
    """
    window = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (
        df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")
    )


def with_row_position(df: DataFrame) -> DataFrame:
    """Add the source position where the reader did not."""
    if SOURCE_POS in df.columns:
        return df
    return df.withColumn(SOURCE_POS, F.monotonically_increasing_id())


def clean(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """``clean_values``, then one row per transaction id: the first in source order."""
    cleaned = clean_values(with_row_position(df), cfg)
    key = first_present(cleaned.columns, C.CLEAN_ID_NAMES)
    if key is None:
        return cleaned.drop(MATCH_POS)
    order = [SOURCE_POS] + ([MATCH_POS] if MATCH_POS in cleaned.columns else [])
    return first_per_key(cleaned, key, order).drop(MATCH_POS)
