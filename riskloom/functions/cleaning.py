"""Cleaning expressions for single columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Label texts that mean "positive", and texts that mean "missing".
POSITIVE_LABELS = ("1", "true", "yes", "y", "fraud", "fraudulent")
NULL_TEXTS = ("", "nan", "None")
# Date layouts tried after the ISO forms, in this order.
DATE_LAYOUTS = (
    "MM/yyyy",
    "MM/dd/yyyy",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "yyyy/MM/dd",
    "yyyy/MM/dd HH:mm:ss",
)


def label_flag(label: Column) -> Column:
    """0/1 flag from a label of any type; missing counts as 0."""
    text = F.lower(F.trim(label.cast("string")))
    return F.coalesce(text.isin(*POSITIVE_LABELS), F.lit(False)).cast("int")


def null_texts(text: Column) -> Column:
    """Empty text and the spelled-out missing values become NULL."""
    return F.when(~text.isin(*NULL_TEXTS), text)


def without_nan(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def parse_money(amount: Column, data_type: T.DataType) -> Column:
    """Amount as double. Text keeps digits, dot and minus; rubbish becomes NULL."""
    if isinstance(data_type, T.StringType):
        return F.regexp_replace(amount, r"[^0-9.\-]", "").try_cast("double")
    return without_nan(amount.cast("double"))


def parse_time(value: Column, data_type: T.DataType) -> Column:
    """Timestamp from text in mixed layouts, dates or epoch nanoseconds."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(
            F.try_to_timestamp(value),
            *[F.try_to_timestamp(value, F.lit(layout)) for layout in DATE_LAYOUTS],
        )
    if isinstance(data_type, T.NumericType):
        return F.timestamp_micros(F.floor(value / F.lit(1000)).try_cast("bigint"))
    return value.cast("timestamp")
