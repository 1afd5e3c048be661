"""Descriptions of a table: label shares, time coverage, column quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows and share per label value, the missing one included."""
    counts = df.groupBy(target).agg(F.count("*").alias("count"))
    # The label has a handful of values, so the total is taken over a handful of rows.
    everything = Window.partitionBy()
    return counts.withColumn("rate", F.col("count") / F.sum("count").over(everything))


def time_coverage(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.min(time).alias("min"), F.max(time).alias("max"))


def monthly_volume(df: DataFrame, time: str, target: str) -> DataFrame:
    """Transactions and positive rate per calendar month; rows without time are left out."""
    month = F.date_trunc("month", F.col(time))
    return (
        df.filter(F.col(time).isNotNull())
        .groupBy(month.alias("month"))
        .agg(F.count("*").alias("transactions"), F.avg(target).alias("fraud_rate"))
    )


def column_quality(
    df: DataFrame, limit: int | None = 30, approximate: bool = False
) -> DataFrame:
    """Type, share of missing values (NULL and NaN) and distinct values per column, worst first.

    The exact distinct counts go through one (column, value) aggregation that is
    combined before the shuffle; ``approximate`` uses sketches instead.
    """
    columns = df.columns
    types = dict(df.dtypes)
    missing = df.agg(
        *[F.avg(_known(df, c).isNull().cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *(
            [F.approx_count_distinct(_known(df, c)).alias(f"d{i}") for i, c in enumerate(columns)]
            if approximate
            else []
        ),
    )
    described = missing.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(types[c]).alias("dtype"),
                        F.col(f"m{i}").alias("missing_rate"),
                        *([F.col(f"d{i}").alias("nunique")] if approximate else []),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        ).alias("q")
    ).select("q.*")
    if not approximate:
        values = df.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("_column"), _value_text(df, c).alias("_value"))
                        for c in columns
                    ]
                )
            ).alias("v")
        ).select("v.*")
        distinct = (
            values.filter(F.col("_value").isNotNull())
            .distinct()
            .groupBy("_column")
            .agg(F.count("*").alias("nunique"))
        )
        described = described.join(
            F.broadcast(distinct), F.col("column") == F.col("_column"), "left"
        ).select("column", "dtype", "missing_rate", F.coalesce("nunique", F.lit(0)).alias("nunique"))
    ordered = described.orderBy(F.col("missing_rate").desc(), F.col("column"))
    return ordered if limit is None else ordered.limit(limit)


def _known(df: DataFrame, column: str) -> Column:
    """The value, where it is one: NaN is as missing as NULL. Adding 0 makes both zeros one."""
    value = F.col(f"`{column}`")
    if dict(df.dtypes)[column] not in ("double", "float"):
        return value
    return F.when(~F.isnan(value), value + F.lit(0.0))


def _value_text(df: DataFrame, column: str) -> Column:
    return _known(df, column).cast("string")


def source_shapes(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per source."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_rates(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Share of missing values per created feature, highest first."""
    rates = df.agg(
        *[F.avg(_known(df, c).isNull().cast("double")).alias(f"m{i}") for i, c in enumerate(features)]
    )
    return (
        rates.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("missing_rate"))
                        for i, c in enumerate(features)
                    ]
                )
            ).alias("r")
        )
        .select("r.*")
        .orderBy(F.col("missing_rate").desc(), "feature")
    )
