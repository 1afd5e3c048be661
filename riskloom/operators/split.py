"""Split by event time; equal times always land in one part."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import RiskConfig
from riskloom.operators.ordering import rank_values
from riskloom.roles import Roles

SPLITS = ("train", "validation", "test")
_MICROS = "_time_micros"


@dataclass(frozen=True)
class SplitBounds:
    """First event time of validation and of test, in epoch microseconds."""

    time_column: str
    rows: int
    validation_micros: int
    test_micros: int

    def split_column(self) -> Column:
        at = F.col(self.time_column).cast("timestamp")
        return (
            F.when(at < F.timestamp_micros(F.lit(self.validation_micros)), SPLITS[0])
            .when(at < F.timestamp_micros(F.lit(self.test_micros)), SPLITS[1])
            .when(at.isNotNull(), SPLITS[2])
        )

    @staticmethod
    def as_datetime(micros: int) -> datetime:
        return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def drop_missing_time(df: DataFrame, time: str) -> DataFrame:
    return df.filter(F.col(time).isNotNull())


def split_bounds(df: DataFrame, cfg: RiskConfig, time: str | None = None) -> SplitBounds:
    """Find the two boundaries as order statistics of the event time.

    Only the time column is read, in a few passes that shuffle histogram cells.
    """
    time = time or Roles.of(df.columns).time
    if time is None:
        raise ValueError("no time column to split by")

    def ranks(rows: int) -> list[int]:
        if rows < 10:
            raise ValueError(f"{rows} rows with a time are too few to split; 10 are needed")
        return [
            int(rows * (1 - cfg.test_size - cfg.validation_size)),
            int(rows * (1 - cfg.test_size)),
        ]

    micros = df.select(F.unix_micros(F.col(time).cast("timestamp")).alias(_MICROS))
    found = rank_values(micros, [_MICROS], ranks, cfg.limits)[_MICROS]
    if found.rows == 0:
        raise ValueError("no row has a time")
    first, second = (found.at[r] for r in ranks(found.rows))
    if first <= found.minimum or first >= second:
        raise ValueError("a part would be empty; change validation_size or test_size")
    return SplitBounds(time, found.rows, first, second)


def temporal_split(df: DataFrame, cfg: RiskConfig, time: str | None = None) -> DataFrame:
    """Add ``split``; rows without a time are dropped."""
    return split_at(df, split_bounds(df, cfg, time))


def split_at(df: DataFrame, bounds: SplitBounds) -> DataFrame:
    kept = drop_missing_time(df, bounds.time_column)
    return kept.withColumn("split", bounds.split_column())


def split_summary(df: DataFrame, time: str, target: str) -> DataFrame:
    """Rows, time range and positive rate per split."""
    return df.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min(time).alias("start"),
        F.max(time).alias("end"),
        F.avg(target).alias("positive_rate"),
    )
