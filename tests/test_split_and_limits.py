from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import DAY, column, days
from riskloom.config import RiskConfig, ScaleLimits
from riskloom.operators.limits import earliest_rows, first_rows, riskiest_rows
from riskloom.operators.split import split_bounds, split_summary, temporal_split
from riskloom.roles import SOURCE_POS

CFG = RiskConfig(validation_size=0.2, test_size=0.2)
SMALL = ScaleLimits(histogram_cells=8)


def dated(spark, times):
    rows = [(t, i % 2, float(i)) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "date timestamp, is_fraud int, amount double")


def ordered(df):
    r = {s["split"]: s for s in split_summary(df, "date", "is_fraud").collect()}
    return (
        r["train"]["end"] < r["validation"]["start"]
        and r["validation"]["end"] < r["test"]["start"]
    )


@pytest.mark.parametrize("limits", [ScaleLimits(), SMALL])
def test_parts_are_in_order(spark, limits):
    parts = temporal_split(dated(spark, days(20)), CFG.with_(limits=limits))
    assert ordered(parts)
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts == {"train": 12, "validation": 4, "test": 4}


def test_equal_times_stay_together(spark):
    times = days(18)
    times[12] = times[11]
    parts = temporal_split(dated(spark, times), CFG)
    assert ordered(parts)
    at = parts.filter(F.col("date") == F.lit(times[11])).select("split").distinct()
    assert at.count() == 1


def test_missing_times_are_dropped_and_small_tables_refused(spark):
    parts = temporal_split(dated(spark, [*days(20), None, None]), CFG)
    assert parts.count() == 20
    with pytest.raises(ValueError, match="too few"):
        temporal_split(dated(spark, days(9)), CFG)
    with pytest.raises(ValueError, match="no row has a time"):
        temporal_split(dated(spark, [None] * 12), CFG)


def test_an_empty_part_is_an_error(spark):
    with pytest.raises(ValueError, match="empty"):
        temporal_split(dated(spark, [DAY] * 12), CFG)


def test_boundary_of_sub_microsecond_dense_times(spark):
    times = [DAY + timedelta(microseconds=i) for i in range(500)]
    bounds = split_bounds(dated(spark, times), CFG.with_(limits=SMALL))
    assert bounds.as_datetime(bounds.validation_micros).replace(tzinfo=None) == times[300]
    assert bounds.as_datetime(bounds.test_micros).replace(tzinfo=None) == times[400]


def test_limit_keeps_source_order(spark):
    df = spark.createDataFrame([(i, i) for i in range(10)], f"id int, {SOURCE_POS} bigint")
    assert column(first_rows(df, 4, SMALL), "id", "id") == [0, 1, 2, 3]
    assert first_rows(df, None, SMALL).count() == 10
    assert first_rows(df, 99, SMALL).count() == 10
    with pytest.raises(ValueError):
        first_rows(df, 0, SMALL)


@pytest.mark.parametrize("count", [3, 5, 13, 22, 24, 30])
@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(histogram_cells=2)])
def test_earliest_rows(spark, count, limits):
    times = [DAY + timedelta(days=i // 6) for i in range(22)] + [None] * 3
    df = spark.createDataFrame(list(zip(times, range(25))), "t timestamp, k bigint")
    got = sorted(r["k"] for r in earliest_rows(df, count, "t", "k", limits).collect())
    assert got == list(range(min(count, 25)))


def test_limit_is_exact_where_positions_repeat(spark):
    df = spark.createDataFrame([(i, i // 4) for i in range(20)] + [(99, None)], f"id int, {SOURCE_POS} bigint")
    for count in (1, 4, 6, 11, 20, 21):
        got = [r[SOURCE_POS] for r in first_rows(df, count, SMALL).collect()]
        assert sorted(got, key=lambda x: (x is None, x or 0)) == ([i // 4 for i in range(20)] + [None])[:count]


@pytest.mark.parametrize("tie", ["text", "repeated", "number"])
@pytest.mark.parametrize("count", [1, 3, 20, 27, 33, 40])
def test_earliest_rows_are_the_same_on_both_sides_of_the_switch(spark, tie, count):
    texts = ["b", "", "ab", "abcdefgh", "abcdefgi", "é", None, "abcdefg", "b\0", "zz"]
    rows = [(DAY + timedelta(days=i // 20) if i < 36 else None, texts[i % 10], i % 3, (i * 7 % 10) / 4 - 1) for i in range(40)]
    df = spark.createDataFrame(rows, "t timestamp, text string, repeated int, number double")
    few, many = (
        sorted(((r["t"], r[tie]) for r in earliest_rows(df, count, "t", tie, limits).collect()), key=repr)
        for limits in (ScaleLimits(), ScaleLimits(histogram_cells=0 if count < 2 else 1))
    )
    assert few == many and len(few) == count


def test_riskiest_rows(spark):
    df = spark.createDataFrame([(0.5, 1), (0.9, 2), (0.5, 0)], "s double, k int")
    assert [r["k"] for r in riskiest_rows(df, 2, "s", "k").collect()] == [2, 0]
