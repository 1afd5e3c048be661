import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import ScaleLimits
from riskloom.operators.ordering import (
    cut_slices,
    exact_quantiles,
    rank_values,
    running_sums,
    slice_edges,
)

# Limits this small force every refinement step and slice on tiny data.
TINY = ScaleLimits(histogram_cells=32, rows_per_run=40)


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(3)
    common = [0.0] * 400
    spread = [rng.random() * 10 ** rng.randint(-6, 9) for _ in range(500)]
    return common + spread + [-5.5, -5.5, 1e15]


@pytest.mark.parametrize("limits", [TINY, ScaleLimits()])
def test_ranks_equal_sorting(spark, numbers, limits):
    df = spark.createDataFrame([(v,) for v in numbers] + [(None,)], "v double")
    ranks = [0, 1, 2, 399, 400, 401, 650, 901, 902]
    got = rank_values(df, ["v"], lambda n: ranks, limits)["v"]
    ordered = sorted(numbers)
    assert got.rows == len(numbers)
    assert got.at == {r: ordered[r] for r in ranks}


def test_ranks_of_bigints_that_share_a_double(spark):
    base = 2**60
    values = [base + i for i in range(300)] + [5]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = rank_values(df, ["v"], lambda n: [0, 1, 150, 300], TINY)["v"]
    ordered = sorted(values)
    assert got.at == {r: ordered[r] for r in (0, 1, 150, 300)}


def test_quantiles_of_several_columns(spark, numbers):
    rows = [(v, float(i % 7) if i % 3 else None, None) for i, v in enumerate(numbers)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = [0.01, 0.25, 0.5, 0.99]
    got = exact_quantiles(df, ["a", "b", "c"], probs, TINY)
    np.testing.assert_allclose(got["a"], np.quantile(numbers, probs))
    np.testing.assert_allclose(got["b"], np.quantile([r[1] for r in rows if r[1] is not None], probs))
    assert got["c"] is None


def test_values_without_cuts_are_one_slice(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    edges, heavy = slice_edges(df, "v", 1)
    assert heavy == []
    assert [r["s"] for r in cut_slices(df, "v", edges, "s").collect()] == [0, 0, 1]


def test_a_very_frequent_value_is_a_slice_of_its_own(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)] + [(7.0,)] * 100, "v double")
    edges, heavy = slice_edges(df, "v", 10)
    assert heavy == [7.0]
    sliced = cut_slices(df, "v", edges, "s")
    same = sliced.filter("v = 7").select("s").distinct().first()[0]
    assert sliced.filter((F.col("s") == same) & (F.col("v") != 7)).isEmpty()


@pytest.mark.parametrize("descending", [False, True])
def test_sliced_running_sums_equal_one_window(spark, descending):
    rng = random.Random(5)
    values = rng.sample(range(10_000), 300)
    rows = [("x" if i % 3 else None, float(v), i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, s double, m bigint")
    got = running_sums(df, ["k"], "s", ["m"], TINY, descending)
    seen = {(r["k"], r["s"]): r["m_before"] for r in got.collect()}
    assert len(seen) == len(rows)
    for key, score, _ in rows:
        before = sum(
            m for k, s, m in rows if k == key and (s > score if descending else s < score)
        )
        assert seen[key, score] == before
