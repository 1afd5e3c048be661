"""History features against a plain pandas computation, with and without hot groups."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.config import RiskConfig, ScaleLimits
from riskloom.models.stages import HistoryFeaturesModel
from riskloom.operators.history import (
    BEHAVIOUR_COLUMNS,
    LOOKBACK,
    FeatureHistory,
    all_features,
    behaviour_features,
    bucket_of,
    history_rows,
    row_features,
)
from riskloom.roles import SOURCE_POS, Roles

SCHEMA = f"{SOURCE_POS} bigint, card_id bigint, date timestamp, amount double"
ROLES = Roles(time="date", amount="amount", group="card_id", transaction_id=None)
HOT = ScaleLimits(hot_group_rows=25, max_slices=64)


def table(rng, rows, start="2024-01-01", first_pos=0, span_minutes=400, hot_time=True):
    """One missing card and one hot card; tied, missing and very frequent times."""
    cards = rng.choice([1, 1, 1, 2, 3, 4, None, None], rows)
    minutes = rng.integers(0, span_minutes, rows)
    if hot_time:
        minutes[rng.random(rows) < 0.35] = 77
    times = pd.Timestamp(start) + pd.to_timedelta(minutes, unit="min")
    amounts = np.round(rng.normal(50, 40, rows), 2)
    amounts[rng.random(rows) < 0.05] = 0.0
    frame = pd.DataFrame(
        {SOURCE_POS: np.arange(first_pos, first_pos + rows), "card_id": cards, "date": times, "amount": amounts}
    )
    frame.loc[rng.random(rows) < 0.1, "amount"] = np.nan
    return frame


def to_spark(spark, frame):
    rows = [
        tuple(None if pd.isna(v) else v for v in r)
        for r in frame.astype(object).itertuples(index=False)
    ]
    fixed = [
        (int(a), None if b is None else int(b), c and c.to_pydatetime(), d) for a, b, c, d in rows
    ]
    return spark.createDataFrame(fixed, SCHEMA)


def expected(current, history=None):
    """Row by row: look at the earlier rows of the same card."""
    now = current.assign(past=0)
    both = now if history is None else pd.concat([history.assign(past=1), now])
    both = both.sort_values(["date", "past", SOURCE_POS], na_position="last", kind="stable")
    out = {}
    for _, group in both.groupby(both["card_id"].astype(float).fillna(-1)):
        amounts = group["amount"].to_numpy(float)
        for i, (pos, past) in enumerate(zip(group[SOURCE_POS], group["past"])):
            if past:
                continue
            recent = amounts[max(0, i - 5) : i]
            known = recent[~np.isnan(recent)]
            mean = known.mean() if len(known) else np.nan
            std = known.std(ddof=1) if len(known) > 1 else np.nan
            previous = amounts[i - 1] if i else np.nan
            ratio = amounts[i] / mean if mean != 0 else np.nan
            out[pos] = (previous, mean, std, i, ratio)
    return out


def check(df, wanted):
    rows = df.select(SOURCE_POS, *BEHAVIOUR_COLUMNS).collect()
    assert len(rows) == len(wanted)
    got = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], float)
    want = np.array([wanted[r[0]] for r in rows], float)
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-6, equal_nan=True)


@pytest.mark.parametrize("limits", [ScaleLimits(), HOT], ids=["plain", "hot"])
@pytest.mark.parametrize("with_history", [False, True])
def test_features_equal_brute_force(spark, limits, with_history):
    rng = np.random.default_rng(7)
    current = table(rng, 400)
    current.loc[rng.random(400) < 0.05, "date"] = pd.NaT
    past = table(rng, 200, first_pos=1000) if with_history else None
    history = history_rows(to_spark(spark, past), ROLES) if with_history else None
    df = behaviour_features(to_spark(spark, current), ROLES, limits, history)
    assert set(df.columns) == set(current.columns) | set(BEHAVIOUR_COLUMNS)
    check(df, expected(current, past))


@pytest.mark.parametrize("limits", [ScaleLimits(), HOT], ids=["plain", "hot"])
def test_compact_history_gives_the_same_features(spark, limits):
    rng = np.random.default_rng(9)
    past = table(rng, 300)
    current = table(rng, 120, start="2024-02-01", first_pos=1000)
    history = FeatureHistory.of(to_spark(spark, past), ROLES)
    now = to_spark(spark, current)
    chosen = history.for_batch(now, ROLES, limits)
    # Five cards, the missing one included: the last rows and one stand-in each.
    assert chosen.count() <= 5 * (LOOKBACK + 1)
    check(behaviour_features(now, ROLES, limits, chosen), expected(current, past))
    # A batch of few cards needs the history of those cards alone.
    some = current[current["card_id"].isin([2]) | current["card_id"].isna()]
    few = to_spark(spark, some)
    used = history.for_batch(few, ROLES, limits)
    assert used.count() <= 2 * (LOOKBACK + 1)
    check(behaviour_features(few, ROLES, limits, used), expected(some, past))
    many = history.for_batch(few, ROLES, ScaleLimits(broadcast_rows=1))
    assert many.count() == history.compact.count()


@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(broadcast_rows=1)], ids=["few", "many"])
def test_only_cards_with_late_rows_use_their_whole_history(spark, limits):
    rng = np.random.default_rng(11)
    frame = table(rng, 200)
    past = to_spark(spark, frame)
    history = FeatureHistory.of(past, ROLES)
    current = table(rng, 80, start="2024-03-01", first_pos=500)
    late = (current["card_id"] == 3) | current["card_id"].isna()
    current.loc[late, "date"] = current.loc[late, "date"] - pd.Timedelta(days=60)
    used = history.for_batch(to_spark(spark, current), ROLES, limits)
    rows = {r["card_id"]: r["n"] for r in used.groupBy("card_id").agg(F.count("*").alias("n")).collect()}
    whole = frame.groupby(frame["card_id"].astype(float).fillna(-1)).size()
    assert rows[None] == whole[-1] and rows[3] == whole[3]
    assert all(n <= LOOKBACK + 1 for c, n in rows.items() if c not in (None, 3))
    check(behaviour_features(to_spark(spark, current), ROLES, limits, used), expected(current, frame))
    # A history row without time comes after every current row of its card.
    timeless = past.withColumn("date", F.when((F.col("card_id") != 1) | (F.col(SOURCE_POS) % 3 > 0), F.col("date")))
    frame.loc[(frame["card_id"].isna() | (frame["card_id"] == 1)) & (frame[SOURCE_POS] % 3 == 0), "date"] = pd.NaT
    unsure = FeatureHistory.of(timeless, ROLES)
    later = table(rng, 30, start="2025-01-01", first_pos=900)
    later.loc[:3, "date"] = pd.NaT
    check(behaviour_features(to_spark(spark, later), ROLES, limits, unsure.for_batch(to_spark(spark, later), ROLES, limits)), expected(later, frame))


def test_a_batch_reads_the_buckets_of_its_cards(spark, tmp_path):
    rng = np.random.default_rng(12)
    frame = table(rng, 400)
    frame["card_id"] = [None if pd.isna(c) else c if c == 1 else int(rng.integers(2, 60)) for c in frame["card_id"]]
    cfg = RiskConfig(limits=ScaleLimits(history_bucket_rows=25))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    HistoryFeaturesModel(cfg, ROLES, FeatureHistory.of(to_spark(spark, frame), ROLES)).write().save(str(tmp_path / "h"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    model = HistoryFeaturesModel.load(str(tmp_path / "h"))
    history = model.history
    assert history.buckets == 16
    # the hot card's bucket is written by several tasks
    number = spark.range(1).select(bucket_of(F.lit(1).cast("bigint"), 16)).first()[0]
    assert len(list((tmp_path / "h" / "history" / f"_bucket={number}").glob("*.parquet"))) >= 3

    def folders(df):
        """How many buckets each scan of the history reads."""
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet .*_bucket.*", plan)
        filters = [re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1) for scan in scans]
        return [len(re.findall(r"_bucket#\d+ = \d+", f)) or len(re.search(r"_bucket#\d+ IN \((.*?)\)", f).group(1).split(",")) for f in filters]

    one = table(rng, 4, start="2024-02-01", first_pos=1000)
    one["card_id"] = 7
    batch = to_spark(spark, one)
    used = history.for_batch(batch, ROLES, cfg.limits)
    assert folders(used) == [1]
    late = one.assign(date=one["date"] - pd.Timedelta(days=31))
    assert folders(history.for_batch(to_spark(spark, late), ROLES, cfg.limits)) == [1, 1]
    for frame_now in (one, late, table(rng, 90, first_pos=2000)):
        out = model.transform(to_spark(spark, frame_now))
        check(out, expected(frame_now, frame))
    # ids that arrive as text find the same bucket
    text = batch.withColumn("card_id", F.col("card_id").cast("string"))
    assert folders(history.for_batch(text, ROLES, cfg.limits)) == folders(used)


def test_hot_groups_are_cut_into_bounded_windows(spark):
    """No window partition of the hot path holds much more than the limit allows."""
    from riskloom.operators import history as H

    rng = np.random.default_rng(13)
    df = to_spark(spark, table(rng, 2000))
    limits = ScaleLimits(hot_group_rows=100, max_slices=256)
    events = df.withColumns({H._PAST: F.lit(0), H._STANDS_FOR: F.lit(1).cast("bigint")})
    hot = H._hot_groups(events, ROLES, limits)
    cut = H._with_slices(events, hot, ROLES, limits)
    largest = cut.groupBy("card_id", H._SLICE, H._TIE).count().agg(F.max("count")).first()[0]
    assert largest <= 2.5 * limits.hot_group_rows + H.LOOKBACK


def test_row_features_are_not_carried_through_the_look_back(spark):
    rng = np.random.default_rng(8)
    past, now = (to_spark(spark, table(rng, 60, first_pos=n)) for n in (0, 100))
    got = all_features(now, ROLES, ScaleLimits(), history_rows(past, ROLES))
    want = behaviour_features(row_features(now, ROLES), ROLES, ScaleLimits(), history_rows(past, ROLES))
    assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    below = got._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)[1]
    assert "amount_log1p" not in below and "amount_log1p" in got.columns
