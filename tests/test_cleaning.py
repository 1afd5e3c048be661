from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from riskloom.config import RiskConfig
from riskloom.functions import cleaning as X
from riskloom.operators.cleaning import clean, clean_values, first_per_key
from riskloom.roles import (
    SOURCE_POS,
    Roles,
    columns_to_drop,
    feature_groups,
    first_present,
    normalize_headers,
)

CFG = RiskConfig()


def test_money_and_labels_are_parsed(spark):
    df = spark.createDataFrame([("$1,234.50", "Yes"), ("$0.99", "No")], ["Amount", "is_fraud"])
    rows = clean_values(df, CFG).collect()
    assert [r["amount"] for r in rows] == [1234.5, 0.99]
    assert [r["is_fraud"] for r in rows] == [1, 0]


@pytest.mark.parametrize(
    "text, value",
    [("1-2", None), ("-", None), (".", None), ("(10)", 10.0), ("-$5.5", -5.5), ("", None), (None, None)],
)
def test_odd_money(spark, text, value):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(X.parse_money(F.col("a"), T.StringType())).first()[0] == value


def test_numbers_pass_and_nan_is_missing(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),)], "amount double")
    assert [r[0] for r in clean_values(df, CFG).collect()] == [1.5, None]


def test_missing_texts(spark):
    df = spark.createDataFrame([("",), ("nan",), ("None",), ("x",)], "city string")
    assert [r[0] for r in clean_values(df, CFG).collect()] == [None, None, None, "x"]


def test_dates_in_mixed_layouts(spark):
    texts = ["2020-01-02 03:04:05", "2020-01-02", "05/2021", "12/31/2020", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "expires string")
    assert [r[0] for r in clean_values(df, CFG).collect()] == [
        datetime(2020, 1, 2, 3, 4, 5),
        datetime(2020, 1, 2),
        datetime(2021, 5, 1),
        datetime(2020, 12, 31),
        None,
        None,
    ]


def test_numeric_dates_are_epoch_nanoseconds(spark):
    df = spark.createDataFrame([(86_400_000_000_000,)], "date bigint")
    assert clean_values(df, CFG).first()[0] == datetime(1970, 1, 2)


def test_first_of_repeated_ids_stays(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), (None, 5, "x"), (None, 2, "y"), ("b", 4, "only")]
    df = spark.createDataFrame(rows, f"transaction_id string, {SOURCE_POS} bigint, v string")
    kept = {r["transaction_id"]: r["v"] for r in clean(df, CFG).collect()}
    assert kept == {"a": "first", None: "y", "b": "only"}


def test_dedupe_filters_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id") % 3, F.col("id").alias("p")).toDF("k", "p")
    plan = first_per_key(df, "k", ["p"])._jdf.queryExecution().executedPlan().toString()
    # One rank filter on each side of the exchange.
    assert plan.count("WindowGroupLimit") == 2


def test_cleaning_twice_changes_nothing(spark):
    rows = [("1", "$2.00", "2020-01-01", "Yes"), ("2", "x", "bad", None)]
    df = spark.createDataFrame(rows, "id string, amount string, date string, is_fraud string")
    once = clean(df, CFG)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, clean(once, CFG).collect()))


def test_header_normalization(spark):
    df = spark.createDataFrame([(1, 2)], [" Card-ID ", "Use Chip"])
    assert normalize_headers(df).columns == ["card_id", "use_chip"]
    with pytest.raises(ValueError):
        normalize_headers(spark.createDataFrame([(1, 2)], ["A b", "a-b"]))


def test_roles_take_the_first_candidate():
    roles = Roles.of(["time", "date", "amt", "client_id", "id"])
    assert roles == Roles("date", "amt", "client_id", "id")
    assert Roles.of(["card_id", "client_id"]).group == "card_id"
    assert first_present(["x"], ["y"]) is None


def test_identifiers_are_not_inputs(spark):
    schema = "transaction_id string, card_id bigint, merchant_id bigint, amount double, merchant_state string"
    df = spark.createDataFrame([("1", 10, 99, 10.0, "SP")], schema)
    assert columns_to_drop(df.columns, CFG) == ["card_id", "merchant_id", "transaction_id"]
    groups = feature_groups(df.schema, CFG)
    assert groups.sizes() == {"numeric": 1, "categorical": 1, "drop": 3}


def test_strict_mode_drops_snapshots_and_secrets():
    names = ["amount", "address", "cvv", "card_on_dark_web", "credit_score", "errors", "client_id_card"]
    assert columns_to_drop(names, CFG) == sorted(names[1:])
    loose = columns_to_drop(names, CFG.with_(strict_leakage=False))
    assert loose == ["address", "client_id_card", "cvv"]


def test_a_plain_time_column_is_no_input():
    assert columns_to_drop(["time", "amount"], CFG) == ["time"]


@pytest.mark.parametrize(
    "change", [{"threshold_strategy": "x"}, {"false_positive_cost": -1.0}, {"max_rows": -5}]
)
def test_bad_settings(change):
    with pytest.raises(ValueError):
        RiskConfig(**change)


def test_settings_round_trip():
    assert RiskConfig.from_json(CFG.to_json()) == CFG
    assert RiskConfig(max_rows=0).max_rows is None
