import pytest

from riskloom.config import RiskConfig, ScaleLimits
from riskloom.operators.cleaning import clean
from riskloom.operators.enrich import code_frame, enrich, first_labelled, labels_frame, left_join_dimension, supervised_table
from riskloom.roles import SOURCE_POS
from riskloom.session import pin

CFG = RiskConfig()


@pytest.fixture(scope="module")
def raw(spark):
    tx = [(1, "2020-01-01", 10, 100, "$10.00", 5812), (2, "2020-01-02", 10, 100, "$20.00", 5411)]
    return {
        "transactions": spark.createDataFrame(
            tx, "id bigint, date string, card_id bigint, client_id bigint, amount string, mcc int"
        ),
        "cards": spark.createDataFrame([(10, 100, "Debit")], "id bigint, client_id bigint, card_type string"),
        "users": spark.createDataFrame([(100, 45)], "id bigint, current_age int"),
        "labels": spark.createDataFrame(
            [({"1": "No", "2": "Yes"},)], "target map<string,string>"
        ),
        "codes": spark.createDataFrame(
            [({"5812": "Restaurants", "5411": "Grocery"},)], "m map<string,string>"
        ),
    }


def test_merge_adds_labels_dimensions_and_codes(spark, raw):
    wide = supervised_table(
        raw["transactions"], raw["labels"], CFG, raw["cards"], raw["users"], raw["codes"]
    )
    rows = {r["transaction_id"]: r.asDict() for r in wide.collect()}
    assert {k: r["is_fraud"] for k, r in rows.items()} == {"1": 0, "2": 1}
    assert rows["1"]["mcc"] == "5812" and rows["1"]["mcc_description"] == "Restaurants"
    assert rows["2"]["card_type"] == "Debit" and rows["2"]["current_age"] == 45
    assert rows["2"]["client_id"] == 100 and rows["2"]["client_id_card"] == 100


def test_unlabelled_transactions_vanish_and_optional_tables_may_be_absent(spark, raw):
    labels = spark.createDataFrame([("2", "fraud")], "transaction_id string, is_fraud string")
    wide = supervised_table(raw["transactions"], labels, CFG, None, spark.createDataFrame([], "id int"))
    assert [(r["transaction_id"], r["is_fraud"]) for r in wide.collect()] == [("2", 1)]


def test_label_shapes(spark):
    flat = spark.createDataFrame([({"7": "Yes"},)], "anything map<string,string>")
    records = spark.createDataFrame([([("7", "1")],)], "r array<struct<ID: string, fraud: string>>")
    unnamed = spark.createDataFrame([("7", "x", "true")], "a string, b string, c string")
    for labels in (flat, records, unnamed):
        assert [tuple(r) for r in labels_frame(labels, CFG).collect()] == [("7", 1)]


def test_code_shapes_and_distinct(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "Code int, Description string")
    assert sorted(map(tuple, code_frame(rows).collect())) == [("1", "a"), ("2", "b")]
    with pytest.raises(ValueError):
        code_frame(spark.createDataFrame([(1,)], "other int"))


@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(broadcast_rows=1)])
def test_missing_keys_match_and_repeated_keys_fan_out(spark, limits):
    tx = spark.createDataFrame([(1, 5), (2, None)], "t int, card_id int")
    cards = spark.createDataFrame([(5, "x"), (5, "y"), (None, "n")], "id int, kind string")
    got = left_join_dimension(tx, cards, ("id",), ("card_id",), "_card", limits)
    assert sorted((r["t"], r["kind"]) for r in got.collect()) == [(1, "x"), (1, "y"), (2, "n")]


def test_first_match_survives_cleaning(spark, raw):
    cards = spark.createDataFrame(
        [(10, "second", 2), (10, "first", 1)], f"id bigint, kind string, {SOURCE_POS} bigint"
    )
    wide = supervised_table(raw["transactions"], raw["labels"], CFG, cards)
    assert wide.count() == 4
    assert [r["kind"] for r in clean(wide, CFG).collect()] == ["first", "first"]


def wide_case(spark, rows=400):
    tx = [(str(i), i % 7 if i % 11 else None, i % 5, f"note {i}", f"place {i % 3}", i) for i in range(rows)]
    tx = spark.createDataFrame(tx, f"transaction_id string, card_id bigint, client_id int, note string, place string, {SOURCE_POS} bigint")
    cards = spark.createDataFrame([(k, k * 3, f"kind {k} {n}", n) for k in range(6) for n in (2, 1)] + [(None, 1, "none", 1)], f"id bigint, client_id bigint, kind string, {SOURCE_POS} bigint")
    users = spark.createDataFrame([(str(k), 30 + k, "card") for k in range(4)], "id string, age int, kind string")
    return tx, cards, users


@pytest.mark.parametrize("rows", [0, 5, 100])
def test_keys_first_gives_the_same_rows(spark, rows):
    """Neither, one or both dimensions beyond the broadcast bound."""
    tx, cards, users = wide_case(spark)
    plain = enrich(tx, CFG, cards, users, first_match=True)
    keyed = enrich(tx, CFG.with_(limits=ScaleLimits(broadcast_rows=rows)), cards, users, first_match=True, row_key="transaction_id")
    assert plain.columns == keyed.columns == [*tx.columns, "client_id_card", "kind", "age", "kind_user", "_match_pos"]
    assert sorted(map(str, plain.collect())) == sorted(map(str, keyed.collect()))


def test_wide_rows_are_shuffled_once(spark):
    tx, cards, users = wide_case(spark)
    cfg = CFG.with_(limits=ScaleLimits(broadcast_rows=0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        labels = spark.createDataFrame([(str(i), i % 2) for i in range(400)], "transaction_id string, is_fraud int")
        labelled = first_labelled(pin(tx), labels, cfg)
        counts = [
            wide_exchanges(enrich(labelled, cfg, pin(cards), pin(users), first_match=True, row_key=key)) for key in (None, "transaction_id")
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert counts == [3, 1]


def wide_exchanges(df):
    """Shuffles above a scan of the wide columns, which a plan tree shows by indentation."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.initialPlan())
            continue
        found += node.nodeName() == "Exchange" and "note#" in node.output().toString()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found
