"""Train on raw files, record the run, promote it, score batch, records and stream."""

import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import types as T

from helpers import DAY
from riskloom.config import RiskConfig
from riskloom.operators.cleaning import clean
from riskloom.operators.enrich import supervised_table
from riskloom.operators.split import temporal_split
from riskloom.plans import training
from riskloom.plans.scoring import PREDICTION_COLUMNS, ScoringService
from riskloom.plans.store import RunStore
from riskloom.roles import SOURCE_POS
from riskloom.sources.files import load_all
from riskloom.streaming.scoring import record_stream, scored_records, start_scoring

CFG = RiskConfig()
ROWS = 400


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(1)
    lines, labels = ["id,date,client_id,card_id,amount,mcc,merchant_city,errors"], {}
    for i in range(ROWS):
        amount = round(rng.expovariate(1 / 60), 2)
        stamp = (DAY + timedelta(minutes=37 * i)).strftime("%Y-%m-%d %H:%M:%S")
        city = rng.choice(["Austin", "Lima", f"Town {i}"])
        lines.append(f"{i},{stamp},{i % 9},{i % 13},${amount},{rng.choice([5411, 5812])},{city},")
        if i % 50:
            labels[str(i)] = "Yes" if amount + rng.gauss(0, 20) > 100 else "No"
    (folder / "transactions_data.csv").write_text("\n".join(lines) + "\n")
    cards = ["id,client_id,card_brand,credit_limit"] + [f"{c},{c % 9},{'Visa' if c % 2 else 'Amex'},$5000" for c in range(13)]
    (folder / "cards_data.csv").write_text("\n".join(cards) + "\n")
    (folder / "users_data.csv").write_text("id,gender\n" + "".join(f"{u},F\n" for u in range(9)))
    (folder / "mcc_codes.json").write_text(json.dumps({"5411": "Grocery", "5812": "Restaurants"}))
    (folder / "train_fraud_labels.json").write_text(json.dumps({"target": labels}))
    return load_all(spark, str(folder)), str(folder), labels


@pytest.fixture(scope="module")
def finished(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("work"))
    return root, training.run(spark, raw[0], root, CFG, promote=True)


def test_splits_hold_the_labelled_rows(raw):
    splits = training.supervised_splits(raw[0], CFG)
    rows = {r["transaction_id"]: r for r in splits.collect()}
    assert set(rows) == set(raw[2])
    assert {"card_brand", "client_id_card", "gender", "mcc_description"} <= set(splits.columns)
    last = {s: max(r["date"] for r in rows.values() if r["split"] == s) for s in ("train", "validation")}
    first = {s: min(r["date"] for r in rows.values() if r["split"] == s) for s in ("validation", "test")}
    assert last["train"] < first["validation"] and last["validation"] < first["test"]


def test_a_bound_on_training_rows_leaves_the_other_parts_whole(raw):
    whole = training.supervised_splits(raw[0], CFG)
    bounded = CFG.with_(max_rows=50)
    splits = training.supervised_splits(raw[0], bounded)
    count = lambda df: {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert count(splits) == count(whole) and whole.count() == len(raw[2])
    rows = training.fit_rows(splits, bounded)
    assert rows.count() == 50 and training.fit_rows(splits, CFG).count() == count(whole)["train"]
    latest = rows.agg({SOURCE_POS: "max"}).first()[0]
    assert splits.filter(f"split = 'train' and {SOURCE_POS} <= {latest}").count() == 50


def test_one_wide_shuffle_equals_join_then_clean(spark):
    """Repeated and missing-like ids, repeated labels and repeated card keys."""
    rng = random.Random(4)
    ids = [rng.choice(["", "nan", "None", None, *map(str, range(40))]) for _ in range(150)]
    rows = [
        (t, i, str(DAY + timedelta(hours=rng.randrange(900))), rng.choice([1, 2, 3, None]), f"${i}")
        for i, t in enumerate(ids)
    ]
    tx = spark.createDataFrame(
        rows, f"id string, {SOURCE_POS} bigint, date string, card_id bigint, amount string"
    )
    names = ["", "nan", "None", *map(str, range(30)), "5", "6"]
    labels = spark.createDataFrame(
        [(n, rng.choice(["Yes", "No"]), k) for k, n in enumerate(names)],
        f"id string, target string, {SOURCE_POS} bigint",
    )
    cards = spark.createDataFrame(
        [(k % 3 + 1, f"kind {k}", k) for k in range(5)] + [(None, "none", 9)],
        f"id bigint, kind string, {SOURCE_POS} bigint",
    )
    cfg = RiskConfig()
    raw = {"transactions": tx, "labels": labels, "cards": cards}
    got = training.supervised_splits(raw, cfg)
    joined = supervised_table(tx, labels, cfg, cards)
    want = temporal_split(clean(joined, cfg), cfg).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.filter("transaction_id IS NULL").count() == 1


def test_a_run_is_recorded(spark, finished):
    root, run_id = finished
    store = RunStore(spark, root)
    run = store.table("training_runs").first()
    assert run["run_id"] == run_id and run["audit_status"] == "warning"
    assert store.table("run_metrics").count() == 2
    assert store.table("threshold_evaluations").count() == 46
    kinds = {r["artifact_type"] for r in store.table("run_artifacts").collect()}
    assert kinds == {"pipeline", "metadata_table", "metadata_json", "threshold_analysis", "leakage_audit"}
    assert store.index().first()["threshold"] == pytest.approx(float(run["selected_threshold"]))
    store.register_views()
    fact = spark.sql("SELECT is_active_baseline, test_pr_auc FROM fact_model_runs").first()
    assert fact["is_active_baseline"] and fact["test_pr_auc"] > 0.5
    table = spark.read.option("header", True).csv(f"{store.run_directory(run_id)}/threshold_analysis.csv")
    assert table.count() == 46 and table.first()["split"] == "validation"
    report = json.loads(spark.read.text(f"{store.run_directory(run_id)}/leakage_audit.json").first()[0])
    assert "card_brand" in report["selected_input_columns"]
    assert "credit_limit" not in report["selected_input_columns"]


@pytest.fixture(scope="module")
def service(spark, raw, finished):
    root, run_id = finished
    dimensions = {k: raw[0][k] for k in ("cards", "users", "mcc")}
    return ScoringService.load(spark, RunStore(spark, root).run_directory(run_id), dimensions, CFG)


@pytest.mark.parametrize("with_id", [True, False])
def test_every_input_row_gets_a_score(spark, raw, service, with_id):
    """Repeated ids, missing ids, no id column at all, and repeated keys in the dimensions."""
    rows = [("a", 1, "$5.00"), ("a", 1, "$900.00"), (None, 2, "$5.00"), (None, 2, "$7.00"), ("b", 3, None), ("a", 4, "x")]
    rows = [(*r, f"2020-03-0{i + 1} 10:00:00", 5411, i) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(rows, "id string, card_id bigint, amount string, date string, mcc int, row_no int")
    cards = raw[0]["cards"]
    doubled = ScoringService(service.pipeline, service.metadata, {**service.dimensions, "cards": cards.union(cards)}, CFG)
    for one in (service, doubled):
        out = one.predict_frame(frame if with_id else frame.drop("id"))
        got = {r["row_no"]: r for r in out.collect()}
        assert out.count() == 6 and sorted(got) == list(range(6))
        assert all(0 <= r["fraud_score"] <= 1 for r in got.values())
        assert all(r["is_fraud_predicted"] == int(r["fraud_score"] >= r["threshold"]) for r in got.values())
        if with_id:
            assert got[0]["fraud_score"] == got[1]["fraud_score"] == got[5]["fraud_score"]
            assert [got[i]["amount"] for i in range(6)] == [r[2] for r in rows]


@pytest.mark.parametrize("broadcast_rows, stored", [(200_000, 1), (0, 2)])
def test_scored_rows_are_stored_once(spark, raw, service, monkeypatch, broadcast_rows, stored):
    """Only dimensions beyond a broadcast read the rows twice, and the scores are the same."""
    from riskloom.config import ScaleLimits
    from riskloom.operators import enrich
    from riskloom.plans import scoring
    from riskloom.roles import ORIGINAL

    wide = []

    def watched(df, *args):
        wide.extend([ORIGINAL] if ORIGINAL in df.columns else [])
        return pin(df, *args)

    pin = scoring.pin
    monkeypatch.setattr(scoring, "pin", watched)
    monkeypatch.setattr(enrich, "pin", watched, raising=False)
    cfg = CFG.with_(limits=ScaleLimits(broadcast_rows=broadcast_rows))
    one = ScoringService(service.pipeline, service.metadata, service.dimensions, cfg)
    frame = raw[0]["transactions"].drop(SOURCE_POS)
    scored = {r["id"]: r["fraud_score"] for r in one.predict_frame(frame).collect()}
    assert len(wide) == stored and len(scored) == ROWS
    plain = {r["id"]: r["fraud_score"] for r in service.predict_frame(raw[0]["transactions"]).collect()}
    assert scored == pytest.approx(plain)


def test_a_run_leaves_nothing_pinned(spark, raw, tmp_path, monkeypatch):
    from riskloom import session

    pinned = str(tmp_path / "pinned")
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda _: pinned)
    (tmp_path / "pinned").mkdir()
    training.run(spark, raw[0], str(tmp_path / "work"), CFG)
    assert list((tmp_path / "pinned").iterdir()) == []


def test_a_scope_drops_only_what_its_own_thread_pins(spark):
    import threading

    from riskloom.session import path_exists, pin, pinned_scope

    made = {}
    with pinned_scope(spark):
        worker = threading.Thread(target=lambda: made.update(other=pin(spark.range(3).toDF("x"))))
        worker.start()
        worker.join()
        own = pin(spark.range(2).toDF("x"))
        path = own.inputFiles()[0]
    assert made["other"].count() == 3 and not path_exists(spark, path)


def test_batch_scores_every_row(spark, raw, service, tmp_path):
    target = str(tmp_path / "scored")
    scored = service.predict_csv(spark, f"{raw[1]}/transactions_data.csv", target)
    rows = scored.collect()
    assert len(rows) == ROWS and all(0 <= r["fraud_score"] <= 1 for r in rows)
    assert scored.columns[:5] == ["id", "date", "client_id", "card_id", "amount"]
    assert rows[0]["amount"].startswith("$")
    assert all(r["is_fraud_predicted"] == int(r["fraud_score"] >= service.threshold) for r in rows)
    assert spark.read.option("header", True).csv(target).count() == ROWS


RECORD = {
    "date": "2030-01-01 10:30:00", "amount": "$42.10", "card_id": 123, "client_id": 10,
    "merchant_id": 999, "merchant_city": "Austin", "merchant_state": "TX", "mcc": 5812,
}


def test_free_form_records(spark, service):
    rows = service.predict_records(spark, [RECORD, {**RECORD, "amount": "$900.00"}])
    low, high = sorted(r["fraud_score"] for r in rows.collect())
    assert rows.columns == list(PREDICTION_COLUMNS) and low < high
    with pytest.raises(ValueError):
        service.predict_records(spark, [])


def test_a_stream_scores_like_the_batch(spark, service, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    schema = T.StructType([T.StructField(k, T.LongType() if isinstance(v, int) else T.StringType()) for k, v in RECORD.items()])
    seen = []
    for n, amount in enumerate(["$42.10", "$900.00"]):
        (inbox / f"{n}.json").write_text(json.dumps({**RECORD, "amount": amount}) + "\n")
        stream = record_stream(spark, str(inbox), schema)
        start_scoring(stream, service, out, str(tmp_path / "ck")).awaitTermination(120)
        seen.append(scored_records(spark, out).count())
    assert seen == [1, 2]
    streamed = sorted(r["fraud_score"] for r in scored_records(spark, out).collect())
    batch = service.predict_records(spark, [RECORD, {**RECORD, "amount": "$900.00"}])
    # Each record was alone in its batch, so neither saw the other.
    alone = [service.predict_records(spark, [{**RECORD, "amount": a}]).first()[0] for a in ("$42.10", "$900.00")]
    assert streamed == pytest.approx(sorted(alone))
    assert batch.count() == 2


def test_missing_model_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ScoringService.load(spark, str(tmp_path))


def test_fbeta_strategy_and_comparison(raw):
    splits = training.supervised_splits(raw[0], CFG)
    result = training.train(splits, CFG.with_(threshold_strategy="fbeta"))
    validation = result.scored.filter("split = 'validation'").select(training.SCORE).toPandas()
    assert validation.min().iloc[0] <= result.threshold <= validation.max().iloc[0]
    table = training.compare_models(splits, CFG, ["logistic_regression", "random_forest"])
    assert {(r["model"], r["split"]) for r in table.collect()} == {
        (m, s) for m in ("logistic_regression", "random_forest") for s in ("validation", "test")
    }
