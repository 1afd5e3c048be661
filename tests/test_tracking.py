import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from riskloom.config import ScaleLimits
from riskloom.plans import tracking as K
from riskloom.plans import commits
from riskloom.plans.commits import Change, CommitLog, State
from riskloom.plans.store import RunStore
from riskloom.plans.training import metric_frame, run_row
from riskloom.session import create_if_absent, list_folder, read_text

commit = CommitLog.commit

WARNING = {"status": "warning", "warnings": ["high area"]}


def metrics(precision, recall, f1, fbeta, pr_auc, roc_auc, tp, fp, fn, tn=100):
    return dict(
        threshold=0.2, precision=precision, recall=recall, f1=f1, fbeta=fbeta,
        pr_auc=pr_auc, roc_auc=roc_auc, tp=tp, fp=fp, fn=fn, tn=tn,
    )


def metadata(run_id, test_pr_auc=0.6, stamp="2026-06-13T20:00:00+00:00", cost=38):
    return {
        "model_name": "logistic_regression",
        "threshold": 0.2,
        "training_max_rows": 1000,
        "strict_leakage_prevention": True,
        "validation_metrics": metrics(0.3, 0.8, 0.43, 0.6, 0.5, 0.9, 8, 18, 2),
        "test_metrics": metrics(0.4, 0.9, 0.55, 0.7, test_pr_auc, None, 9, 13, 1),
        "threshold_selection": {
            "strategy": "business_cost", "false_positive_cost": 1, "false_negative_cost": 25,
        },
        "operational_costs": {"validation": 68, "test": cost},
        "dataset": {
            "train_rows": 700, "validation_rows": 150, "test_rows": 150,
            "train_positive_rate": 0.01, "validation_positive_rate": 0.02, "test_positive_rate": 0.02,
        },
        "run": {
            "run_id": run_id, "started_at_utc": stamp, "completed_at_utc": stamp,
            "duration_seconds": 1.5, "pipeline_sha256": "ab" * 32,
        },
    }


def thresholds(spark, run_id):
    rows = [(s, t, 0.1, 0.2, 0.3, 0.4, 1, 2, 3, 4, 3, 0.3, 5.0, 0.5) for s in ("validation", "test") for t in (0.2, 0.1)]
    names = "split string, threshold double, precision double, recall double, f1 double, fbeta double, tp bigint, fp bigint, tn bigint, fn bigint, alerts bigint, alert_rate double, business_cost double, cost_per_record double"
    return K.threshold_rows(spark.createDataFrame(rows, names), F.lit(run_id))


def artifacts(spark, run_id):
    rows = [(run_id, "pipeline", "b", "ff", 10), (run_id, "leakage_audit", "a", "ee", None)]
    return spark.createDataFrame(
        rows, "run_id string, artifact_type string, uri string, sha256 string, size_bytes bigint"
    ).withColumn("created_at", F.current_timestamp())


def record(spark, store, about):
    run_id = about["run"]["run_id"]
    store.record(
        about,
        WARNING,
        run_row(spark, about, WARNING),
        metric_frame(spark, about),
        thresholds(spark, run_id),
        artifacts(spark, run_id),
    )


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = RunStore(spark, str(tmp_path_factory.mktemp("history")))
    record(spark, store, metadata("r1", 0.6, "2026-06-13T20:00:00+00:00"))
    record(spark, store, metadata("r2", 0.7, "2026-06-14T20:00:00+00:00", cost=50))
    record(spark, store, metadata("r3", 0.6, "2026-06-12T20:00:00+00:00"))
    return store


def test_index_is_flat_newest_first_and_runs_are_immutable(spark, store):
    rows = store.index().collect()
    assert [r["run_id"] for r in rows] == ["r2", "r1", "r3"]
    assert len(rows[0].asDict()) == 40
    assert rows[1]["test_business_cost"] == 38
    assert rows[1]["audit_warning_count"] == 1
    with pytest.raises(FileExistsError):
        record(spark, store, metadata("r1"))


def test_leaderboard(store):
    assert [r["run_id"] for r in store.leaderboard("test_pr_auc", 2).collect()] == ["r2", "r1"]
    with pytest.raises(ValueError):
        store.leaderboard("accuracy")


def test_run_ids_sort_by_time():
    first, second = K.new_run_id(" Random Forest "), K.new_run_id("x")
    assert first < second and "_random_forest_" in first and len(first.split("_")[-1]) == 8


def test_append_keeps_existing_rows(spark, store):
    before = store.table("run_metrics").count()
    changed = store.table("run_metrics").withColumn("precision", F.lit(9.0))
    store.append("run_metrics", changed)
    after = store.table("run_metrics")
    assert after.count() == before and after.filter("precision = 9").isEmpty()


def test_promotion_guard_and_reactivation(spark, store):
    store.promote("r1")
    with pytest.raises(FileExistsError):
        store.promote("r2")
    store.promote("r2", overwrite=True)
    store.promote("r1", overwrite=True)
    rows = {r["run_id"]: r for r in store.table("baseline_promotions").collect()}
    assert {k: r["is_active"] for k, r in rows.items()} == {"r1": True, "r2": False}
    assert rows["r1"]["audit_status"] == "warning" and len({r["id"] for r in rows.values()}) == 2
    with pytest.raises(FileNotFoundError):
        store.promote("nobody")
    found = {(r["table"], r["rule"]): r["violations"] for r in K.violations(store.tables()).collect()}
    assert set(found.values()) == {0} and ("baseline_promotions", "one_active") in found


def test_fact_view_by_sql(spark, store):
    store.register_views()
    rows = spark.sql(
        "SELECT * FROM fact_model_runs ORDER BY test_pr_auc_rank, run_id"
    ).collect()
    assert [(r["run_id"], r["test_pr_auc_rank"]) for r in rows] == [("r2", 1), ("r1", 2), ("r3", 2)]
    top = rows[0]
    assert [(e["split"], float(e["threshold"])) for e in top["threshold_evaluations"]] == [
        ("test", 0.1), ("test", 0.2), ("validation", 0.1), ("validation", 0.2),
    ]
    assert top["threshold_evaluation_count"] == 4 and float(top["threshold_min"]) == 0.1
    assert [a["artifact_type"] for a in top["artifacts"]] == ["leakage_audit", "pipeline"]
    assert top["artifact_total_size_bytes"] == 10 and top["test_roc_auc"] is None
    assert top["test_business_cost_rank"] == 2 and rows[1]["test_business_cost_rank"] == 1
    none = rows[2]
    assert (none["baseline_promotion_count"], none["is_active_baseline"], none["baseline_promotions"]) == (0, False, [])


@pytest.mark.parametrize("rows_per_run", [2_000_000, 3])
def test_ranks_of_long_histories_equal_windows(spark, rows_per_run):
    rows = [(f"r{i}", "ab"[i % 2], None if i % 7 == 0 else (i * 5 % 9) / 10, float(i % 4), float(i % 5)) for i in range(40)]
    fact = spark.createDataFrame(
        rows, "run_id string, model_name string, test_pr_auc double, test_fbeta double, test_business_cost double"
    )
    want = sorted(map(tuple, K.run_ranks(fact, ScaleLimits(), 40).collect()))
    got = K.run_ranks(fact, ScaleLimits(rows_per_run=rows_per_run), 40)
    assert sorted(map(tuple, got.collect())) == want


def test_rules_are_checked(spark, store):
    bad = store.table("run_metrics").limit(1).withColumn("split", F.lit("train"))
    counts = K.violations({"run_metrics": bad.unionByName(bad)}).collect()
    assert {(r["rule"], r["violations"]) for r in counts} == {("split_domain", 2), ("key_unique", 1)}


def test_deleting_a_run_takes_its_rows(spark, store):
    gone = spark.createDataFrame([("r1",)], "run_id string")
    left = K.delete_runs(store.tables(), gone)
    assert left["run_metrics"].select("run_id").distinct().count() == 2
    assert left["threshold_evaluations"].filter("run_id = 'r1'").isEmpty()
    promotions = left["baseline_promotions"].collect()
    assert len(promotions) == 2 and [r["run_id"] for r in promotions].count(None) == 1


ALL = ("training_runs", "run_metrics", "threshold_evaluations", "run_artifacts", "baseline_promotions")


def runs_in(store):
    """The ids that each table names."""
    tables = store.tables() | {"run_index": store.index()}
    return {n: sorted(str(r[0]) for r in df.select("run_id").distinct().collect()) for n, df in tables.items()}


def test_two_promotions_at_once_leave_one_active(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    for name in ("a", "b", "c"):
        record(spark, store, metadata(name))
    barrier = threading.Barrier(3)

    def promote(name):
        barrier.wait()
        RunStore(spark, str(tmp_path)).promote(name, overwrite=True)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(promote, "abc"))
    rows = store.table("baseline_promotions").collect()
    assert sorted(r["run_id"] for r in rows) == ["a", "b", "c"] and sum(r["is_active"] for r in rows) == 1
    assert len({r["id"] for r in rows}) == 3
    assert store.log.read().version == 6


def test_runs_recorded_at_once_are_all_there(spark, tmp_path):
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda name: record(spark, RunStore(spark, str(tmp_path)), metadata(name)), "abc"))
    store = RunStore(spark, str(tmp_path))
    assert {n: ids for n, ids in runs_in(store).items() if n != "baseline_promotions"} == {n: ["a", "b", "c"] for n in (*ALL[:4], "run_index")}
    with ThreadPoolExecutor(2) as pool:  # the same run twice: one of them is told
        done = [pool.submit(record, spark, RunStore(spark, str(tmp_path)), metadata("d")) for _ in range(2)]
    assert sorted(type(f.exception()).__name__ for f in done) == ["FileExistsError", "NoneType"]
    assert store.table("run_metrics").filter("run_id = 'd'").count() == 2


def test_create_if_absent_has_one_winner(spark, tmp_path):
    path = f"file:{tmp_path}/x.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_if_absent(spark, path, f"writer {i}"), range(24)))
    assert sum(won) == 1 and read_text(spark, path) == f"writer {won.index(True)}"
    assert [n for n, _ in list_folder(spark, str(tmp_path)) if not n.startswith(".")] == ["x.json"]


@pytest.mark.parametrize("stops", [False, True])
def test_a_deleted_run_is_gone_from_all_tables_at_once(spark, tmp_path, monkeypatch, stops):
    store = RunStore(spark, str(tmp_path))
    for name in ("a", "b", "c"):
        record(spark, store, metadata(name))
    store.promote("a")
    store.promote("b", overwrite=True)
    want = {n: ["b", "c"] for n in (*ALL[:4], "run_index")} | {"baseline_promotions": ["None", "b"]}
    folders = {n: {f for f, _ in own} for n, own in store.log.read().folders.items()}
    if stops:  # the job ends before the rows are written anew, or while they are
        monkeypatch.setattr(CommitLog, "commit", lambda self, base, change: (_ for _ in ()).throw(OSError("stopped")) if change.purged else commit(self, base, change))
        with pytest.raises(OSError):
            store.delete("a")
        assert runs_in(store) == want and store.log.read().deleted == [(6, ["a"])]
        monkeypatch.undo()
        record(spark, store, metadata("a"))  # the id can be used again
        assert runs_in(store)["run_metrics"] == ["a", "b", "c"] and store.table("run_metrics").filter("run_id = 'a'").count() == 2
        store.delete("a", purge=False)
        store.purge()
    else:
        store.delete("a")
    state = store.log.read()
    assert runs_in(store) == want and state.deleted == []
    kept = {n: {f for f, _ in own} & folders[n] for n, own in state.folders.items()}
    assert all(len(kept[n]) == 2 for n in ALL[:4]) and not kept["baseline_promotions"]  # only touched folders are new
    assert [r["is_active"] for r in store.table("baseline_promotions").orderBy("id").collect()] == [False, True]
    store.vacuum(hours=0)
    assert runs_in(store) == want
    on_disk = {n: {f for f, _ in list_folder(spark, f"{tmp_path}/{n}")} for n in state.folders}
    assert on_disk == {n: {f for f, _ in own} for n, own in state.folders.items()}


def test_a_long_log_is_read_from_its_last_whole_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "STATE_EVERY", 5)
    log, plain = CommitLog(spark, str(tmp_path)), State()
    for i in range(1, 14):
        change = Change(add={"t": [f"f{i}"]}, remove={"t": [f"f{i - 3}"]} if i > 3 else {}, delete=[f"r{i}"] if i % 4 == 0 else [], purged=[4] if i == 9 else [])
        assert log.commit(plain, change) and not log.commit(plain, Change())
        plain = plain.after(change)
        assert log.read() == plain
    seen = []
    monkeypatch.setattr(commits, "read_text", lambda spark, path: seen.append(path) or read_text(spark, path))
    assert log.read() == plain and len(seen) == 4


def test_upsert_keeps_the_last(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "run_id string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "run_id string, v int")
    got = {r["run_id"]: r["v"] for r in K.upsert_last(old, new, "run_id").collect()}
    assert got == {"a": 1, "b": 3, "c": 4}
