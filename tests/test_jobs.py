"""The submit jobs, one after another, on small files."""

import json
import random
from datetime import timedelta

import pytest

import jobs
from helpers import DAY
from riskloom.plans.store import RunStore


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    rng = random.Random(2)
    lines, labels = ["id,date,client_id,card_id,amount,mcc"], {}
    for i in range(240):
        amount = round(rng.expovariate(1 / 60), 2)
        lines.append(f"{i},{(DAY + timedelta(minutes=31 * i)):%Y-%m-%d %H:%M:%S},{i % 5},{i % 7},${amount},5411")
        labels[str(i)] = "Yes" if amount + rng.gauss(0, 20) > 90 else "No"
    (raw / "transactions_data.csv").write_text("\n".join(lines) + "\n")
    (raw / "cards_data.csv").write_text("id,card_brand\n" + "".join(f"{c},Visa\n" for c in range(7)))
    (raw / "train_fraud_labels.json").write_text(json.dumps({"target": labels}))
    return str(raw), str(tmp_path_factory.mktemp("work"))


def test_train_list_score_promote(spark, folders, capsys):
    raw, root = folders
    jobs.main(["train", "--raw", raw, "--root", root, "--max-rows", "120"])
    run_id = capsys.readouterr().out.strip().splitlines()[-1]
    store = RunStore(spark, root)
    row = store.table("training_runs").first()
    assert row["run_id"] == run_id and row["training_max_rows"] == 120 and row["train_rows"] > 120
    jobs.main(["runs", "--root", root])
    assert run_id in capsys.readouterr().out
    out = f"{root}/scored"
    jobs.main(["score", "--root", root, "--run", run_id, "--raw", raw, "--input", f"{raw}/transactions_data.csv", "--output", out])
    assert spark.read.option("header", True).csv(out).count() == 240
    jobs.main(["promote", "--root", root, "--run", run_id])
    assert store.table("baseline_promotions").filter("is_active").count() == 1
    with pytest.raises(FileExistsError):
        jobs.main(["promote", "--root", root, "--run", run_id])
    jobs.main(["promote", "--root", root, "--run", run_id, "--overwrite"])


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        jobs.main(["train", "--raw", "x"])
