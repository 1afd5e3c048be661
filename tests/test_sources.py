import hashlib
import json
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import sources as catalog_sources
from riskloom.config import RiskConfig
from riskloom.operators.enrich import first_labelled, labels_frame
from riskloom.roles import SOURCE_POS
from riskloom.sources import artifacts, files, json_files, landing, positions, sinks

CFG = RiskConfig()


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture()
def raw(tmp_path):
    write(tmp_path, "transactions_data.csv", "id,date,client_id,card_id,amount,mcc,merchant_state\n"
          "1,2020-01-01,100,10,$10.00,5812,NA\n2,2020-01-02,100,10,$20.00,5411,SP\n")
    write(tmp_path, "cards.csv", "id,client_id,card_type\n10,100,Debit\n")
    write(tmp_path, "mcc_codes.json", '{"5812": "Restaurants, all", "5411": "Grocery"}')
    write(tmp_path, "train_fraud_labels.json", '{"target": {"1": "No", "2": "Yes"}}')
    return tmp_path


def test_all_sources_are_loaded(spark, raw):
    found = files.load_all(spark, str(raw))
    tx = found["transactions"]
    assert dict(tx.dtypes)["card_id"] == "bigint" and dict(tx.dtypes)["amount"] == "string"
    assert [r["merchant_state"] for r in files.preview(tx, 2).collect()] == [None, "SP"]
    assert found["cards"].count() == 1 and found["users"].columns == []
    assert {r["key"]: r["value"] for r in found["mcc"].collect()}["5812"] == "Restaurants, all"
    assert {r["key"]: r["value"] for r in found["labels"].collect()} == {"1": "No", "2": "Yes"}
    assert spark.sql("SELECT count(*) FROM transactions").first()[0] == 2


def test_missing_required_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_csv(spark, str(tmp_path), ["x.csv"])
    assert files.load_csv(spark, str(tmp_path), ["x.csv"], required=False).columns == []


@pytest.mark.parametrize(
    "text",
    [
        '{"target": {"1": "No", "2": "Yes"}}',
        '{"1": "No",\n "2": "Yes"}',
        '{"1": 0, "2": 1}',
        '{"1": null, "2": true}',
        '[{"id": "1", "target": "No"}, {"id": "2", "target": "Yes"}]',
        '[{"id": 1, "target": 0},\n{"id": 2, "target": 1}\n]\n',
    ],
)
def test_label_files(spark, tmp_path, text):
    write(tmp_path, "labels.json", text)
    frame = labels_frame(files.read_labels(spark, str(tmp_path / "labels.json")), CFG)
    assert sorted(map(tuple, frame.drop(SOURCE_POS).collect())) == [("1", 0), ("2", 1)]


@pytest.mark.parametrize("text", ["{}", '{"target": {}}', "[]"])
def test_empty_label_files(spark, tmp_path, text):
    write(tmp_path, "labels.json", text)
    assert files.read_labels(spark, str(tmp_path / "labels.json")).count() == 0


def test_a_large_label_object_is_read_by_many_tasks(spark, tmp_path):
    labels = {str(i): "Yes" if i % 7 == 0 else "No" for i in range(200_000)}
    write(tmp_path, "labels.json", json.dumps({"target": labels}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 256 * 1024)
    try:
        df = files.read_labels(spark, str(tmp_path / "labels.json"))
        assert df.rdd.getNumPartitions() > 4
        assert df.distinct().count() == 200_000
        assert df.filter("value = 'Yes'").count() == sum(v == "Yes" for v in labels.values())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


ODD_TEXTS = [
    "No, not at all", 'a "quoted" text', "brace } and { and ] [", "back\\slash", 'ends in \\"', "\\", '"', ",", "{,", "},\n", "é, 日本", "\u2028", "", "tab\t,", '\\",', "x" * 300,
]


@pytest.fixture(params=[None, 16, 100])
def blocks(spark, request):
    """Reads files in blocks of so many bytes."""
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("wrapped, indent", [("no", None), ("first", 2), ("between", None), ("inside a text", 2)])
def test_members_with_any_text_in_any_block(spark, tmp_path, blocks, indent, wrapped):
    members = {f"k{i},{{": t for i, t in enumerate(ODD_TEXTS)} | {"n": 1.5, "yes": True, "none": None, "deep": {"a": [1, {"b": ","}], "target": {"z": 1}}, "list": ["x,y", {}]}
    document = {
        "no": members, "first": {"target": members, "note": "x, }"}, "between": {"note": ["{", 1], "target": members, "more": {"u": 1}},
        "inside a text": {**members, "t": '"target": {"q": 1}, "target": {'},
    }[wrapped]
    write(tmp_path, "labels.json", json.dumps(document, indent=indent, ensure_ascii=wrapped != "no"))
    want = members if wrapped in ("first", "between") else document
    got = {r["key"]: r["value"] for r in json_files.read_members(spark, str(tmp_path / "labels.json"), "target").collect()}
    shown = {k: None if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False) for k, v in want.items()}
    assert {k: v if k not in ("deep", "list") else json.dumps(json.loads(v), separators=(",", ":"), ensure_ascii=False) for k, v in got.items()} == shown


@pytest.mark.parametrize("indent", [1])
def test_records_with_any_text_in_any_block(spark, tmp_path, blocks, indent):
    records = [{"id": str(i), "text": t, "more": {"a": [t, {"b": {}}]}, **({"late": "{"} if i > 5 else {})} for i, t in enumerate(ODD_TEXTS)]
    write(tmp_path, "labels.json", json.dumps(records, indent=indent))
    rows = json_files.read_json_records(spark, str(tmp_path / "labels.json"))
    assert rows.columns == ["id", "text", "more", "late", SOURCE_POS]
    got = [(r["id"], r["text"], json.loads(r["more"]), r["late"]) for r in rows.orderBy(SOURCE_POS).collect()]
    assert got == [(r["id"], r["text"], r["more"], r.get("late")) for r in records]


def test_many_documents_in_a_folder(spark, tmp_path, blocks):
    folder = tmp_path / "labels.json"
    folder.mkdir()
    for k in range(5):
        write(folder, f"part {k}.json", json.dumps({"note": "{", "target": {f"{k}-{i}": t for i, t in enumerate(ODD_TEXTS)}} if k % 2 else {f"{k}-{i}": t for i, t in enumerate(ODD_TEXTS)}))
    got = {r["key"]: r["value"] for r in files.read_labels(spark, str(folder)).collect()}
    assert got == {f"{k}-{i}": t for k in range(5) for i, t in enumerate(ODD_TEXTS)}


@pytest.mark.parametrize("text", ['{"a": }', '[{"a": 1}, 5x]', '{"a": "1"; "b"}'])
def test_malformed_documents_stop_the_job(spark, tmp_path, text):
    write(tmp_path, "labels.json", text)
    with pytest.raises(Exception):
        files.read_labels(spark, str(tmp_path / "labels.json")).collect()


def test_a_code_dictionary_keeps_the_last_of_a_repeated_code(spark, tmp_path):
    write(tmp_path, "mcc.json", '{"1": "a, {b", "2": "c", "1": null}')
    got = {r["key"]: r["value"] for r in files.read_json_object(spark, str(tmp_path / "mcc.json")).collect()}
    assert got == {"1": None, "2": "c"}


@pytest.mark.parametrize("in_plan", [256, 2])
def test_positions_follow_files_and_offsets(spark, tmp_path, monkeypatch, in_plan):
    monkeypatch.setattr(positions, "FILES_IN_PLAN", in_plan)
    folder = tmp_path / "tx.csv"
    folder.mkdir()
    sizes = {"a b.csv": 50, "b.csv": 4000, "c.csv": 700, "d%é.csv": 3, "e.csv": 900}
    start = 0
    for name, size in sizes.items():
        write(folder, name, "id,v\n" + "".join(f"{i},x\n" for i in range(start, start + size)))
        start += size
    for size in (8 * 1024, 700):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = files.read_csv(spark, str(folder))
            ids = [r["id"] for r in df.orderBy(SOURCE_POS).collect()]
            tasks = df.rdd.getNumPartitions()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert ids == list(range(start)) and tasks > 4
        assert df.select(SOURCE_POS).distinct().count() == start
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange hash" not in plan
    assert ("Join" in plan) == (in_plan == 2)


def dataset(folder, content):
    folder.mkdir(exist_ok=True)
    write(folder, "transactions_data.csv", f"id,value\n1,{content}\n")
    write(folder, "cards_data.csv", "id\n1\n")
    write(folder, "users_data.csv", "id\n1\n")
    write(folder, "mcc_codes.json", "{}")
    write(folder, "train_fraud_labels.json", "{}")


def test_landing_keeps_or_replaces(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "landed")
    dataset(source, "original")
    assert len(landing.land(spark, str(source), target).imported) == 5
    dataset(source, "replacement")
    again = landing.land(spark, str(source), target)
    assert (again.imported, len(again.skipped)) == ((), 5)
    assert landing.load_landed(spark, target)["transactions"].first()["value"] == "original"
    replaced = landing.land(spark, str(source), target, overwrite=True)
    assert (len(replaced.imported), replaced.skipped) == (5, ())
    assert landing.load_landed(spark, target)["transactions"].first()["value"] == "replacement"


def test_partial_landing_fills_the_gaps(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "landed")
    source.mkdir()
    write(source, "cards_data.csv", "id\n1\n")
    assert landing.land(spark, str(source), target).imported == ("cards",)
    dataset(source, "x")
    second = landing.land(spark, str(source), target)
    assert second.skipped == ("cards",) and len(second.imported) == 4


def test_file_status(spark, raw):
    status = {r["file"]: r["exists"] for r in landing.file_status(spark, str(raw)).collect()}
    assert status["transactions_data.csv"] and not status["users_data.csv"] and len(status) == 5


def test_inventory_and_digest(spark, tmp_path):
    write(tmp_path, "metadata.json", "{}")
    write(tmp_path, "notes.txt", "hello")
    rows = {r["artifact_type"]: r for r in artifacts.inventory(spark, "r", str(tmp_path)).collect()}
    assert rows["metadata_json"]["size_bytes"] == 2
    assert rows["other"]["sha256"] == hashlib.sha256(b"hello").hexdigest()
    digest = artifacts.folder_digest(spark, str(tmp_path))
    write(tmp_path, "notes.txt", "hullo")
    assert digest != artifacts.folder_digest(spark, str(tmp_path))


def test_a_file_beyond_two_gigabytes_is_hashed_in_chunks(spark, tmp_path):
    size = (2 << 30) + 5
    with open(tmp_path / "large file.bin", "wb") as file:  # it takes no room on disk
        file.truncate(size)
    write(tmp_path, "small.txt", "x")
    want, left, block = hashlib.sha256(), size, bytes(16 << 20)
    while left:
        want.update(block[: min(left, len(block))])
        left -= min(left, len(block))
    rows = {r["name"]: (r["sha256"], r["size_bytes"]) for r in artifacts.file_digests(spark, str(tmp_path)).collect()}
    assert rows == {"large file.bin": (want.hexdigest(), size), "small.txt": (hashlib.sha256(b"x").hexdigest(), 1)}


def test_hashing_holds_a_chunk_at_a_time(tmp_path):
    with open(tmp_path / "f", "wb") as file:
        file.truncate(300 << 20)
    batch = pa.RecordBatch.from_arrays([pa.array([f"file:{tmp_path}/f"]), pa.array([300 << 20])], names=["uri", "size_bytes"])
    tracemalloc.start()
    assert next(artifacts._hash_files(iter([batch]))).num_rows == 1
    most, pool = tracemalloc.get_traced_memory()[1], pa.default_memory_pool().max_memory()
    tracemalloc.stop()
    assert most < 64 << 20 and pool < 1 << 30


def test_documents_have_no_infinities(spark, tmp_path):
    path = str(tmp_path / "doc")
    sinks.write_document(spark, {"a": float("nan"), "b": [float("inf"), 1.5]}, path)
    assert sinks.read_document(spark, path) == {"a": None, "b": [None, 1.5]}
    df = spark.createDataFrame([(float("nan"), float("-inf"), 2.0)], "a double, b double, c double")
    assert tuple(sinks.finite_or_null(df).first()) == (None, None, 2.0)


@pytest.mark.parametrize(
    "text, want",
    [
        ('[{"id": "1", "target": "Yes"}, {"id": "1", "target": "No"}]', 1),  # the first record
        ('{"target": {"1": "No", "1": "Yes"}}', 1),  # the last entry of an object
        ('{"target": {"1": "Yes", "1": "No"}}', 0),
    ],
)
def test_repeated_labels(spark, tmp_path, text, want):
    write(tmp_path, "labels.json", text)
    labels = labels_frame(files.read_labels(spark, str(tmp_path / "labels.json")), CFG)
    tx = spark.createDataFrame([("1", 0)], f"transaction_id string, {SOURCE_POS} bigint")
    assert [r[CFG.target] for r in first_labelled(tx, labels, CFG).collect()] == [want]


def test_records_with_unlike_fields(spark, tmp_path):
    write(tmp_path, "labels.json", '[{"id": "1"}, {"id": "2", "is_fraud": "Yes"},\n{"note": "x", "id": "3", "is_fraud": "No"}]')
    rows = json_files.read_json_records(spark, str(tmp_path / "labels.json"))
    assert rows.columns == ["id", "is_fraud", "note", SOURCE_POS]
    got = sorted((r["id"], r["is_fraud"], r["note"]) for r in rows.collect())
    assert got == [("1", None, None), ("2", "Yes", None), ("3", "No", "x")]


def test_text_ids_are_kept(spark, tmp_path):
    write(tmp_path, "transactions.csv", "id,card_id,mcc,amount\ntx-1,7,5411,$1\n2,8,x,$2\n3,,,$3\n")
    rows = files.read_csv(spark, str(tmp_path / "transactions.csv"))
    assert dict(rows.dtypes) | {"id": "string", "card_id": "bigint", "mcc": "string"} == dict(rows.dtypes)
    assert [(r["id"], r["card_id"], r["mcc"]) for r in rows.orderBy(SOURCE_POS).collect()] == [("tx-1", 7, "5411"), ("2", 8, "x"), ("3", None, None)]


def test_quoted_line_breaks(spark, tmp_path):
    write(tmp_path, "t.csv", 'id,name\n1,"a\nb"\n2,c\n')
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), multi_line=True).collect()
    assert [(r["id"], r["name"]) for r in rows] == [(1, "a\nb"), (2, "c")]


@pytest.mark.parametrize("inner", [None, "target"])
def test_one_file_is_put_together_in_short_runs(spark, tmp_path, monkeypatch, inner):
    """Runs of two pieces, put in order by many tasks, though one task reads the file."""
    monkeypatch.setattr(json_files, "BLOCK_BITS", 1)
    monkeypatch.setattr(json_files, "TASK_BYTES", 200)
    members = {f"k{i},{{": t for i, t in enumerate(ODD_TEXTS)} | {"deep": {"a": [1, {"b": ",,,,,"}, 2, 3, 4]}, "last": "x"}
    write(tmp_path, "labels.json", json.dumps({"note": "x, }", "target": members} if inner else members))
    pieces = json_files.pieces(spark, str(tmp_path / "labels.json"))
    assert pieces.groupBy("_file", "_block").count().agg({"count": "max"}).first()[0] == 2
    got = {r["key"]: r["value"] for r in json_files.read_members(spark, str(tmp_path / "labels.json"), inner).collect()}
    assert {k: json.loads(v) if k == "deep" else v for k, v in got.items()} == members


def test_a_larger_table_is_written_as_larger_documents(spark, tmp_path, monkeypatch):
    assert [catalog_sources._members(n) for n in (0, 1000, 600_000, 36_000_000)] == [500, 500, 3000, 50_000]
    monkeypatch.setattr(catalog_sources, "DOCUMENT_MEMBERS", 10)
    monkeypatch.setattr(catalog_sources, "DOCUMENTS", 3)
    rows = spark.range(90).withColumns({"key": F.col("id").cast("string"), "value": F.lit("No, {")})
    document = F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "value"))))
    path = catalog_sources._documents(rows, str(tmp_path / "out"), document)
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("document=")]) == 3
    got = files.read_json_object(spark, path).collect()
    assert sorted(int(r["key"]) for r in got) == list(range(90)) and {r["value"] for r in got} == {"No, {"}
