"""Readers: the driver tables written as raw CSV and JSON files and read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.domain import CFG, table
from catalog.registry import query
from riskloom.operators.enrich import code_frame, first_labelled, labels_frame
from riskloom.operators.limits import first_rows
from riskloom.roles import SOURCE_POS
from riskloom.session import ensure_checkpoint_dir, join_path
from riskloom.sources import files, landing
from riskloom.sources.json_files import read_json_records

#: Members of one JSON document, which is written as one line of one file: the fewest, and the
#: most. Between them there are about so many documents, a task writing a few of them.
DOCUMENT_MEMBERS, MOST_MEMBERS = 500, 50_000
DOCUMENTS, TASK_DOCUMENTS = 200, 8


def _folder(spark: SparkSession, name: str) -> str:
    return join_path(ensure_checkpoint_dir(spark), f"{name}-{uuid4().hex}")


def _write_csv(df: DataFrame, path: str, order: str) -> str:
    """Several files, in which and through which rows are in order."""
    df.repartitionByRange(4, order).sortWithinPartitions(order).write.option("header", True).option("escape", '"').csv(path)
    return path


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")


_CSV_SQL = """SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS client_id, event_type,
  round(value, 6) AS amount, 'say "' || event_type || '", then' AS note FROM events"""


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.concat(F.lit('say "'), "event_type", F.lit('", then')).alias("note")
    raw = _events(spark, sf_dir).select(F.col("event_id").alias("id"), F.col("user_id").alias("client_id"), "event_type", F.col("value").alias("amount"), note)
    return files.read_csv(spark, _write_csv(raw, _folder(spark, "csv"), "id"))


@query("csv_scan", _CSV_SQL)
def _(spark, sf_dir):
    """Known columns come back with their types, quoted texts whole."""
    rows = _csv(spark, sf_dir)
    return rows.select("id", "client_id", "event_type", F.round(F.col("amount").cast("double"), 6).alias("amount"), "note")


@query("csv_first_rows", f"SELECT * FROM ({_CSV_SQL}) ORDER BY id LIMIT 1000")
def _(spark, sf_dir):
    """The first thousand rows of several files in source order."""
    rows = files.preview(_csv(spark, sf_dir), 1000)
    return rows.select("id", "client_id", "event_type", F.round(F.col("amount").cast("double"), 6).alias("amount"), "note")


@query("csv_rows_in_source_order", f"SELECT id FROM ({_CSV_SQL}) ORDER BY id LIMIT 2500")
def _(spark, sf_dir):
    """The same by order statistics of the positions, beyond what a top-k would hold."""
    return first_rows(_csv(spark, sf_dir), 2500, CFG.limits).select("id")


def _members(rows: int) -> int:
    """Members of a document: more in a large table, which else were written as ever more files."""
    return min(MOST_MEMBERS, max(DOCUMENT_MEMBERS, -(-rows // DOCUMENTS)))


def _documents(df: DataFrame, path: str, line) -> str:
    """One JSON document per so many ids of the rows (id, ...), each a file in a folder of its own."""
    rows = df.count()
    members = _members(rows)
    tasks = -(-rows // (members * TASK_DOCUMENTS)) or 1
    dealt = df.withColumn("document", F.floor(F.col("id") / members)).repartition(tasks, "document")
    dealt.groupBy("document").agg(line.alias("value")).write.partitionBy("document").text(path)
    return path


def _weird(column: str):
    """A text with commas, quotes, braces, a backslash and a line break in it."""
    return F.concat(F.lit('no, "'), column, F.lit('" }, { \\ [\n]'))


_WEIRD_SQL = "'no, \"' || props || '\" }, { \\ [' || chr(10) || ']'"


@query(
    "json_dictionary",
    f"""SELECT 'k,' || CAST(event_id AS VARCHAR) || '{{' AS "key", {_WEIRD_SQL} AS value FROM events""",
)
def _(spark, sf_dir):
    """Objects whose keys and texts hold commas, quotes, braces and line breaks."""
    key = F.concat(F.lit("k,"), F.col("event_id").cast("string"), F.lit("{"))
    raw = _events(spark, sf_dir).select(F.col("event_id").alias("id"), key.alias("key"), _weird("props").alias("value"))
    document = F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "value"))))
    return files.read_json_object(spark, _documents(raw, _folder(spark, "json"), document))


@query(
    "json_records",
    f"""SELECT CAST(event_id AS VARCHAR) AS id, {_WEIRD_SQL} AS note,
      '{{"user":' || CAST(user_id AS VARCHAR) || ',"tags":["a,b","}}"]}}' AS more,
      CASE WHEN event_id % 3 = 0 THEN event_type END AS late FROM events""",
)
def _(spark, sf_dir):
    """Records with nested values, and with a field that some of them lack."""
    more = F.struct(F.col("user_id").alias("user"), F.array(F.lit("a,b"), F.lit("}")).alias("tags"))
    late = F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
    raw = _events(spark, sf_dir).select(F.col("event_id").alias("id"), F.struct("event_id", _weird("props").alias("note"), more.alias("more"), late.alias("late")).alias("r"))
    record = F.transform(F.collect_list("r"), lambda r: F.struct(r["event_id"].alias("id"), r["note"].alias("note"), r["more"].alias("more"), r["late"].alias("late")))
    return read_json_records(spark, _documents(raw, _folder(spark, "json"), F.to_json(record))).select("id", "note", "more", "late")


_FLAG_SQL = "CAST(event_type = 'error' AS INTEGER)"


@query(
    "label_shapes",
    f"""SELECT shape, CAST(event_id AS VARCHAR) AS transaction_id, {_FLAG_SQL} AS is_fraud
    FROM events, (SELECT unnest(['target', 'flat', 'records']) AS shape)""",
)
def _(spark, sf_dir):
    """Labels as an object under a key, as a flat object and as records."""
    text = F.when(F.col("event_type") == "error", "Yes").otherwise("No, not at all")
    raw = _events(spark, sf_dir).select(F.col("event_id").alias("id"), F.col("event_id").cast("string").alias("key"), text.alias("value"))
    flat = F.map_from_entries(F.collect_list(F.struct("key", "value")))
    shapes = {
        "target": F.to_json(F.struct(F.lit("x, {").alias("note"), flat.alias("target"), F.array(F.lit("}")).alias("more"))),
        "flat": F.to_json(flat),
        "records": F.to_json(F.transform(F.collect_list(F.struct("key", "value")), lambda r: F.struct(r["key"].alias("id"), r["value"].alias("target")))),
    }
    out = None
    for name, document in shapes.items():
        found = labels_frame(files.read_labels(spark, _documents(raw, _folder(spark, "labels"), document)), CFG)
        found = found.select(F.lit(name).alias("shape"), "transaction_id", CFG.target)
        out = found if out is None else out.unionByName(found)
    return out


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """The five raw files of a data set: events, customers as cards and users, nations as codes."""
    folder = _folder(spark, "raw")
    money = F.concat(F.lit("$"), F.col("value").cast("string")).alias("amount")
    events = _events(spark, sf_dir)
    tx = events.select(F.col("event_id").alias("id"), F.col("user_id").alias("card_id"), F.col("user_id").alias("client_id"), money, F.pmod("event_id", F.lit(25)).cast("int").alias("mcc"))
    _write_csv(tx, join_path(folder, "transactions_data.csv"), "id")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    for name in ("cards_data.csv", "users_data.csv"):
        _write_csv(customers, join_path(folder, name), "id")
    codes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.struct(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value")).alias("m"))
    _documents(codes, join_path(folder, "mcc_codes.json"), F.to_json(F.map_from_entries(F.collect_list("m"))))
    label = F.struct(F.col("event_id").cast("string").alias("key"), F.col("event_type").isin("error").cast("string").alias("value"))
    labels = events.select(F.col("event_id").alias("id"), label.alias("m"))
    _documents(labels, join_path(folder, "train_fraud_labels.json"), F.to_json(F.struct(F.map_from_entries(F.collect_list("m")).alias("target"))))
    return folder


_COMPONENTS_SQL = """SELECT 'transactions' AS component, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events
    UNION ALL SELECT 'cards', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
    UNION ALL SELECT 'users', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
    UNION ALL SELECT 'mcc', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation
    UNION ALL SELECT 'labels', count(*), CAST(sum(event_id) AS BIGINT) FROM events"""


def _components(raw: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name in ("transactions", "cards", "users", "mcc", "labels"):
        key = F.col("key" if name in ("mcc", "labels") else "id").cast("long")
        own = raw[name].agg(F.count("*").alias("n_rows"), F.sum(key).alias("id_sum")).select(F.lit(name).alias("component"), "n_rows", "id_sum")
        out = own if out is None else out.unionByName(own)
    return out


@query("five_components", _COMPONENTS_SQL)
def _(spark, sf_dir):
    return _components(files.load_all(spark, _raw_folder(spark, sf_dir)))


@query("landed_components", _COMPONENTS_SQL)
def _(spark, sf_dir):
    """The same landed as Parquet first; a second landing keeps what is there."""
    folder, landed = _raw_folder(spark, sf_dir), _folder(spark, "landed")
    landing.land(spark, folder, landed)
    landing.land(spark, folder, landed)
    return _components(landing.load_landed(spark, landed))


@query(
    "labelled_raw_rows",
    f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id, {_FLAG_SQL} AS is_fraud, n_name AS mcc_description
    FROM events JOIN nation ON n_nationkey = event_id % 25""",
)
def _(spark, sf_dir):
    """Raw files to labelled rows with the description of their code."""
    raw = files.load_all(spark, _raw_folder(spark, sf_dir))
    tx = raw["transactions"].withColumn("transaction_id", F.col("id").cast("string")).withColumn("mcc", F.col("mcc").cast("string"))
    found = first_labelled(tx.select("transaction_id", "mcc", SOURCE_POS), labels_frame(raw["labels"], CFG), CFG)
    return found.join(code_frame(raw["mcc"]), "mcc").select("transaction_id", CFG.target, "mcc_description")
