"""Land the raw files as Parquet tables, and say which expected files exist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom import config as C
from riskloom.session import join_path, path_exists
from riskloom.sources.files import read_csv
from riskloom.sources.json_files import read_json_object, read_labels

# Landed table per expected raw file.
TABLE_OF_FILE = {
    "transactions_data.csv": "transactions",
    "cards_data.csv": "cards",
    "users_data.csv": "users",
    "mcc_codes.json": "mcc",
    "train_fraud_labels.json": "labels",
}


@dataclass(frozen=True)
class Landed:
    imported: tuple[str, ...]
    skipped: tuple[str, ...]


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    if table == "mcc":
        return read_json_object(spark, path)
    if table == "labels":
        return read_labels(spark, path)
    return read_csv(spark, path)


def is_landed(spark: SparkSession, landing: str, table: str) -> bool:
    """A table counts only once its write was committed."""
    return path_exists(spark, join_path(landing, table, "_SUCCESS"))


def land(
    spark: SparkSession, raw_directory: str, landing: str, overwrite: bool = False
) -> Landed:
    """Write each expected file as a table; existing tables stay unless overwritten.

    If all are there and none is to be replaced, the raw folder is not touched.
    """
    existing = {t for t in TABLE_OF_FILE.values() if is_landed(spark, landing, t)}
    if not overwrite and len(existing) == len(TABLE_OF_FILE):
        return Landed((), tuple(TABLE_OF_FILE.values()))
    imported, skipped = [], []
    for file, table in TABLE_OF_FILE.items():
        source = join_path(raw_directory, file)
        if not path_exists(spark, source):
            continue
        if table in existing and not overwrite:
            skipped.append(table)
            continue
        _read(spark, source, table).write.mode("overwrite").parquet(join_path(landing, table))
        imported.append(table)
    return Landed(tuple(imported), tuple(skipped))


def load_landed(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """The landed tables, also as temporary views; absent optional ones are left out."""
    tables = {}
    for table in TABLE_OF_FILE.values():
        if is_landed(spark, landing, table):
            tables[table] = spark.read.parquet(join_path(landing, table))
            tables[table].createOrReplaceTempView(table)
    missing = {"transactions", "labels"} - set(tables)
    if missing:
        raise FileNotFoundError(f"not landed in {landing}: {sorted(missing)}")
    return tables


def file_status(spark: SparkSession, directory: str) -> DataFrame:
    """(file, exists, path) for the expected raw files."""
    rows = []
    for name in C.EXPECTED_FILES:
        path = join_path(directory, name)
        rows.append((name, path_exists(spark, path), path))
    return spark.createDataFrame(rows, "file string, exists boolean, path string")
