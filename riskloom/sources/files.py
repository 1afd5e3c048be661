"""Read the raw CSV and JSON files, keeping their row order as a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom import config as C
from riskloom.roles import SOURCE_POS, normalized_name
from riskloom.session import join_path, path_exists
from riskloom.sources.json_files import read_json_object, read_labels
from riskloom.sources.positions import with_source_position

# Types of the known raw columns; any other column is text.
COLUMN_TYPES = {
    "id": "bigint",
    "client_id": "bigint",
    "card_id": "bigint",
    "merchant_id": "bigint",
    "zip": "double",
    "mcc": "int",
    "num_cards_issued": "int",
    "year_pin_last_changed": "int",
    "current_age": "int",
    "retirement_age": "int",
    "birth_year": "int",
    "birth_month": "int",
    "latitude": "double",
    "longitude": "double",
    "credit_score": "int",
    "num_credit_cards": "int",
    "cvv": "int",
    "card_number": "bigint",
}


# CSV texts read as missing.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def resolve(spark: SparkSession, directory: str, names: Sequence[str], required: bool) -> str | None:
    """Path of the first file name that exists."""
    for name in names:
        path = join_path(directory, name)
        if path_exists(spark, path):
            return path
    if required:
        raise FileNotFoundError(f"none of {list(names)} in {directory}")
    return None


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Without a schema, known columns get their known types, but for
    those that hold anything else: they stay text, so that no value is lost.

    ``infer`` reads the data once more to guess the types of the others. ``multi_line`` reads
    quoted line breaks; each file is then read by one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is None and infer:
        return _without_missing_texts(
            with_source_position(reader.option("inferSchema", True).csv(path))
        )
    if schema is None:
        names = reader.csv(path).columns
        texts = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)
        kinds = _kinds(_without_missing_texts(texts))
        fields = [T.StructField(n, T._parse_datatype_string(kinds.get(n, "string"))) for n in names]
        schema = T.StructType(fields)
    return _without_missing_texts(with_source_position(reader.schema(schema).csv(path)))


def _kinds(texts: DataFrame) -> dict[str, str]:
    """The known types of the columns whose values all have them; one pass over those columns."""
    known = {c: COLUMN_TYPES[normalized_name(c)] for c in texts.columns if normalized_name(c) in COLUMN_TYPES}
    if not known:
        return {}
    odd = [
        F.count_if(F.col(f"`{c}`").isNotNull() & F.trim(f"`{c}`").try_cast(kind).isNull()) for c, kind in known.items()
    ]
    counts = texts.select(*[f"`{c}`" for c in known]).agg(*odd).first()
    return {c: kind for (c, kind), n in zip(known.items(), counts, strict=True) if not n}


def _without_missing_texts(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")) for c in texts}
    )


def load_csv(
    spark: SparkSession, directory: str, names: Sequence[str], required: bool = True, **options
) -> DataFrame:
    path = resolve(spark, directory, names, required)
    if path is None:
        return spark.createDataFrame([], T.StructType([]))
    return read_csv(spark, path, **options)


def load_all(spark: SparkSession, directory: str, **csv_options) -> dict[str, DataFrame]:
    """The five raw tables; also registered as temporary views."""
    codes = resolve(spark, directory, C.MCC_FILES, required=False)
    labels = resolve(spark, directory, C.LABEL_FILES, required=True)
    no_codes = spark.createDataFrame([], "key string, value string")
    raw = {
        "transactions": load_csv(spark, directory, C.TRANSACTION_FILES, **csv_options),
        "cards": load_csv(spark, directory, C.CARD_FILES, required=False, **csv_options),
        "users": load_csv(spark, directory, C.USER_FILES, required=False, **csv_options),
        "mcc": read_json_object(spark, codes) if codes else no_codes,
        "labels": read_labels(spark, labels),
    }
    for name, df in raw.items():
        if df.columns:
            df.createOrReplaceTempView(name)
    return raw


def preview(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of a scan in source order."""
    return df.orderBy(SOURCE_POS).limit(rows)
