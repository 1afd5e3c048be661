"""Write the small reports of a run."""

from __future__ import annotations

import json
import math
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.operators.thresholds import TABLE_COLUMNS


def finite_or_null(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL, as JSON has neither."""
    columns: dict[str, Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            columns[f.name] = F.when(~F.isnan(c) & (F.abs(c) != math.inf), c)
    return df.withColumns(columns) if columns else df


def json_safe(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    return None if isinstance(value, float) and not math.isfinite(value) else value


def write_threshold_csv(validation: DataFrame, test: DataFrame, path: str) -> None:
    """Both threshold tables as one CSV. They have one row per grid point."""
    both = validation.unionByName(test).select(*TABLE_COLUMNS)
    both.coalesce(1).sortWithinPartitions(F.col("split").desc(), "threshold").write.mode(
        "overwrite"
    ).option("header", True).csv(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    finite_or_null(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def document_text(content: dict[str, Any]) -> str:
    return json.dumps(json_safe(content), default=str, allow_nan=False)


def write_document(spark: SparkSession, content: dict[str, Any], path: str) -> None:
    """One small JSON document, written through Spark so any file system works."""
    text = document_text(content)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()[0])
