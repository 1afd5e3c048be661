"""The driver tables read as card transactions, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.config import RiskConfig
from riskloom.operators.split import temporal_split
from riskloom.roles import SOURCE_POS, Roles

CFG = RiskConfig(max_rows=None)
TX_ROLES = Roles(time="date", amount="amount", group="card_id", transaction_id="transaction_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def stamp(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


# One transaction per event; failed events play the positive label.
TX_SQL = """tx AS (
  SELECT event_id AS pos, CAST(event_id AS VARCHAR) AS transaction_id, ts AS date,
         user_id AS card_id, user_id AS client_id, value AS amount, event_type AS use_chip,
         CAST(event_type = 'error' AS INTEGER) AS is_fraud
  FROM events)"""


def transactions(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """One transaction per event; ``more`` adds columns of the same scan."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias(SOURCE_POS),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("user_id").alias("card_id"),
        F.col("user_id").alias("client_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("use_chip"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
        *more,
    )


# Orders as transactions: many share one time.
ORDER_TX_SQL = """otx AS (
  SELECT o_orderkey AS pos, CAST(o_orderkey AS VARCHAR) AS transaction_id, o_orderdate AS date,
         o_custkey AS card_id, o_totalprice AS amount,
         CAST(o_orderstatus = 'F' AS INTEGER) AS is_fraud
  FROM orders)"""


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias(SOURCE_POS),
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_fraud"),
    )


def split_sql(source: str, time: str = "date") -> str:
    """CTEs ``bounds`` and ``parts`` (the source with its split)."""
    return f"""ranked_times AS (
  SELECT {time} AS t, row_number() OVER (ORDER BY {time}) - 1 AS k, count(*) OVER () AS n
  FROM {source} WHERE {time} IS NOT NULL),
bounds AS (
  SELECT max(CASE WHEN k = CAST(floor(n * (CAST(1 AS DOUBLE) - CAST(0.15 AS DOUBLE)
                                 - CAST(0.15 AS DOUBLE))) AS BIGINT) THEN t END) AS vb,
         max(CASE WHEN k = CAST(floor(n * (CAST(1 AS DOUBLE) - CAST(0.15 AS DOUBLE))) AS BIGINT)
             THEN t END) AS tb
  FROM ranked_times),
parts AS (
  SELECT s.*, CASE WHEN s.{time} < b.vb THEN 'train' WHEN s.{time} < b.tb THEN 'validation'
                   ELSE 'test' END AS split
  FROM {source} s, bounds b WHERE s.{time} IS NOT NULL)"""


# A score with many ties, exact in both engines.
SCORED_SQL = f"""{TX_SQL},
{split_sql('tx')},
scored AS (
  SELECT pos, split, use_chip, is_fraud, CAST((pos * 7919) % 1000 AS DOUBLE) / 1000 AS score
  FROM parts)"""


def tied_score(position: str = SOURCE_POS) -> Column:
    return F.pmod(F.col(position) * 7919, F.lit(1000)).cast("double") / 1000


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = temporal_split(transactions(spark, sf_dir), CFG)
    return parts.select(SOURCE_POS, "split", "use_chip", "is_fraud", tied_score().alias("score"))


# Distinct scores with the counts at and above each.
RANKED_SQL = f"""{SCORED_SQL},
counts AS (
  SELECT split, score, sum(is_fraud) AS pos_n, sum(1 - is_fraud) AS neg_n
  FROM scored GROUP BY split, score),
ranked AS (
  SELECT split, score, pos_n, neg_n,
         sum(pos_n) OVER w AS tp, sum(neg_n) OVER w AS fp,
         sum(pos_n) OVER w - pos_n AS tp_before
  FROM counts WINDOW w AS (PARTITION BY split ORDER BY score DESC)),
totals AS (SELECT split, sum(pos_n) AS p, sum(neg_n) AS n FROM counts GROUP BY split)"""

# Every threshold of the default grid with its outcomes per split.
GRID_SQL = f"""{SCORED_SQL},
grid AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM generate_series(8, 30) g(i)),
outcomes AS (
  SELECT s.split, g.threshold,
         count(*) FILTER (WHERE score >= threshold AND is_fraud = 1) AS tp,
         count(*) FILTER (WHERE score >= threshold AND is_fraud = 0) AS fp,
         count(*) FILTER (WHERE score < threshold AND is_fraud = 0) AS tn,
         count(*) FILTER (WHERE score < threshold AND is_fraud = 1) AS fn
  FROM scored s, grid g GROUP BY s.split, g.threshold)"""

RATIOS_SQL = """
  coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS precision,
  coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS recall,
  coalesce(2.0 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0) AS f1,
  coalesce(5.0 * tp / nullif(CAST(5 * tp + 4 * fn + fp AS DOUBLE), 0), 0) AS fbeta"""
