"""Features that look back at earlier transactions of a card."""

from __future__ import annotations

from dataclasses import replace
from uuid import uuid4

from pyspark.sql import functions as F

from catalog.domain import (
    CFG,
    ORDER_TX_SQL,
    TX_ROLES,
    order_transactions,
    rounded,
    split_sql,
    transactions,
)
from catalog.registry import query
from riskloom.models.stages import HistoryFeaturesModel
from riskloom.operators.history import (
    BEHAVIOUR_COLUMNS,
    FeatureHistory,
    behaviour_features,
    history_rows,
    row_features,
)
from riskloom.operators.split import temporal_split
from riskloom.session import ensure_checkpoint_dir, join_path

# Missing amounts and a missing card are part of the input.
_GAPS_SQL = """gaps AS (
  SELECT event_id AS pos, ts AS date, CASE WHEN event_id % 17 <> 0 THEN user_id END AS card_id,
         CASE WHEN event_id % 19 <> 0 THEN value END AS amount FROM events)"""
_WINDOW_SQL = """WINDOW w AS (PARTITION BY card_id ORDER BY date, pos),
  r AS (PARTITION BY card_id ORDER BY date, pos ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"""


def _gaps(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    pos = F.col("_source_pos")
    return tx.withColumns(
        {
            "card_id": F.when(pos % 17 != 0, F.col("card_id")),
            "amount": F.when(pos % 19 != 0, F.col("amount")),
        }
    ).select("_source_pos", "date", "card_id", "amount")


def _feature(spark, sf_dir, name, digits=6):
    df = behaviour_features(_gaps(spark, sf_dir), TX_ROLES, CFG.limits)
    out = df.select(F.col("_source_pos").alias("pos"), name)
    return out if name == "transactions_seen_before" else rounded(out, [name], digits)


@query(
    "previous_amount",
    f"""WITH {_GAPS_SQL} SELECT pos, round(lag(amount) OVER w, 6) AS previous_amount
    FROM gaps {_WINDOW_SQL}""",
)
def _(spark, sf_dir):
    return _feature(spark, sf_dir, "previous_amount")


@query(
    "amount_mean_5_prev",
    f"""WITH {_GAPS_SQL} SELECT pos, round(avg(amount) OVER r, 6) AS amount_mean_5_prev
    FROM gaps {_WINDOW_SQL}""",
)
def _(spark, sf_dir):
    return _feature(spark, sf_dir, "amount_mean_5_prev")


@query(
    "amount_std_5_prev",
    f"""WITH {_GAPS_SQL} SELECT pos, round(stddev_samp(amount) OVER r, 4) AS amount_std_5_prev
    FROM gaps {_WINDOW_SQL}""",
)
def _(spark, sf_dir):
    return _feature(spark, sf_dir, "amount_std_5_prev", 4)


@query(
    "transactions_seen_before",
    f"""WITH {_GAPS_SQL} SELECT pos, row_number() OVER w - 1 AS transactions_seen_before
    FROM gaps {_WINDOW_SQL}""",
)
def _(spark, sf_dir):
    return _feature(spark, sf_dir, "transactions_seen_before")


@query(
    "amount_to_mean_5_prev",
    f"""WITH {_GAPS_SQL} SELECT pos,
      round(amount / nullif(avg(amount) OVER r, 0), 6) AS amount_to_mean_5_prev
    FROM gaps {_WINDOW_SQL}""",
)
def _(spark, sf_dir):
    return _feature(spark, sf_dir, "amount_to_mean_5_prev")


_FEATURES_SQL = """round(lag(amount) OVER w, 6) AS previous_amount,
  round(avg(amount) OVER r, 6) AS amount_mean_5_prev,
  round(stddev_samp(amount) OVER r, 4) AS amount_std_5_prev,
  row_number() OVER w - 1 AS transactions_seen_before,
  round(amount / nullif(avg(amount) OVER r, 0), 6) AS amount_to_mean_5_prev"""


def _shown(df):
    out = rounded(
        df.select(F.col("_source_pos").alias("pos"), *BEHAVIOUR_COLUMNS),
        ["previous_amount", "amount_mean_5_prev", "amount_to_mean_5_prev"],
    )
    return rounded(out, ["amount_std_5_prev"], 4)


@query(
    "features_with_training_history",
    f"""WITH {ORDER_TX_SQL}, {split_sql('otx')},
    f AS (SELECT pos, split, {_FEATURES_SQL} FROM parts WHERE split <> 'test'
      WINDOW w AS (PARTITION BY card_id ORDER BY date, CAST(split = 'train' AS INTEGER), pos),
      r AS (PARTITION BY card_id ORDER BY date, CAST(split = 'train' AS INTEGER), pos
            ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
    SELECT * EXCLUDE (split) FROM f WHERE split = 'validation'""",
)
def _(spark, sf_dir):
    """Validation rows looking back at training rows, kept as 5 rows per card."""
    parts = temporal_split(order_transactions(spark, sf_dir), CFG)
    history = FeatureHistory.of(parts.filter("split = 'train'"), TX_ROLES)
    current = parts.filter("split = 'validation'").drop("split")
    past = history.for_batch(current, TX_ROLES, CFG.limits)
    return _shown(behaviour_features(current, TX_ROLES, CFG.limits, past))


_OVERLAPPING_SQL = f"""WITH {ORDER_TX_SQL},
    f AS (SELECT pos, pos % 2 AS past, {_FEATURES_SQL} FROM otx
      WINDOW w AS (PARTITION BY card_id ORDER BY date, pos % 2, pos),
      r AS (PARTITION BY card_id ORDER BY date, pos % 2, pos
            ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
    SELECT * EXCLUDE (past) FROM f WHERE past = 0"""


@query("features_with_overlapping_history", _OVERLAPPING_SQL)
def _(spark, sf_dir):
    """Odd orders are history of the even ones; at equal times current rows come first."""
    tx = order_transactions(spark, sf_dir)
    past = history_rows(tx.filter("_source_pos % 2 = 1"), TX_ROLES)
    current = tx.filter("_source_pos % 2 = 0")
    return _shown(behaviour_features(current, TX_ROLES, CFG.limits, past))


@query("features_with_saved_history", _OVERLAPPING_SQL)
def _(spark, sf_dir):
    """The same from a saved history in buckets: whole for cards with late rows, compact for others."""
    tx = order_transactions(spark, sf_dir)
    cfg = CFG.with_(limits=replace(CFG.limits, history_bucket_rows=1_000))
    stage = HistoryFeaturesModel(cfg, TX_ROLES, FeatureHistory.of(tx.filter("_source_pos % 2 = 1"), TX_ROLES))
    path = join_path(ensure_checkpoint_dir(spark), f"history-{uuid4().hex}")
    stage.write().save(path)
    return _shown(HistoryFeaturesModel.load(path).transform(tx.filter("_source_pos % 2 = 0")))


@query(
    "supervised_features",
    f"""WITH {_GAPS_SQL},
    f AS (SELECT pos, CAST(hour(date) AS INTEGER) AS transaction_hour,
      CAST(isodow(date) - 1 AS INTEGER) AS transaction_dayofweek,
      CASE WHEN hour(date) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night,
      round(ln(1 + abs(amount)), 6) AS amount_log1p, {_FEATURES_SQL} FROM gaps {_WINDOW_SQL})
    SELECT * FROM f""",
)
def supervised_features(spark, sf_dir):
    df = behaviour_features(row_features(_gaps(spark, sf_dir), TX_ROLES), TX_ROLES, CFG.limits)
    extra = ["transaction_hour", "transaction_dayofweek", "is_night", "amount_log1p"]
    out = rounded(
        df.select(F.col("_source_pos").alias("pos"), *extra, *BEHAVIOUR_COLUMNS),
        ["amount_log1p", "previous_amount", "amount_mean_5_prev", "amount_to_mean_5_prev"],
    )
    return rounded(out, ["amount_std_5_prev"], 4)
