"""Descriptions of tables and of the split."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import (
    CFG,
    ORDER_TX_SQL,
    TX_ROLES,
    TX_SQL,
    order_transactions,
    rounded,
    split_sql,
    stamp,
    table,
    transactions,
)
from catalog.registry import query
from riskloom.operators import profile as P
from riskloom.operators.history import behaviour_features, group_sizes, row_features
from riskloom.operators.split import split_bounds, split_summary, temporal_split


@query(
    "target_distribution",
    """SELECT coalesce(is_fraud, -1) AS is_fraud, count(*) AS "count", round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6)
    AS rate FROM (SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(event_type = 'error' AS INTEGER) END
    AS is_fraud FROM events) GROUP BY 1""",
)
def _(spark, sf_dir):
    known = F.when(F.col("_source_pos") % 11 != 0, F.col("is_fraud"))
    tx = transactions(spark, sf_dir).withColumn("is_fraud", known)
    shares = P.target_distribution(tx, "is_fraud")
    shown = shares.withColumn("is_fraud", F.coalesce("is_fraud", F.lit(-1)))
    return rounded(shown, ["rate"])


@query(
    "time_coverage",
    """SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS "min",
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS "max" FROM events""",
)
def _(spark, sf_dir):
    span = P.time_coverage(transactions(spark, sf_dir), "date")
    return span.select(stamp(F.col("min")).alias("min"), stamp(F.col("max")).alias("max"))


@query(
    "monthly_volume",
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS month,
    count(*) AS transactions, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) AS fraud_rate
    FROM orders GROUP BY 1""",
)
def _(spark, sf_dir):
    monthly = P.monthly_volume(order_transactions(spark, sf_dir), "date", "is_fraud")
    return rounded(monthly.withColumn("month", stamp(F.col("month"))), ["fraud_rate"])


@query(
    "column_quality",
    """SELECT 'transaction_id' AS "column", 0.0 AS missing_rate,
      count(DISTINCT event_id) AS nunique FROM events
    UNION ALL SELECT 'card_id', round(1 - count(c) / CAST(count(*) AS DOUBLE), 6), count(DISTINCT c)
      FROM (SELECT CASE WHEN event_id % 13 <> 0 THEN user_id END AS c FROM events)
    UNION ALL SELECT 'amount', round(1 - count(a) / CAST(count(*) AS DOUBLE), 6), count(DISTINCT a)
      FROM (SELECT CASE WHEN event_id % 4 <> 0 THEN value END AS a FROM events)
    UNION ALL SELECT 'use_chip', 0.0, count(DISTINCT event_type) FROM events""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir).select(
        "transaction_id",
        F.when(F.col("_source_pos") % 13 != 0, F.col("card_id")).alias("card_id"),
        F.when(F.col("_source_pos") % 4 != 0, F.col("amount")).alias("amount"),
        "use_chip",
    )
    return rounded(P.column_quality(tx), ["missing_rate"]).drop("dtype")


@query(
    "source_shapes",
    """SELECT 'transactions' AS source, count(*) AS "rows", 6 AS "columns" FROM events
    UNION ALL SELECT 'cards', count(*), 6 FROM orders
    UNION ALL SELECT 'users', count(*), 5 FROM customer
    UNION ALL SELECT 'mcc', count(*), 3 FROM nation""",
)
def _(spark, sf_dir):
    names = {"transactions": "events", "cards": "orders", "users": "customer", "mcc": "nation"}
    return P.source_shapes({k: table(spark, sf_dir, v) for k, v in names.items()})


@query(
    "split_summary",
    f"""WITH {ORDER_TX_SQL}, {split_sql('otx')}
    SELECT split, count(*) AS "rows", strftime(min(date), '%Y-%m-%d %H:%M:%S') AS start,
      strftime(max(date), '%Y-%m-%d %H:%M:%S') AS "end", round(avg(is_fraud), 6) AS positive_rate
    FROM parts GROUP BY split""",
)
def _(spark, sf_dir):
    parts = temporal_split(order_transactions(spark, sf_dir), CFG)
    summary = split_summary(parts, "date", "is_fraud")
    shown = summary.withColumns({"start": stamp(F.col("start")), "end": stamp(F.col("end"))})
    return rounded(shown, ["positive_rate"])


@query(
    "split_boundaries",
    f"""WITH {ORDER_TX_SQL}, {split_sql('otx')}
    SELECT 'validation' AS split, strftime(vb, '%Y-%m-%d %H:%M:%S') AS first_time FROM bounds
    UNION ALL SELECT 'test', strftime(tb, '%Y-%m-%d %H:%M:%S') FROM bounds""",
)
def _(spark, sf_dir):
    bounds = split_bounds(order_transactions(spark, sf_dir), CFG)
    # Two numbers found by the distributed order statistics become two rows.
    rows = [("validation", bounds.validation_micros), ("test", bounds.test_micros)]
    frame = spark.createDataFrame(rows, "split string, micros bigint")
    return frame.select("split", stamp(F.timestamp_micros("micros")).alias("first_time"))


@query(
    "temporal_split",
    f"""WITH {TX_SQL}, {split_sql('tx')} SELECT transaction_id, split FROM parts""",
)
def _(spark, sf_dir):
    return temporal_split(transactions(spark, sf_dir), CFG).select("transaction_id", "split")


@query(
    "missing_rates",
    """WITH w AS (SELECT row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
      FROM events)
    SELECT 'previous_amount' AS feature,
      round(avg(CASE WHEN k = 1 THEN 1.0 ELSE 0 END), 6) AS missing_rate FROM w
    UNION ALL SELECT 'amount_mean_5_prev', round(avg(CASE WHEN k = 1 THEN 1.0 ELSE 0 END), 6) FROM w
    UNION ALL SELECT 'amount_std_5_prev', round(avg(CASE WHEN k <= 2 THEN 1.0 ELSE 0 END), 6) FROM w
    UNION ALL SELECT 'amount_to_mean_5_prev',
      round(avg(CASE WHEN k = 1 THEN 1.0 ELSE 0 END), 6) FROM w
    UNION ALL SELECT 'transactions_seen_before', 0.0
    UNION ALL SELECT 'transaction_hour', 0.0 UNION ALL SELECT 'amount_log1p', 0.0""",
)
def _(spark, sf_dir):
    tx = row_features(transactions(spark, sf_dir), TX_ROLES)
    created = [
        "previous_amount",
        "amount_mean_5_prev",
        "amount_std_5_prev",
        "amount_to_mean_5_prev",
        "transactions_seen_before",
        "transaction_hour",
        "amount_log1p",
    ]
    features = behaviour_features(tx, TX_ROLES, CFG.limits)
    return rounded(P.missing_rates(features, created), ["missing_rate"])


@query("group_sizes", 'SELECT user_id AS card_id, count(*) AS "rows" FROM events GROUP BY user_id')
def _(spark, sf_dir):
    return group_sizes(transactions(spark, sf_dir), "card_id")
