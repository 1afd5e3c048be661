"""First-N and top-N selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import CFG, table, tied_score, transactions
from catalog.registry import query
from riskloom.operators.limits import earliest_rows, first_rows, riskiest_rows


@query(
    "first_rows_in_source_order",
    """SELECT order_key FROM (SELECT o_orderkey AS order_key, row_number() OVER (ORDER BY o_orderkey)
    AS k FROM orders) WHERE k <= 5000""",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    return first_rows(o, 5000, CFG.limits, "order_key")


@query(
    "earliest_rows",
    """SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 1000""",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("t")
    )
    rows = earliest_rows(o, 1000, "t", "order_key", CFG.limits)
    return rows.select("order_key", F.date_format("t", "yyyy-MM-dd").alias("day"))


@query(
    "riskiest_rows",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_id AS pos,
      CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000 AS fraud_score
    FROM events ORDER BY fraud_score DESC, pos LIMIT 20""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir).select(
        "transaction_id", F.col("_source_pos").alias("pos"), tied_score().alias("fraud_score")
    )
    return riskiest_rows(tx, 20, "fraud_score", "pos")
