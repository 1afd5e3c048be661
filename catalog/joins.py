"""Joins with labels and dimensions, set operations and key-based inserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import (
    CFG,
    ORDER_TX_SQL,
    order_transactions,
    rounded,
    split_sql,
    table,
    transactions,
)
from catalog.registry import query
from riskloom import config as C
from riskloom.operators.audit import shared_ids
from riskloom.operators.enrich import (
    join_codes,
    join_labels,
    labels_frame,
    left_join_dimension,
    supervised_table,
)
from riskloom.operators.split import temporal_split
from riskloom.plans.tracking import insert_if_absent, upsert_last
from riskloom.roles import SOURCE_POS


def _labels(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_id % 3 <> 0")
    return e.select(
        F.col("event_id").alias("ID"),
        F.when(F.col("event_type") == "error", "Yes").otherwise("No").alias("Target"),
    )


@query(
    "label_join",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id, value AS amount,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
    FROM events WHERE event_id % 3 <> 0""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir).select("transaction_id", "amount")
    return join_labels(tx, labels_frame(_labels(spark, sf_dir), CFG))


_CARDS_SQL = """cards AS (
  SELECT c_custkey AS id, c_nationkey AS client_id, c_mktsegment AS card_type FROM customer
  UNION ALL SELECT c_custkey, c_nationkey, 'second' FROM customer WHERE c_custkey % 10 = 0),
keyed AS (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS card_id, o_custkey AS client_id,
         o_totalprice AS amount FROM orders)"""


def _keyed_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")).alias("card_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_totalprice").alias("amount"),
    )


def _cards(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    card = [F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("client_id")]
    first = c.select(*card, F.col("c_mktsegment").alias("card_type"))
    second = c.filter("c_custkey % 10 = 0").select(*card, F.lit("second").alias("card_type"))
    return first.unionByName(second)


@query(
    "card_join",
    f"""WITH {_CARDS_SQL}
    SELECT card_type, coalesce(c.client_id, -1) AS client_id_card, count(*) AS n_rows,
      CAST(sum(k.client_id) AS BIGINT) AS client_sum, round(sum(amount), 2) AS amount_sum
    FROM keyed k LEFT JOIN cards c ON k.card_id IS NOT DISTINCT FROM c.id GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    joined = left_join_dimension(
        _keyed_orders(spark, sf_dir),
        _cards(spark, sf_dir),
        ("id", "card_id"),
        C.CARD_NAMES,
        "_card",
        CFG.limits,
    )
    shown = joined.withColumn("client_id_card", F.coalesce("client_id_card", F.lit(-1)))
    return shown.groupBy("card_type", "client_id_card").agg(
        F.count("*").alias("n_rows"),
        F.sum("client_id").alias("client_sum"),
        F.round(F.sum("amount"), 2).alias("amount_sum"),
    )


@query(
    "user_join",
    """SELECT c_mktsegment AS segment, count(*) AS n_rows, round(sum(o_totalprice), 2) AS amount_sum,
      round(sum(c_acctbal), 2) AS balance_sum
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0)
      ON o_custkey = c_custkey GROUP BY 1""",
)
def _(spark, sf_dir):
    users = (
        table(spark, sf_dir, "customer")
        .filter("c_custkey % 4 <> 0")
        .select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    )
    joined = left_join_dimension(
        _keyed_orders(spark, sf_dir),
        users,
        ("id", "client_id", "user_id", "customer_id"),
        C.USER_NAMES,
        "_user",
        CFG.limits,
    )
    return joined.groupBy("segment").agg(
        F.count("*").alias("n_rows"),
        F.round(F.sum("amount"), 2).alias("amount_sum"),
        F.round(F.sum("c_acctbal"), 2).alias("balance_sum"),
    )


@query(
    "code_join",
    """SELECT CAST(c_nationkey AS VARCHAR) AS mcc, n_name AS mcc_description, count(*) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 3) ON c_nationkey = n_nationkey
    GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    tx = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").alias("mcc"))
    codes = table(spark, sf_dir, "nation").filter("n_nationkey <> 3")
    named = codes.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("description"))
    return (
        join_codes(tx, named, CFG.limits)
        .groupBy("mcc", "mcc_description")
        .agg(F.count("*").alias("n_rows"))
    )


@query(
    "supervised_table",
    """SELECT c_mktsegment AS card_type, n_name AS mcc_description,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fraud, count(*) AS n_rows,
      round(sum(o_totalprice), 2) AS amount_sum
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderkey % 5 <> 0 GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    tx = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_totalprice").alias("amount"),
    )
    labels = o.filter("o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("target"),
    )
    cards = c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("card_type"),
        F.col("c_nationkey").alias("mcc"),
    )
    n = table(spark, sf_dir, "nation")
    codes = n.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("description"))
    wide = supervised_table(tx, labels, CFG, cards=cards, codes=codes)
    return wide.groupBy("card_type", "mcc_description", "is_fraud").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("amount"), 2).alias("amount_sum")
    )


_LINE_PARTS_SQL = f"""lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id, l_shipdate AS date FROM lineitem),
{split_sql('lines')}"""


def _line_parts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
    )
    return temporal_split(lines, CFG)


@query(
    "ids_shared_between_splits",
    f"""WITH {_LINE_PARTS_SQL}
    SELECT CAST(sum(k * (k - 1) / 2) AS BIGINT) AS shared_ids
    FROM (SELECT transaction_id, count(DISTINCT split) AS k FROM parts GROUP BY 1)""",
)
def _(spark, sf_dir):
    return shared_ids(_line_parts(spark, sf_dir), "transaction_id")


@query(
    "id_intersection",
    f"""WITH {_LINE_PARTS_SQL}
    SELECT transaction_id FROM parts WHERE split = 'train'
    INTERSECT SELECT transaction_id FROM parts WHERE split = 'test'""",
)
def _(spark, sf_dir):
    parts = _line_parts(spark, sf_dir)
    ids = {s: parts.filter(F.col("split") == s).select("transaction_id") for s in ("train", "test")}
    return ids["train"].intersect(ids["test"])


@query(
    "insert_if_absent",
    """SELECT origin, count(*) AS n_rows, CAST(sum(run_id) AS BIGINT) AS id_sum FROM (
      SELECT o_orderkey AS run_id, 'old' AS origin FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_orderkey, 'new' FROM orders
      WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F') GROUP BY origin""",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = o.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("run_id"), F.lit("old").alias("origin")
    )
    new = o.filter("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").alias("run_id"), F.lit("new").alias("origin")
    )
    rows = insert_if_absent(old, new, ["run_id"])
    return rows.groupBy("origin").agg(
        F.count("*").alias("n_rows"), F.sum("run_id").alias("id_sum")
    )


@query(
    "upsert_last_per_key",
    """SELECT run_id, order_key FROM (
      SELECT o_custkey AS run_id, o_orderkey AS order_key, row_number() OVER (
        PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END DESC, o_orderkey DESC) AS k
      FROM orders) WHERE k = 1""",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("order_key"), "o_orderstatus"
    )
    old, new = o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'")
    return upsert_last(old, new, "run_id", F.col("order_key")).select("run_id", "order_key")


@query(
    "union_with_history",
    f"""WITH {ORDER_TX_SQL}, {split_sql('otx')}
    SELECT is_history, count(*) AS n_rows, count(is_fraud) AS labelled,
      round(sum(amount), 2) AS amount_sum
    FROM (SELECT 1 AS is_history, NULL AS is_fraud, amount FROM parts WHERE split = 'train'
      UNION ALL SELECT 0, is_fraud, amount FROM parts WHERE split <> 'train') GROUP BY 1""",
)
def _(spark, sf_dir):
    parts = temporal_split(order_transactions(spark, sf_dir), CFG)
    past = parts.filter("split = 'train'").select("card_id", "date", "amount", SOURCE_POS)
    both = past.withColumn("is_history", F.lit(1)).unionByName(
        parts.filter("split <> 'train'").withColumn("is_history", F.lit(0)),
        allowMissingColumns=True,
    )
    return rounded(
        both.groupBy("is_history").agg(
            F.count("*").alias("n_rows"),
            F.count("is_fraud").alias("labelled"),
            F.sum("amount").alias("amount_sum"),
        ),
        ["amount_sum"],
        2,
    )
