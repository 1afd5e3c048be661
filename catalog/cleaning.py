"""Headers, label and money text, dates, duplicates and row-wise features."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from catalog.domain import CFG, order_transactions, rounded, table, transactions
from catalog.registry import query
from riskloom.functions import cleaning as X
from riskloom.functions.features import amount_features, calendar_features
from riskloom.operators.cleaning import clean, first_per_key
from riskloom.operators.enrich import code_frame, keyed_transactions
from riskloom.operators.split import drop_missing_time
from riskloom.roles import normalize_headers


@query("normalize_headers", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return normalize_headers(e.toDF("Event-ID", " User ID ", "event-Type", "VALUE"))


_LABEL_TEXT = """CASE event_id % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'no'
  WHEN 3 THEN NULL WHEN 4 THEN 'Fraud' WHEN 5 THEN '1' WHEN 6 THEN '0' ELSE event_type END"""


@query(
    "label_flag",
    f"""SELECT label, count(*) AS n_rows, CAST(sum(flag) AS BIGINT) AS positives FROM (
    SELECT {_LABEL_TEXT} AS label, CASE WHEN lower(trim({_LABEL_TEXT})) IN
      ('1','true','yes','y','fraud','fraudulent') THEN 1 ELSE 0 END AS flag FROM events)
    GROUP BY label""",
)
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.expr(_LABEL_TEXT).alias("label"))
    flags = e.withColumn("flag", X.label_flag(F.col("label")))
    return flags.groupBy("label").agg(
        F.count("*").alias("n_rows"), F.sum("flag").alias("positives")
    )


@query(
    "code_dictionary",
    """SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS mcc, n_name AS mcc_description
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    used = c.join(n, c.c_nationkey == n.n_nationkey)
    return code_frame(used.select(F.col("n_nationkey").alias("Code"), F.col("n_name").alias("Name")))


@query(
    "key_as_text",
    "SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_totalprice AS amount FROM orders",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return keyed_transactions(
        o.select(F.col("o_orderkey").alias("ID"), F.col("o_totalprice").alias("Amount"))
    )


_MISSING_TEXT = """CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN 'None'
  WHEN 3 THEN 'none' ELSE event_type END"""


@query(
    "null_texts",
    f"""SELECT CASE WHEN t NOT IN ('', 'nan', 'None') THEN t END AS cleaned, count(*) AS n_rows
    FROM (SELECT {_MISSING_TEXT} AS t FROM events) GROUP BY 1""",
)
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.expr(_MISSING_TEXT).alias("t"))
    return e.groupBy(X.null_texts(F.col("t")).alias("cleaned")).agg(F.count("*").alias("n_rows"))


_MONEY_TEXT = """CASE o_orderkey % 7
  WHEN 0 THEN concat('$', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS {text}), ',',
                     lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS {text}), 3, '0'), '.50')
  WHEN 1 THEN concat('(', CAST(o_orderkey AS {text}), ')')
  WHEN 2 THEN concat('-$', CAST(o_orderkey AS {text}), '.25')
  WHEN 3 THEN '-' WHEN 4 THEN concat(CAST(o_orderkey AS {text}), ' USD')
  WHEN 5 THEN '1-2' ELSE NULL END"""


@query(
    "money_text",
    f"""SELECT o_orderkey AS order_key,
    TRY_CAST(regexp_replace({_MONEY_TEXT.format(text='VARCHAR')}, '[^0-9.\\-]', '', 'g') AS DOUBLE)
    AS amount FROM orders""",
)
def _(spark, sf_dir):
    text = F.expr(_MONEY_TEXT.format(text="STRING"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        X.parse_money(text, T.StringType()).alias("amount"),
    )


@query(
    "date_text",
    """SELECT strftime(coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%Y-%m-%d'),
      try_strptime(t, '%m/%Y'), try_strptime(t, '%m/%d/%Y')), '%Y-%m-%d') AS day,
      count(*) AS n_rows
    FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%m/%Y') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN 3 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS t
      FROM orders) GROUP BY 1""",
)
def _(spark, sf_dir):
    day = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "MM/yyyy"))
        .when(kind == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 3, F.lit("not a date"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    parsed = table(spark, sf_dir, "orders").select(text.alias("t")).select(
        F.date_format(X.parse_time(F.col("t"), T.StringType()), "yyyy-MM-dd").alias("day")
    )
    return parsed.groupBy("day").agg(F.count("*").alias("n_rows"))


_LINE_ORDER = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


@query(
    "first_per_transaction_id",
    f"""SELECT transaction_id, l_partkey, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {', '.join(_LINE_ORDER)}) AS k
    FROM (SELECT *, concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))
          AS transaction_id FROM lineitem)) WHERE k = 1""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "transaction_id", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    return first_per_key(lines, "transaction_id", _LINE_ORDER).select(
        "transaction_id", "l_partkey", "l_quantity"
    )


@query(
    "clean_transactions",
    """SELECT transaction_id, amount, is_fraud FROM (
      SELECT CAST(o_custkey AS VARCHAR) AS transaction_id,
        TRY_CAST(concat(CAST(o_orderkey AS VARCHAR), '.5') AS DOUBLE) AS amount,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fraud,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders)
    WHERE k = 1""",
)
def _(spark, sf_dir):
    o = order_transactions(spark, sf_dir)
    raw = o.select(
        F.col("card_id").cast("string").alias("Transaction ID"),
        F.concat(F.lit("$"), F.col("transaction_id"), F.lit(".5")).alias("Amount"),
        F.when(F.col("is_fraud") == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("Is-Fraud"),
        "_source_pos",
    )
    return clean(raw, CFG).select("transaction_id", "amount", "is_fraud")


@query(
    "calendar_features",
    """SELECT coalesce(CAST(hour(t) AS INTEGER), -1) AS transaction_hour,
      coalesce(CAST(isodow(t) - 1 AS INTEGER), -1) AS transaction_dayofweek,
      coalesce(CAST(month(t) AS INTEGER), -1) AS transaction_month,
      CASE WHEN isodow(t) >= 6 THEN 1 ELSE 0 END AS is_weekend,
      CASE WHEN hour(t) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night, count(*) AS n_rows
    FROM (SELECT CASE WHEN event_id % 50 <> 0 THEN ts END AS t FROM events)
    GROUP BY ALL""",
)
def _(spark, sf_dir):
    time = F.when(F.col("_source_pos") % 50 != 0, F.col("date"))
    features = transactions(spark, sf_dir).select(
        # -1 shows a missing time; whole numbers with gaps compare badly.
        *[F.coalesce(c, F.lit(-1)).alias(n) for n, c in calendar_features(time).items()]
    )
    return features.groupBy(*features.columns).agg(F.count("*").alias("n_rows"))


@query(
    "amount_features",
    """SELECT transaction_id, abs(a) AS amount_abs, round(ln(1 + abs(a)), 6) AS amount_log1p
    FROM (SELECT CAST(event_id AS VARCHAR) AS transaction_id,
          CASE WHEN event_id % 2 = 0 THEN -value ELSE value END AS a FROM events)""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    signed = F.when(F.col("_source_pos") % 2 == 0, -F.col("amount")).otherwise(F.col("amount"))
    features = tx.withColumns(amount_features(signed))
    return rounded(
        features.select("transaction_id", "amount_abs", "amount_log1p"), ["amount_log1p"]
    )


@query(
    "drop_missing_time",
    """SELECT event_type, count(*) AS n_rows FROM events WHERE event_id % 9 <> 0
    GROUP BY event_type""",
)
def _(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    timed = tx.withColumn("date", F.when(F.col("_source_pos") % 9 != 0, F.col("date")))
    return (
        drop_missing_time(timed, "date")
        .groupBy(F.col("use_chip").alias("event_type"))
        .agg(F.count("*").alias("n_rows"))
    )
