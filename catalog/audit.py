"""Order of the split and the leakage report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import (
    CFG,
    GRID_SQL,
    TX_SQL,
    scored,
    split_sql,
    stamp,
    table,
    transactions,
)
from catalog.registry import query
from riskloom.operators import audit as A
from riskloom.operators.metrics import ranked_scores, ranking_areas
from riskloom.operators.split import temporal_split
from riskloom.operators.thresholds import configured_table, lowest_cost_row
from riskloom.roles import columns_to_drop

_STAMPS = ("train_max", "validation_min", "validation_max", "test_min")


def _stamped(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_ORDER_SQL = f"""{TX_SQL}, {split_sql('tx')},
edges AS (SELECT max(date) FILTER (WHERE split = 'train') AS train_max,
  min(date) FILTER (WHERE split = 'validation') AS validation_min,
  max(date) FILTER (WHERE split = 'validation') AS validation_max,
  min(date) FILTER (WHERE split = 'test') AS test_min FROM parts)"""


@query(
    "temporal_order",
    f"""WITH {_ORDER_SQL}
    SELECT {', '.join(f'{_stamped(s)} AS {s}' for s in _STAMPS)},
      CAST(train_max < validation_min AND validation_max < test_min AS INTEGER) AS in_order
    FROM edges""",
)
def _(spark, sf_dir):
    parts = temporal_split(transactions(spark, sf_dir), CFG)
    order = A.temporal_order(parts, "date")
    return order.select(
        *[stamp(F.col(s)).alias(s) for s in _STAMPS],
        F.col("temporal_order_valid").cast("int").alias("in_order"),
    )


#: Training rows above which the audited run counts as bounded, and the ROC limit.
_BOUND, _AREA = 5_000, 0.45


@query(
    "leakage_report",
    f"""WITH {GRID_SQL}, areas AS (
      SELECT split, sum(neg_n * (tp_before + 0.5 * pos_n)) / CAST(sum(pos_n) * sum(neg_n) AS DOUBLE) AS a FROM (
        SELECT *, sum(pos_n) OVER (PARTITION BY split ORDER BY score DESC) - pos_n AS tp_before FROM (
          SELECT split, score, sum(is_fraud) AS pos_n, sum(1 - is_fraud) AS neg_n FROM scored GROUP BY split, score))
      GROUP BY split),
    chosen AS (SELECT threshold FROM outcomes WHERE split = 'validation' ORDER BY fp + 25 * fn, fn, fp, threshold DESC LIMIT 1),
    names AS (SELECT CASE column_name WHEN 'event_type' THEN 'errors' WHEN 'props' THEN 'card_on_dark_web' ELSE column_name END AS name
      FROM information_schema.columns WHERE table_name = 'events' AND column_name <> 'ts' AND NOT contains(column_name, '_id')),
    facts AS (SELECT (SELECT max(a) FROM areas WHERE split <> 'train') >= {_AREA} AS high_auc,
      (SELECT threshold FROM chosen) IN ((SELECT min(threshold) FROM grid), (SELECT max(threshold) FROM grid)) AS at_edge,
      (SELECT count(*) FROM parts WHERE split = 'train') > {_BOUND} AS bounded,
      (SELECT CAST(sum(k * (k - 1) / 2) AS BIGINT) FROM (
        SELECT pos % 4000 AS id, count(DISTINCT split) AS k FROM parts GROUP BY 1)) AS shared,
      (SELECT string_agg(name, ',' ORDER BY name) FROM names) AS selected,
      (SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM names WHERE name IN ('card_on_dark_web')) AS snapshot,
      (SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM names WHERE name IN ('errors')) AS post_event)
    SELECT CASE WHEN shared > 0 THEN 'fail' WHEN high_auc OR at_edge OR bounded OR snapshot <> '' OR post_event <> '' THEN 'warning' ELSE 'pass' END AS status,
      shared AS shared_ids, CAST(high_auc AS INTEGER) AS high_auc, CAST(at_edge AS INTEGER) AS at_edge, CAST(bounded AS INTEGER) AS limited,
      selected, snapshot, post_event,
      CAST(high_auc AS INTEGER) + CAST(at_edge AS INTEGER) + CAST(bounded AS INTEGER) + CAST(snapshot <> '' AS INTEGER) + CAST(post_event <> '' AS INTEGER) AS warnings
    FROM facts""",
)
def _(spark, sf_dir):
    """The audit of a run on the events: columns, ids, areas and threshold are the tables' own."""
    cfg = CFG.with_(strict_leakage=False, roc_auc_warning=_AREA)
    names = {"event_id": "transaction_id", "user_id": "card_id", "ts": "date", "event_type": "errors", "props": "card_on_dark_web"}
    raw = table(spark, sf_dir, "events").withColumnsRenamed(names)
    # ids that come again after some thousands of rows, so that parts share them
    again = raw.withColumns({"date": F.col("date").cast("timestamp"), "transaction_id": F.pmod("transaction_id", F.lit(4000))})
    parts = temporal_split(again, cfg)
    rated = scored(spark, sf_dir)
    ranked = ranked_scores(rated, ["split"], "is_fraud", "score", cfg.limits)
    areas = {r["split"]: r["roc_auc"] for r in ranking_areas(ranked, ["split"]).collect()}
    later = rated.filter("split <> 'train'")
    best = lowest_cost_row(configured_table(later, cfg, "is_fraud", "score")).first()
    rows = parts.filter("split = 'train'").count()
    cfg = cfg.with_(max_rows=_BOUND if rows > _BOUND else None)
    barred = {*columns_to_drop(parts.columns, cfg), "split"}
    facts = A.gather(
        parts,
        "date",
        "transaction_id",
        [c for c in parts.columns if c not in barred],
        validation_roc_auc=areas["validation"],
        test_roc_auc=areas["test"],
        threshold=float(best["threshold"]),
    )
    report = A.report_frame(spark, A.report(facts, cfg))
    return report.select(
        "status",
        F.col("checks.duplicate_transaction_ids_across_splits").alias("shared_ids"),
        F.col("checks.high_roc_auc_warning").cast("int").alias("high_auc"),
        F.col("checks.threshold_at_analysis_boundary").cast("int").alias("at_edge"),
        F.col("checks.limited_training_window").cast("int").alias("limited"),
        F.array_join("selected_input_columns", ",").alias("selected"),
        F.array_join("risk_columns.snapshot", ",").alias("snapshot"),
        F.array_join("risk_columns.post_event", ",").alias("post_event"),
        F.size("warnings").alias("warnings"),
    )
