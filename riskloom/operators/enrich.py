"""Join raw transactions with labels and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom import config as C
from riskloom.config import RiskConfig, ScaleLimits
from riskloom.functions.cleaning import label_flag
from riskloom.operators.cleaning import first_per_key
from riskloom.roles import MATCH_POS, SOURCE_POS, first_present, normalize_headers
from riskloom.session import pin


# Key columns of the dimensions, first match wins.
CARD_KEYS = ("id", "card_id")
USER_KEYS = ("id", "client_id", "user_id", "customer_id")


def fits_broadcast(df: DataFrame, limits: ScaleLimits) -> bool:
    """Whether the rows of ``df`` and their bytes are few; no more than the bound is counted."""
    few = df.limit(limits.broadcast_rows + 1)
    texts = [F.octet_length(F.col(f"`{n}`")) for n, kind in df.dtypes if kind == "string"]
    width = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(16 * len(df.columns)))
    rows, size = few.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= limits.broadcast_rows and size <= limits.broadcast_bytes


def sized_broadcast(df: DataFrame, limits: ScaleLimits) -> DataFrame:
    """Mark ``df`` for broadcast if it fits; else leave the choice to Spark."""
    return F.broadcast(df) if fits_broadcast(df, limits) else df


def is_empty(df: DataFrame | None) -> bool:
    return df is None or not df.columns or df.isEmpty()


def _unnest(df: DataFrame, keep: str | None = None) -> DataFrame:
    """Rows of a one-object source: a map becomes key/value, an array its records."""
    chosen = keep if keep in df.columns else df.columns[0]
    kind = df.schema[chosen].dataType
    if isinstance(kind, T.MapType):
        return df.select(F.explode(F.col(chosen)).alias("key", "value"))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return df.select(F.inline(F.col(chosen)))
    return df


def labels_frame(labels: DataFrame, cfg: RiskConfig) -> DataFrame:
    """(transaction_id, flag) from a map, a ``target`` map, or records.

    Records name the id by the usual candidates, else it is the first column;
    the flag by its usual names, else it is the last column.
    """
    rows = normalize_headers(_unnest(labels, "target"))
    position = [SOURCE_POS] if SOURCE_POS in rows.columns else []
    names = [c for c in rows.columns if c != SOURCE_POS]
    key = first_present(names, C.TRANSACTION_ID_NAMES) or names[0]
    flag = first_present(names, (cfg.target, "target", "fraud")) or names[-1]
    return rows.select(
        F.col(key).cast("string").alias("transaction_id"),
        label_flag(F.col(flag)).alias(cfg.target),
        *position,
    )


def code_frame(codes: DataFrame) -> DataFrame:
    """Distinct (mcc, mcc_description) from a map or records."""
    rows = normalize_headers(_unnest(codes))
    names = [c for c in rows.columns if c != SOURCE_POS]
    code = first_present(names, ("mcc", "code", "mcc_code", "key"))
    text = first_present(names, ("description", "mcc_description", "name", "value"))
    if code is None or text is None:
        raise ValueError(f"no code and description among {names}")
    return rows.select(
        F.col(code).cast("string").alias("mcc"), F.col(text).alias("mcc_description")
    ).distinct()


def keyed_transactions(transactions: DataFrame) -> DataFrame:
    """Normalized headers, with the id column renamed and cast to text."""
    tx = normalize_headers(transactions)
    key = first_present(tx.columns, C.TRANSACTION_ID_NAMES)
    if key is None:
        raise ValueError("transactions have no id column")
    return tx.withColumnRenamed(key, "transaction_id").withColumn(
        "transaction_id", F.col("transaction_id").cast("string")
    )


def join_labels(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Keep the labelled transactions. Both sides are large: a shuffle join."""
    side = labels.withColumnRenamed(SOURCE_POS, "_label_pos")
    return tx.join(side, "transaction_id", "inner")


def left_join_dimension(
    tx: DataFrame,
    dimension: DataFrame | None,
    key_names: Sequence[str],
    tx_key_names: Sequence[str],
    suffix: str,
    limits: ScaleLimits,
    first_match: bool = False,
) -> DataFrame:
    """Add the dimension's columns; names already taken get ``suffix``.

    Missing keys match missing keys. Repeated keys repeat the transaction, unless
    ``first_match`` keeps only the first row per key. Nothing happens if the table
    is empty or a key is absent.
    """
    found = _side(dimension, key_names, tx.columns, tx_key_names, suffix, first_match)
    if found is None:
        return tx
    side, tx_key = found
    return _with_side(tx, sized_broadcast(side, limits), tx_key)


def _side(
    dimension: DataFrame | None,
    key_names: Sequence[str],
    columns: Sequence[str],
    tx_key_names: Sequence[str],
    suffix: str,
    first_match: bool,
) -> tuple[DataFrame, str] | None:
    """The dimension with its key as ``_dim_key`` and names that are free beside ``columns``,
    and the column it is joined to."""
    if is_empty(dimension):
        return None
    dim = normalize_headers(dimension)
    key = first_present(dim.columns, key_names)
    tx_key = first_present(columns, tx_key_names)
    if key is None or tx_key is None:
        return None
    taken = set(columns)
    renamed = [F.col(c).alias(_dimension_name(c, taken, suffix)) for c in dim.columns if c != key]
    side = dim.select(F.col(key).alias("_dim_key"), *renamed)
    return (first_per_key(side, "_dim_key", _match_order(side)) if first_match else side), tx_key


def _with_side(tx: DataFrame, side: DataFrame, tx_key: str) -> DataFrame:
    left, right = tx[tx_key], side["_dim_key"]
    if dict(tx.dtypes)[tx_key] != dict(side.dtypes)["_dim_key"]:
        left, right = left.cast("string"), right.cast("string")  # a text id beside a number
    return tx.join(side, left.eqNullSafe(right), "left").drop("_dim_key")


def _match_order(side: DataFrame) -> list[str]:
    """The position column if there is one, else all columns, to make "first" definite."""
    positions = [c for c in side.columns if c.startswith(SOURCE_POS)]
    return positions or [c for c in side.columns if c != "_dim_key"] or ["_dim_key"]


def _dimension_name(column: str, taken: set[str], suffix: str) -> str:
    if column == SOURCE_POS:
        return f"{SOURCE_POS}{suffix}"
    return f"{column}{suffix}" if column in taken else column


def join_codes(
    tx: DataFrame, codes: DataFrame | None, limits: ScaleLimits, first_match: bool = False
) -> DataFrame:
    """Add ``mcc_description`` by the text form of the code; with ``first_match`` the smallest
    of several descriptions, so that no row is repeated."""
    if is_empty(codes) or "mcc" not in tx.columns:
        return tx
    side = code_frame(codes)
    if first_match:
        side = side.groupBy("mcc").agg(F.min("mcc_description").alias("mcc_description"))
    side = sized_broadcast(side, limits)
    return tx.withColumn("mcc", F.col("mcc").cast("string")).join(side, "mcc", "left")


def supervised_table(
    transactions: DataFrame,
    labels: DataFrame,
    cfg: RiskConfig,
    cards: DataFrame | None = None,
    users: DataFrame | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """One wide row per labelled transaction."""
    joined = join_labels(keyed_transactions(transactions), labels_frame(labels, cfg))
    return enrich(joined, cfg, cards, users, codes)


def first_labelled(tx: DataFrame, labels: DataFrame, cfg: RiskConfig) -> DataFrame:
    """The labelled transactions, only the first of each id.

    Both sides are reduced by id and then joined by id, so wide rows are shuffled
    once. The result equals joining first and dropping repeated ids afterwards.
    """
    first = first_per_key(tx, "transaction_id", [SOURCE_POS])
    order = [SOURCE_POS] if SOURCE_POS in labels.columns else [cfg.target]
    side = first_per_key(labels, "transaction_id", order).drop(SOURCE_POS)
    return first.join(side, "transaction_id", "inner")


def enrich(
    tx: DataFrame,
    cfg: RiskConfig,
    cards: DataFrame | None = None,
    users: DataFrame | None = None,
    codes: DataFrame | None = None,
    first_match: bool = False,
    row_key: str | None = None,
) -> DataFrame:
    """The dimension joins alone, as needed when scoring unlabelled rows.

    ``row_key`` names a column without repeated or missing values. With it, and first matches,
    dimensions too large for a broadcast are looked up by rows of keys only, so the wide rows
    are shuffled once, by ``row_key``, however many such dimensions there are.
    """
    sides = []
    columns = list(tx.columns)
    for dimension, key_names, tx_key_names, suffix in (
        (cards, CARD_KEYS, C.CARD_NAMES, "_card"),
        (users, USER_KEYS, C.USER_NAMES, "_user"),
    ):
        found = _side(dimension, key_names, columns, tx_key_names, suffix, first_match)
        if found is not None:
            sides.append((*found, fits_broadcast(found[0], cfg.limits)))
            columns += [c for c in found[0].columns if c != "_dim_key"]
    wide = tx
    if first_match and row_key is not None and not all(small for *_, small in sides):
        if row_key == SOURCE_POS:
            # Read twice below, and a position may be no more than a row's place in a scan.
            wide = tx = pin(tx)
        keys = dict.fromkeys(k for _, k, _ in sides if k in tx.columns)
        resolved = tx.select(F.col(row_key).alias("_row_key"), *keys)
        for side, tx_key, small in sides:
            resolved = _with_side(resolved, F.broadcast(side) if small else side, tx_key)
        resolved = resolved.drop(*keys)
        wide = tx.join(resolved, F.col(row_key) == F.col("_row_key"), "left").drop("_row_key")
    else:
        for side, tx_key, small in sides:
            wide = _with_side(wide, F.broadcast(side) if small else side, tx_key)
    wide = join_codes(wide, codes, cfg.limits, first_match)
    return _fold_positions(wide)


def _fold_positions(df: DataFrame) -> DataFrame:
    """Gather the match positions, so that "first" is defined among repeated matches."""
    parts = ("_label_pos", f"{SOURCE_POS}_card", f"{SOURCE_POS}_user")
    present = [p for p in parts if p in df.columns]
    if not present:
        return df
    return df.withColumn(MATCH_POS, F.struct(*present)).drop(*present)
