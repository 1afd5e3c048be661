"""Column naming: header normalization and logical roles, resolved on the schema."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from riskloom import config as C
from riskloom.config import RiskConfig

# Working columns of this package; never model inputs.
SOURCE_POS = "_source_pos"
MATCH_POS = "_match_pos"
ORIGINAL = "_original"
WEIGHT = "_weight"
LABEL = "_label"
SPLIT = "split"
RESERVED = frozenset({SOURCE_POS, MATCH_POS, ORIGINAL, WEIGHT, LABEL, SPLIT})

# Columns a model must never see, whatever their content.
RAW_ID_NAMES = frozenset(
    {
        "id",
        "transaction_id",
        "client_id",
        "user_id",
        "customer_id",
        "card_id",
        "card_number",
        "account_number",
        "merchant_id",
    }
)
SENSITIVE_NAMES = frozenset({"address", "card_number", "cvv"})
# Attributes without history, dropped in strict mode.
SNAPSHOT_NAMES = frozenset(
    {
        "card_on_dark_web",
        "credit_limit",
        "credit_score",
        "current_age",
        "num_cards_issued",
        "num_credit_cards",
        "per_capita_income",
        "retirement_age",
        "total_debt",
        "year_pin_last_changed",
        "yearly_income",
    }
)
POST_EVENT_NAMES = frozenset({"errors"})
TEMPORAL_MARKS = ("date", "timestamp", "datetime", "expires", "acct_open")
PARSED_DATE_MARKS = ("date", "time", "expires", "acct_open")


def normalized_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trim and lower-case the headers; spaces and hyphens become underscores."""
    names = [normalized_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"headers are equal after normalization: {twice}")
    return df.toDF(*names)


def first_present(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    present = set(columns)
    return next((c for c in candidates if c in present), None)


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; ``None`` where the table has none."""

    time: str | None
    amount: str | None
    group: str | None
    transaction_id: str | None

    @classmethod
    def of(cls, columns: Iterable[str]) -> "Roles":
        names = list(columns)
        card = first_present(names, C.CARD_NAMES)
        return cls(
            time=first_present(names, C.TIME_NAMES),
            amount=first_present(names, C.AMOUNT_NAMES),
            group=card or first_present(names, C.USER_NAMES),
            transaction_id=first_present(names, C.CLEAN_ID_NAMES),
        )


def columns_to_drop(columns: Iterable[str], cfg: RiskConfig) -> list[str]:
    """Columns that may not become model inputs, sorted by name.

    The resolved time column is always among them, even when it is plainly
    called ``time`` and carries none of the temporal name marks.
    """
    names = list(columns)
    time = Roles.of(names).time
    barred = {cfg.target} | RAW_ID_NAMES | SENSITIVE_NAMES
    if cfg.strict_leakage:
        barred |= SNAPSHOT_NAMES | POST_EVENT_NAMES

    def is_barred(name: str) -> bool:
        low = name.lower()
        return (
            name == time
            or low in barred
            or low.endswith("_id")
            or "_id_" in low
            or any(mark in low for mark in TEMPORAL_MARKS)
        )

    return sorted({n for n in names if is_barred(n)})


@dataclass(frozen=True)
class FeatureGroups:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    dropped: tuple[str, ...]

    def sizes(self) -> dict[str, int]:
        return {
            "numeric": len(self.numeric),
            "categorical": len(self.categorical),
            "drop": len(self.dropped),
        }


def feature_groups(schema: T.StructType, cfg: RiskConfig) -> FeatureGroups:
    """Divide the model inputs by type; numbers and booleans are numeric."""
    dropped = columns_to_drop(schema.names, cfg)
    kept = [f for f in schema.fields if f.name not in RESERVED.union(dropped)]
    numeric = tuple(
        f.name for f in kept if isinstance(f.dataType, (T.NumericType, T.BooleanType))
    )
    categorical = tuple(f.name for f in kept if f.name not in set(numeric))
    return FeatureGroups(numeric, categorical, tuple(dropped))
