"""Per-card history features from strictly earlier rows, safe against huge cards."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.config import ScaleLimits
from riskloom.functions.features import amount_features, calendar_features
from riskloom.operators.enrich import sized_broadcast
from riskloom.operators.ordering import cut_slices, slice_edges
from riskloom.roles import SOURCE_POS, Roles
from riskloom.session import pin

# The features look at this many earlier rows.
LOOKBACK = 5
BEHAVIOUR_COLUMNS = (
    "previous_amount",
    "amount_mean_5_prev",
    "amount_std_5_prev",
    "transactions_seen_before",
    "amount_to_mean_5_prev",
)

# Working columns. A context row stands for earlier rows of its group; only the
# oldest one of a group stands for more than itself.
_PAST = "_is_history"
_STANDS_FOR = "_stands_for"
_SLICE = "_time_slice"
_TIE = "_tie_slice"
_HEAD = "_is_context"
_WORK = (_PAST, _STANDS_FOR, _SLICE, _TIE, _HEAD)


def row_features(df: DataFrame, roles: Roles) -> DataFrame:
    """Calendar and amount features, wherever the table has the column."""
    columns: dict[str, Column] = {}
    if roles.time:
        columns |= calendar_features(F.col(roles.time).cast("timestamp"))
    if roles.amount:
        columns |= amount_features(F.col(roles.amount))
    return df.withColumns(columns) if columns else df


def all_features(
    current: DataFrame, roles: Roles, limits: ScaleLimits, history: DataFrame | None = None
) -> DataFrame:
    """``row_features`` and ``behaviour_features``, in this order of columns.

    The look-back comes first, so what each row tells by itself, and all the more for rows of
    the history, is not carried through its shuffle and sort.
    """
    looked_back = behaviour_features(current, roles, limits, history)
    own = row_features(current, roles).columns
    names = [*own, *[c for c in looked_back.columns if c not in own]]
    return row_features(looked_back, roles).select(*[f"`{n}`" for n in names])


@dataclass(frozen=True)
class FeatureHistory:
    """Training rows that later rows may look back at.

    ``buckets`` is set where both tables have the column BUCKET and a folder for each of its
    values, so that a batch reads only the buckets of its own groups.
    """

    rows: DataFrame
    compact: DataFrame
    last_micros: int | None
    has_missing_time: bool = False
    buckets: int = 0

    @classmethod
    def of(cls, train: DataFrame, roles: Roles) -> "FeatureHistory":
        kept = history_rows(train, roles)
        at = _micros(F.col(roles.time))
        last, missing = kept.agg(F.max(at), F.count_if(at.isNull())).first()
        return cls(kept, compact_history(kept, roles), last, missing > 0)

    def for_batch(self, current: DataFrame, roles: Roles, limits: ScaleLimits) -> DataFrame:
        """What the rows of ``current`` have to look back at.

        Groups whose current rows are all later than their own history get its compact form,
        the others all of it. If the batch has few groups, the buckets of those are read and
        nothing else is shuffled.
        """
        kind = self.rows.schema[roles.group].dataType.simpleString()
        group = F.col(roles.group).try_cast(kind)
        at = _micros(F.col(roles.time))
        seen = pin(current.groupBy(group.alias("_group")).agg(F.min(at).alias("_first")))
        compact = self.compact
        if few := _at_most(seen, limits.broadcast_rows):
            compact = self._of_groups(compact, seen, roles)
        if not self.has_missing_time:
            first = seen.agg(F.min("_first")).first()[0]
            if self.last_micros is None or first is None or first > self.last_micros:
                return compact.drop(BUCKET)
        same = F.col(roles.group).eqNullSafe(F.col("_group"))
        own = compact.groupBy(roles.group).agg(F.max(at).alias("_last"), F.count_if(at.isNull()).alias("_timeless"))
        overlapping = (F.col("_timeless") > 0) | (F.col("_first") <= F.col("_last"))
        late = pin(own.join(F.broadcast(seen) if few else seen, same).filter(overlapping).select("_group"))
        if late.isEmpty():
            return compact.drop(BUCKET)
        one = F.lit(1).cast("bigint")
        if _at_most(late, limits.broadcast_rows):
            whole, late = self._of_groups(self.rows, late, roles), F.broadcast(late)
        else:
            whole = self.rows.join(late, same, "left_semi")
        rest = compact.join(late, same, "left_anti")
        return whole.withColumn(_STANDS_FOR, one).unionByName(rest).drop(BUCKET)

    def _of_groups(self, history: DataFrame, groups: DataFrame, roles: Roles) -> DataFrame:
        """The history of few groups; of a bucketed table only their folders are read."""
        if self.buckets:
            # At most one number per bucket.
            used = groups.select(bucket_of(F.col("_group"), self.buckets).alias("b")).distinct().collect()
            history = history.filter(F.col(BUCKET).isin([r["b"] for r in used]))
        return history.join(F.broadcast(groups), F.col(roles.group).eqNullSafe(F.col("_group")), "left_semi")


BUCKET = "_bucket"


def _at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def bucket_of(group: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(group), F.lit(buckets)).cast("int")


def bucket_count(rows: int, limits: ScaleLimits) -> int:
    return max(1, min(limits.max_history_buckets, math.ceil(rows / limits.history_bucket_rows)))


def in_buckets(history: DataFrame, roles: Roles, buckets: int, limits: ScaleLimits) -> DataFrame:
    """``history`` with the column BUCKET, dealt out for a write with a folder per bucket.

    Within a file groups lie together, so that statistics tell which parts hold one. A bucket
    that a hot group overfills is dealt to several tasks.
    """
    marked = history.withColumn(BUCKET, bucket_of(F.col(roles.group), buckets))
    # At most one row per bucket.
    sizes = marked.groupBy(BUCKET).agg(F.count("*").alias("n")).filter(F.col("n") > limits.history_bucket_rows)
    shares = {r[BUCKET]: math.ceil(r["n"] / limits.history_bucket_rows) for r in sizes.collect()}
    share = F.lit(0)
    if shares:
        pairs = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        share = F.coalesce(F.pmod(F.xxhash64(SOURCE_POS), pairs[F.col(BUCKET)]), F.lit(0))
    return marked.repartition(F.col(BUCKET), share).sortWithinPartitions(BUCKET, roles.group)


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def history_rows(train: DataFrame, roles: Roles) -> DataFrame:
    """The columns of the training rows that the features need, and no others."""
    return train.select(
        F.col(roles.group), F.col(roles.time), F.col(roles.amount), F.col(SOURCE_POS)
    )


def compact_history(history: DataFrame, roles: Roles) -> DataFrame:
    """The last rows of each group, and one row standing for all rows before them.

    The stand-in lies just outside the look-back of any later row, so its missing
    amount is never seen; only its count is. Gives the same features as the whole
    history to rows later than all of it. Both parts shrink before the shuffle.
    """
    newest_first = Window.partitionBy(roles.group).orderBy(
        F.col(roles.time).desc_nulls_first(), F.col(SOURCE_POS).desc()
    )
    one = F.lit(1).cast("bigint")
    last = (
        history.withColumn("_back", F.row_number().over(newest_first))
        .filter(F.col("_back") <= LOOKBACK)
        .select(*history.columns, one.alias(_STANDS_FOR))
    )
    rest = (
        history.groupBy(roles.group)
        .agg(
            F.min(roles.time).alias(roles.time),
            F.min(SOURCE_POS).alias(SOURCE_POS),
            (F.count("*") - LOOKBACK).alias(_STANDS_FOR),
        )
        .filter(F.col(_STANDS_FOR) > 0)
        .withColumn(roles.amount, F.lit(None).cast(history.schema[roles.amount].dataType))
    )
    return last.unionByName(rest)


def behaviour_features(
    current: DataFrame,
    roles: Roles,
    limits: ScaleLimits,
    history: DataFrame | None = None,
) -> DataFrame:
    """Lag, rolling mean and deviation, count and ratio over earlier rows of the group.

    Order: time (missing last), current before history at equal times, position.
    A missing group value is a group of its own. ``current`` needs the position
    column to be stable between passes, as it is in a table.
    """
    if not (roles.group and roles.time and roles.amount):
        return current
    events = current.withColumns(
        {_PAST: F.lit(0), _STANDS_FOR: F.lit(1).cast("bigint")}
    )
    weighted = history is not None and _STANDS_FOR in history.columns
    if history is not None:
        past = history.withColumn(_PAST, F.lit(1))
        if not weighted:
            past = past.withColumn(_STANDS_FOR, F.lit(1).cast("bigint"))
        events = events.unionByName(past, allowMissingColumns=True)

    hot = _hot_groups(events, roles, limits)
    if hot is None:
        window = Window.partitionBy(roles.group).orderBy(*_order(roles))
    else:
        events = _with_slices(events, hot, roles, limits)
        weighted = True
        window = Window.partitionBy(roles.group, _SLICE, _TIE).orderBy(
            F.col(_HEAD).desc(), *_order(roles)
        )
    featured = events.withColumns(_window_columns(F.col(roles.amount), window, weighted))
    if hot is not None:
        featured = featured.filter(~F.col(_HEAD))
    if history is not None:
        featured = featured.filter(F.col(_PAST) == 0)
    ratio = F.col(roles.amount) / F.nullif(F.col("amount_mean_5_prev"), F.lit(0.0))
    return featured.withColumn("amount_to_mean_5_prev", ratio).drop(*_WORK)


def _order(roles: Roles) -> list[Column]:
    return [F.col(roles.time).asc_nulls_last(), F.col(_PAST).asc(), F.col(SOURCE_POS).asc()]


def _window_columns(amount: Column, window, weighted: bool) -> dict[str, Column]:
    recent = window.rowsBetween(-LOOKBACK, -1)
    if weighted:
        all_before = window.rowsBetween(Window.unboundedPreceding, -1)
        seen = F.coalesce(F.sum(_STANDS_FOR).over(all_before), F.lit(0))
    else:
        seen = F.row_number().over(window) - 1
    return {
        "previous_amount": F.lag(amount).over(window),
        "amount_mean_5_prev": F.avg(amount).over(recent),
        "amount_std_5_prev": F.stddev_samp(amount).over(recent),
        "transactions_seen_before": seen.cast("bigint"),
    }


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("rows"))


def _hot_groups(events: DataFrame, roles: Roles, limits: ScaleLimits) -> DataFrame | None:
    """Groups too large for one task; at most all rows / ``hot_group_rows`` of them."""
    large = group_sizes(events, roles.group).filter(F.col("rows") > limits.hot_group_rows)
    if large.isEmpty():
        return None
    return pin(large.withColumnRenamed(roles.group, "_hot_group"))


def _with_slices(
    events: DataFrame, hot: DataFrame, roles: Roles, limits: ScaleLimits
) -> DataFrame:
    """Cut the hot groups into time slices and give each slice its context rows.

    Afterwards (group, slice) can be windowed like a group of its own: the last
    rows before the slice are repeated at its head, the oldest of them standing
    for all rows before it.
    """
    marked = events.join(
        sized_broadcast(hot.drop("rows"), limits),
        F.col(roles.group).eqNullSafe(F.col("_hot_group")),
        "left",
    )
    # A missing group can be hot too, so the mark is not the joined key itself.
    null_is_hot = hot.filter(F.col("_hot_group").isNull()).limit(1).count() > 0
    is_hot = F.col("_hot_group").isNotNull()
    if null_is_hot:
        is_hot = is_hot | F.col(roles.group).isNull()
    late = F.lit(float(2**63))
    marked = marked.withColumns(
        {
            "_is_hot": is_hot,
            "_at": F.coalesce(_micros(F.col(roles.time)).cast("double"), late),
            "_rank_in_tie": F.col(_PAST).cast("double") * late
            + F.col(SOURCE_POS).cast("double"),
        }
    ).drop("_hot_group")

    narrow = pin(
        marked.filter("_is_hot").select(
            roles.group,
            roles.time,
            roles.amount,
            SOURCE_POS,
            _PAST,
            _STANDS_FOR,
            "_at",
            "_rank_in_tie",
        )
    )
    rows = narrow.count()
    slices = min(limits.max_slices, math.ceil(rows / limits.hot_group_rows) + 1)
    time_edges, heavy_times = slice_edges(narrow, "_at", slices)
    heavy = F.col("_at").isin(heavy_times) if heavy_times else F.lit(False)
    tie_edges: list[float] = [-math.inf, math.inf]
    if heavy_times:
        tied = narrow.filter(heavy)
        tie_slices = min(limits.max_slices, math.ceil(tied.count() / limits.hot_group_rows) + 1)
        tie_edges, _ = slice_edges(tied, "_rank_in_tie", tie_slices)

    def cut(df: DataFrame, hot_row: Column) -> DataFrame:
        sliced = cut_slices(df, "_at", time_edges, _SLICE)
        sliced = cut_slices(sliced, "_rank_in_tie", tie_edges, _TIE)
        return sliced.withColumns(
            {
                _SLICE: F.when(hot_row, F.col(_SLICE)).otherwise(-1),
                _TIE: F.when(hot_row & heavy, F.col(_TIE)).otherwise(-1),
            }
        ).drop("_at", "_rank_in_tie", "_is_hot")

    context = _context_rows(cut(narrow.withColumn("_is_hot", F.lit(True)), F.lit(True)), roles)
    sliced = cut(marked, F.col("_is_hot")).withColumn(_HEAD, F.lit(False))
    return sliced.unionByName(context, allowMissingColumns=True)


def _context_rows(hot_rows: DataFrame, roles: Roles) -> DataFrame:
    slice_keys = [roles.group, _SLICE, _TIE]
    newest_first = Window.partitionBy(*slice_keys).orderBy(
        F.col(roles.time).desc_nulls_first(), F.col(_PAST).desc(), F.col(SOURCE_POS).desc()
    )
    tail = (
        hot_rows.withColumn("_back", F.row_number().over(newest_first))
        .filter(F.col("_back") <= LOOKBACK)
        .groupBy(*slice_keys)
        .agg(
            # Newest last; at most LOOKBACK entries.
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.col("_back")).alias("back"),
                        F.col(roles.time).alias("time"),
                        F.col(roles.amount).alias("amount"),
                        F.col(SOURCE_POS).alias("pos"),
                        F.col(_PAST).alias("past"),
                    )
                )
            ).alias("_tail")
        )
    )
    sizes = hot_rows.groupBy(*[F.col(k).alias(f"_s_{k}") for k in slice_keys]).agg(
        F.sum(_STANDS_FOR).alias("_rows")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in slice_keys]
    # One row per slice of a hot group: at most max_slices of them per group.
    in_time = Window.partitionBy(roles.group).orderBy(_SLICE, _TIE)
    slices = (
        tail.join(sizes, same)
        .select(*slice_keys, "_tail", "_rows")
        .withColumns(
            {
                "_seen": F.sum("_rows").over(
                    in_time.rowsBetween(Window.unboundedPreceding, -1)
                ),
                # Every slice has a row, so LOOKBACK slices have LOOKBACK rows.
                "_recent": F.flatten(
                    F.collect_list("_tail").over(in_time.rowsBetween(-LOOKBACK, -1))
                ),
            }
        )
        .filter(F.col("_seen") > 0)
        .withColumn("_size", F.least(F.lit(LOOKBACK), F.size("_recent")))
        .withColumn("_recent", F.slice("_recent", -F.col("_size"), LOOKBACK))
    )
    rows = slices.select(
        *slice_keys, "_seen", "_size", F.posexplode("_recent").alias("_i", "_row")
    )
    return rows.select(
        F.col(roles.group),
        F.col(_SLICE),
        F.col(_TIE),
        F.col("_row.time").alias(roles.time),
        F.col("_row.amount").alias(roles.amount),
        F.col("_row.pos").alias(SOURCE_POS),
        F.col("_row.past").alias(_PAST),
        F.when(F.col("_i") == 0, F.col("_seen") - F.col("_size") + 1)
        .otherwise(1)
        .cast("bigint")
        .alias(_STANDS_FOR),
        F.lit(True).alias(_HEAD),
    )
