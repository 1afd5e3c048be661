"""Exact order statistics and running sums without a global sort."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.config import ScaleLimits

RanksOf = Callable[[int], Sequence[int]]


@dataclass
class _Interval:
    """Values in [low, high] still holding wanted ranks; ``below`` rows precede it."""

    low: Any
    high: Any
    below: int
    rows: int
    ranks: list[int]


@dataclass(frozen=True)
class RankedValues:
    rows: int
    minimum: Any
    maximum: Any
    at: dict[int, Any]


def rank_values(
    df: DataFrame,
    columns: Sequence[str],
    ranks_of: RanksOf,
    limits: ScaleLimits,
) -> dict[str, RankedValues]:
    """Values at 0-based ascending ranks among the non-null values of each column.

    A histogram is refined around the wanted ranks until each lies in a cell of
    one value, so every step is one map-side aggregation over the columns alone
    and the driver receives at most ``limits.histogram_cells`` cells. All columns
    must share one type, either bigint or double.
    """
    columns = list(columns)
    bounds = df.agg(
        *[
            fn(c).alias(f"{tag}{i}")
            for i, c in enumerate(columns)
            for tag, fn in (("n", F.count), ("lo", F.min), ("hi", F.max))
        ]
    ).first()

    active: dict[int, list[_Interval]] = {}
    found: dict[int, dict[int, Any]] = {i: {} for i in range(len(columns))}
    for i in range(len(columns)):
        rows = bounds[f"n{i}"]
        wanted = sorted(set(ranks_of(rows))) if rows else []
        if any(not 0 <= r < rows for r in wanted):
            raise ValueError(f"ranks {wanted} outside 0..{rows - 1}")
        start = _Interval(bounds[f"lo{i}"], bounds[f"hi{i}"], 0, rows, wanted)
        active[i] = _settle([start], found[i])

    while any(active.values()):
        intervals = [iv for ivs in active.values() for iv in ivs]
        few_rows = sum(iv.rows for iv in intervals) <= limits.histogram_cells
        # Neighbouring bigints can share one double; such intervals hold few values.
        stuck = all(float(iv.low) == float(iv.high) for iv in intervals)
        share = None if few_rows or stuck else max(4, limits.histogram_cells // len(intervals))
        cells = _cells(df, columns, active, share)
        for i, ivs in active.items():
            nxt = [part for iv in ivs for part in _narrow(iv, cells.get(i, []))]
            active[i] = _settle(nxt, found[i])

    return {
        c: RankedValues(bounds[f"n{i}"], bounds[f"lo{i}"], bounds[f"hi{i}"], found[i])
        for i, c in enumerate(columns)
    }


def _settle(intervals: list[_Interval], found: dict[int, Any]) -> list[_Interval]:
    """Record the ranks whose interval holds one value; return the others."""
    still_open = []
    for iv in intervals:
        if not iv.ranks:
            continue
        if iv.low == iv.high:
            found.update({r: iv.low for r in iv.ranks})
        else:
            still_open.append(iv)
    return still_open


def _literal(value: Any) -> str:
    kind = "DOUBLE" if isinstance(value, float) else "BIGINT"
    return f"CAST('{value!r}' AS {kind})"


def _within(column: str, iv: _Interval) -> str:
    return f"`{column}` BETWEEN {_literal(iv.low)} AND {_literal(iv.high)}"


def _cell_of(column: str, number: int, iv: _Interval, share: int) -> str:
    """Which of the interval's equally wide cells a value falls into, as SQL.

    Only the order of the cells matters for the result, and every step here
    keeps order. Halving first keeps the width of the whole double range finite.
    """
    most = sys.float_info.max
    low, high = max(float(iv.low), -most) / 2, min(float(iv.high), most) / 2
    if low == high:
        return f"{number * share}"
    part = f"(CAST(`{column}` AS DOUBLE) / 2 - {_literal(low)}) / {_literal(high - low)}"
    cell = f"greatest(0D, least({share - 1}D, floor({part} * {share}D)))"
    return f"{number * share} + CAST({cell} AS INT)"


def _cells(
    df: DataFrame, columns: list[str], active: dict[int, list[_Interval]], share: int | None
) -> dict[int, list[tuple]]:
    """Rows, smallest and largest value per cell of the active intervals.

    Without ``share`` every distinct value is a cell. Rows outside the intervals
    are dropped at once; for a single column the filter reaches the scan.
    """
    used = [i for i, ivs in active.items() if ivs]
    if len(used) == 1 and len(active[used[0]]) <= 4:
        df = df.filter(" OR ".join(_within(columns[used[0]], iv) for iv in active[used[0]]))
    # One SQL text instead of thousands of column objects: up to 198 intervals.
    entries = []
    for i in used:
        cases = " ".join(
            f"WHEN {_within(columns[i], iv)} THEN "
            + ("0" if share is None else _cell_of(columns[i], number, iv, share))
            for number, iv in enumerate(active[i])
        )
        entries.append(f"named_struct('c', {i}, 'cell', CASE {cases} END, 'v', `{columns[i]}`)")
    tall = df.selectExpr(f"explode(array({', '.join(entries)})) AS r").filter("r.cell IS NOT NULL")
    by = F.col("r.v") if share is None else F.col("r.cell")
    rows = (
        tall.groupBy("r.c", by.alias("key"))
        .agg(F.count("*").alias("n"), F.min("r.v").alias("lo"), F.max("r.v").alias("hi"))
        .collect()
    )
    cells: dict[int, list[tuple]] = {}
    for row in sorted(rows, key=lambda r: r["lo"]):
        cells.setdefault(row["c"], []).append((row["lo"], row["hi"], row["n"]))
    return cells


def _narrow(interval: _Interval, cells: list[tuple]) -> list[_Interval]:
    """The cells of ``interval`` that hold a wanted rank."""
    out: list[_Interval] = []
    below = interval.below
    wanted = list(interval.ranks)
    for low, high, rows in cells:
        if low < interval.low or high > interval.high:
            continue
        inside = [r for r in wanted if r < below + rows]
        if inside:
            out.append(_Interval(low, high, below, rows, inside))
            wanted = wanted[len(inside) :]
        below += rows
    if wanted:
        raise RuntimeError("the input changed between two passes over it")
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], limits: ScaleLimits
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles per double column; None if all values are missing."""

    def spots(rows: int) -> list[tuple[int, int, float]]:
        out = []
        for p in probabilities:
            exact = p * (rows - 1)
            low = int(math.floor(exact))
            out.append((low, min(low + 1, rows - 1), exact - low))
        return out

    ranked = rank_values(
        df, columns, lambda rows: [r for lo, hi, _ in spots(rows) for r in (lo, hi)], limits
    )
    result: dict[str, list[float] | None] = {}
    for name, values in ranked.items():
        if values.rows == 0:
            result[name] = None
            continue
        result[name] = [
            values.at[lo] + (values.at[hi] - values.at[lo]) * part
            for lo, hi, part in spots(values.rows)
        ]
    return result


def slice_edges(df: DataFrame, column: str, slices: int) -> tuple[list[float], list[float]]:
    """Edges cutting ``column`` (double) into about equally filled slices.

    The second list names the values so frequent that they fill a slice alone;
    each of those gets a slice of its own.
    """
    probs = [i / slices for i in range(1, slices)]
    marks = df.approxQuantile(column, probs, 1.0 / (4 * slices)) if probs else []
    heavy = sorted({a for a, b in zip(marks, marks[1:]) if a == b})
    edges = set(marks) | {math.nextafter(h, math.inf) for h in heavy}
    inner = sorted(e for e in edges if math.isfinite(e))
    return [-math.inf, *inner, math.inf], heavy


def cut_slices(df: DataFrame, column: str, edges: Sequence[float], out: str) -> DataFrame:
    """Number the slice each row falls into; missing values get a number of their own."""
    if len(edges) <= 2:
        return df.withColumn(out, F.when(F.col(column).isNotNull(), F.lit(0)).otherwise(1))
    return (
        Bucketizer(splits=list(edges), inputCol=column, outputCol=out, handleInvalid="keep")
        .transform(df)
        .withColumn(out, F.col(out).cast("int"))
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    limits: ScaleLimits,
    descending: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Add ``<measure>_before``: the sum over the rows that come earlier.

    ``df`` is stored (it is read several times) and has one row per (keys, order).
    Beyond ``limits.rows_per_run`` rows the order column is cut into slices; each
    is summed by itself and shifted by the totals of the slices before it.
    """
    keys = list(keys)
    rows = df.count() if rows is None else rows
    slices = min(limits.max_slices, math.ceil(rows / limits.rows_per_run))
    by = F.col(order).desc() if descending else F.col(order).asc()

    def before(m: str, window) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(m).over(frame), F.lit(0))

    if slices <= 1:
        window = Window.partitionBy(*keys).orderBy(by)
        return df.withColumns({f"{m}_before": before(m, window) for m in measures})

    edges, _ = slice_edges(df, order, slices)
    cut = cut_slices(df, order, edges, "_slice")
    local = Window.partitionBy(*keys, "_slice").orderBy(by)
    summed = cut.withColumns({f"_in_{m}": before(m, local) for m in measures})

    slice_by = F.col("_slice").desc() if descending else F.col("_slice").asc()
    across = Window.partitionBy(*keys).orderBy(slice_by)
    totals = cut.groupBy(*keys, "_slice").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slice").alias("_k_slice"),
        *[before(m, across).alias(f"_off_{m}") for m in measures],
    )
    same = F.col("_slice") == F.col("_k_slice")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return summed.join(offsets, same).select(
        *df.columns,
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"{m}_before") for m in measures],
    )
