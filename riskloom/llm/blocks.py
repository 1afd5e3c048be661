"""Links within groups of any size, found in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

#: Rows and bytes of one block; a task holds two.
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20


def star_links(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From a matrix of links between rows: each row's id and the smallest id it reaches."""
    n = len(ids)
    seen, a, b = np.zeros(n, bool), [], []
    for row in np.argsort(ids, kind="stable").tolist():
        if seen[row]:
            continue
        reach, front = np.zeros(n, bool), np.array([row])
        reach[row] = True
        while len(front):
            new = linked[front].any(axis=0) & ~reach
            reach |= new
            front = np.flatnonzero(new)
        seen |= reach
        others = ids[reach & (ids != ids[row])]
        a += [ids[row]] * len(others)
        b += others.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def block_links(members: DataFrame, matrix: Callable[[list[bytes]], np.ndarray], scratch: Scratch) -> DataFrame:
    """members: grp, id, payload. ``matrix`` tells which of the payloads of a block are linked.
    Returns links a, b whose components are those of all links within each group.

    A group of one block is compared whole; small groups share a task. In a larger group
    every block is first compared with itself and with the group's first block. The largest
    component within the first block, which every such task sees alike, is the group's core:
    rows that a task finds linked to it are settled, as in a group of copies nearly all are.
    The rows left over then meet all blocks. So two rows always meet unless both are linked
    to the core, no component is split, and each task gives at most a few links a row.
    """
    sizes = members.groupBy("grp").agg(F.count("*").alias("_rows"), F.sum(F.length("payload")).alias("_bytes"))
    sizes = scratch.write(
        sizes.select("grp", F.ceil(F.greatest(F.col("_rows") / BLOCK_ROWS, F.col("_bytes") / BLOCK_BYTES)).alias("_blocks"), "_rows", "_bytes"),
        "sizes",
    )
    wide, rows, size = sizes.agg(
        F.max("_blocks"), F.sum(F.expr("if(_blocks = 1, _rows, 0)")), F.sum(F.expr("if(_blocks = 1, _bytes, 0)"))
    ).first()
    bundles = max(1, -(-int(rows or 0) // BLOCK_ROWS), -(-int(size or 0) // BLOCK_BYTES))
    rows = members.join(sizes.select("grp", "_blocks", (F.col("_blocks") > 1).alias("_wide")), "grp").withColumn(
        "_block", F.when(F.col("_blocks") > 1, F.pmod(F.xxhash64("id"), F.col("_blocks"))).otherwise(F.lit(0).cast("long"))
    )
    if wide and wide > 1:  # read several times below
        rows = scratch.write(rows, "rows")
    bundle = F.pmod(F.xxhash64("grp", F.lit(1)), F.lit(bundles))
    first = rows.select(
        F.when(F.col("_wide"), F.col("grp")).otherwise(bundle).alias("_key"),
        F.explode(F.when(F.col("_wide") & (F.col("_block") == 0), F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).otherwise(F.array("_block"))).alias("_task"),
        "_wide", "grp", "id", "payload", "_block",
    )

    def compared(table: pa.Table, wide: bool) -> pa.Table:
        """Links a, b; of a wide group's task also its own rows outside the core: a alone."""
        grp, ids = (table.column(c).to_numpy() for c in ("grp", "id"))
        payload = table.column("payload").to_pylist()
        order = np.argsort(grp, kind="stable")
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in np.split(order, np.flatnonzero(np.diff(grp[order])) + 1):
            if len(at) > 1:
                a, b = star_links(ids[at], matrix([payload[i] for i in at]))
                found.append((np.full(len(a), grp[at[0]]), a, b))
        own, a, b = (np.concatenate([x[i] for x in found] or [np.zeros(0, np.int64)]) for i in range(3))
        if not wide:
            return pa.table({"grp": own, "a": a, "b": b})
        first, block = ids[table.column("_block").to_numpy() == 0], table.column("_block").to_numpy()
        mine = ids[block == block.max()]
        if not len(first):  # a few long rows may leave a block empty; without the first one there is no core
            return pa.table({
                "grp": pa.array(np.append(own, np.full(len(mine), grp[0]))), "a": pa.array(np.append(a, mine)),
                "b": pa.array([*b.tolist(), *[None] * len(mine)], pa.int64()),
            })
        head = dict(zip(b.tolist(), a.tolist(), strict=True))  # each row's smallest linked id
        inner = np.flatnonzero(block == 0)
        if block.max():  # links through this block don't count in finding the core
            c, d = star_links(first, matrix([payload[i] for i in inner]))
        else:
            c, d = a, b
        within = dict(zip(d.tolist(), c.tolist(), strict=True))
        heads, sizes = np.unique([within.get(i, i) for i in first.tolist()], return_counts=True)
        core = int(heads[np.lexsort((heads, -sizes))[0]])
        core = head.get(core, core)
        rest = [i for i in mine.tolist() if head.get(i, i) != core]
        return pa.table({
            "grp": pa.array(np.append(own, np.full(len(rest), grp[0]))), "a": pa.array(np.append(a, np.array(rest, np.int64))),
            "b": pa.array([*b.tolist(), *[None] * len(rest)], pa.int64()),
        })

    schema = "grp long, a long, b long"
    keys = ("_key", "_task", "_wide")
    found = first.groupBy(*keys).applyInArrow(lambda t: compared(t, t.column("_wide")[0].as_py()), schema)
    found = scratch.write(found, "block-links")
    links = found.filter("b is not null").select("a", "b")
    if not wide or wide == 1:
        return links
    rest = found.filter("b is null").select("grp", F.col("a").alias("id")).distinct()
    left = rest.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("_left"))
    left = scratch.write(left, "left")
    if left.isEmpty():
        return links
    large = rows.filter("_blocks > 1").join(left, "grp")
    outside = large.join(rest, ["grp", "id"], "left_semi").withColumn("_part", F.pmod(F.xxhash64("id", F.lit(2)), F.col("_left")))
    # every row goes to the tasks of all outside parts; an outside row to those of all blocks
    task = F.col("_block") * F.lit(1 << 20) + F.col("_part")
    everyone = large.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_left") - 1)))
    others = outside.withColumn("_at", F.col("_block")).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    others = others.filter("_at <> _block")  # it is there already
    second = everyone.select("grp", task.alias("_task"), "id", "payload").union(others.select("grp", task.alias("_task"), "id", "payload"))
    more = second.groupBy("grp", "_task").applyInArrow(lambda t: compared(t, False), schema)
    return links.union(scratch.write(more, "block-links").select("a", "b"))
