"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch


#: Links of an id from which it is a hub, and most hubs. The smallest id around each hub is
#: broadcast (16 bytes), so that its links stay where they are.
HUB_LINKS, MOST_HUBS = 256, 200_000


#: So few links (16 bytes each) are worked on by one task, without a shuffle a step.
SMALL_LINKS = 20_000


def _both_ways(pairs: DataFrame, **more: tuple) -> DataFrame:
    """Each pair from both its ends, as u and v; ``more`` are columns that differ by the end."""
    ends = ((F.col("u"), F.col("v")), (F.col("v"), F.col("u")))
    both = [F.struct(u.alias("u"), v.alias("v"), *(F.lit(x[i]).alias(k) for k, x in more.items())) for i, (u, v) in enumerate(ends)]
    return pairs.select(F.inline(F.array(*both)))


def _stars(pairs: DataFrame) -> bool:
    """Whether every id has one smaller neighbour at most, and those that have one are nobody's."""
    seen = _both_ways(pairs, up=(1, 0)).groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("root"))
    return seen.filter("up > 1 or (up = 1 and root = 0)").isEmpty()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links: a, b (any order, repeats allowed). Returns id, component (its smallest id), one
    row for each id that a link names.

    A step points every neighbour of an id at the smallest one around it: first the smaller
    neighbours (and the id itself), then the larger ones. Repeated until each component is a
    star around its smallest id; that takes a number of steps logarithmic in its size.
    Links stay in tables that all executors read.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    stored = scratch.write(pairs, "links")
    few = stored.count() <= SMALL_LINKS
    own = lambda df: df.coalesce(1) if few else df
    while not _stars(pairs := own(stored)):
        # an id has few smaller neighbours: the bands it was linked in, or stars it is between
        near = pairs.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = near.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        small = scratch.write(small, "smaller")
        both = _both_ways(own(small))
        nearest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        if few:
            beside = both.join(nearest, "u")
        else:
            limit = max(HUB_LINKS, 2 * small.count() // MOST_HUBS)
            hubs = F.broadcast(nearest.filter(F.col("n") > limit).select("u", "m"))
            others = both.join(hubs.select("u"), "u", "left_anti").join(nearest.filter(F.col("n") <= limit).select("u", "m"), "u")
            beside = both.join(hubs, "u").unionByName(others)
        large = beside.filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        now = scratch.write(large, "links")
        scratch.drop(stored)
        scratch.drop(small)
        stored = now
    return stored.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        stored.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
