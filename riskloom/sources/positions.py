"""Source order as a column, from what a scan knows about each row."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.roles import SOURCE_POS

#: Files whose numbers are looked up in a search tree within the expression; more are joined
#: with their listing, a broadcast of one row per file.
FILES_IN_PLAN = 256
#: Bits of a row's number within its task; the others number the blocks of all files.
ROW_BITS = 33


def with_source_position(df: DataFrame, more: Mapping[str, Column] | None = None, file: str | None = None) -> DataFrame:
    """Number the rows of a file scan in source order: by path, block and order in the block.

    The numbers of the blocks come from the file listing, so one scan does it, without a join
    of rows or a shuffle. They leave gaps. ``more`` adds columns of the scan's metadata, ``file`` one with a number
    that is the same for all rows of a file.
    """
    if len(df.inputFiles()) <= 1:
        only = {file: F.lit(0).cast("bigint")} if file else None
        return df.select("*", *_named(more), *_named(only), F.monotonically_increasing_id().alias(SOURCE_POS))
    files, first, grain = _first_blocks(df)
    path = F.col("_metadata.file_path")
    # Local paths are spelled with one slash or three, by who tells them.
    path = F.when(path.startswith("file:///"), F.concat(F.lit("file:/"), F.substr(path, F.lit(9)))).otherwise(path)
    block = F.floor(F.col("_metadata.file_block_start") / grain).cast("bigint")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    if len(files) <= FILES_IN_PLAN:
        number = _search(path, files, first)
        position = F.shiftleft(number + block, ROW_BITS) + row
        return df.select("*", *_named(more), *_named({file: number} if file else None), position.alias(SOURCE_POS))
    listing = df.sparkSession.createDataFrame(list(zip(files, first)), "_listed string, _first bigint")
    tagged = df.select("*", *_named(more), path.alias("_path"), (F.shiftleft(block, ROW_BITS) + row).alias("_within"))
    position = F.shiftleft(F.col("_first"), ROW_BITS) + F.col("_within")
    joined = tagged.join(F.broadcast(listing), F.col("_path") == F.col("_listed"), "left")
    unknown = F.raise_error(F.concat(F.lit("not in the listing: "), F.col("_path"))).cast("bigint")
    position = F.coalesce(position, unknown)
    joined = joined.withColumn(SOURCE_POS, position)
    if file:
        joined = joined.withColumn(file, F.col("_first"))
    return joined.drop("_path", "_within", "_listed", "_first")


def _named(more: Mapping[str, Column] | None) -> list[Column]:
    return [c.alias(n) for n, c in (more or {}).items()]


def _first_blocks(df: DataFrame) -> tuple[list[str], list[int], int]:
    """The paths in order as the scan spells them, the number of each file's first block, and
    bytes that no block but a last one is below."""
    spark = df.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    grain = max(1, min(conf.filesOpenCostInBytes(), conf.filesMaxPartitionBytes()))
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) for name in df.inputFiles()]
    files, first, blocks = [], [], 0
    spelled = ((re.sub("^file:///", "file:/", p.toUri().toString()), p) for p in paths)
    for name, path in sorted(spelled, key=lambda x: x[0]):
        files.append(name)
        first.append(blocks)
        blocks += path.getFileSystem(hadoop).getFileStatus(path).getLen() // grain + 1
    return files, first, grain


def _search(path: Column, files: Sequence[str], first: Sequence[int]) -> Column:
    """The number that belongs to a path, by halving the sorted list."""
    if len(files) == 1:
        return F.lit(first[0]).cast("bigint")
    half = len(files) // 2
    return F.when(path < files[half], _search(path, files[:half], first[:half])).otherwise(
        _search(path, files[half:], first[half:])
    )
