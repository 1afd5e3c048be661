"""Large JSON documents, an object or a list per file, read by many tasks.

A file is cut at every comma. Which commas part two entries depends on what stands before them:
whether a text is open there, and how many braces are. Each block of a file says what it does to
that state, for a block that begins inside a text and for one that doesn't; one row per block
then gives the state each of them really begins with. A block is a run of at most
``1 << BLOCK_BITS`` pieces that one task read, however large the file is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from riskloom.roles import SOURCE_POS
from riskloom.session import pin
from riskloom.sources.positions import with_source_position

_BLOCK = ("_file", "_block")
#: Bits of a piece's position that number it within its block.
BLOCK_BITS = 16
#: Bytes of the files whose pieces one task puts in order; a piece takes many times its length there.
TASK_BYTES = 4 << 20
_BEFORE = (Window.unboundedPreceding, -1)


def _opened(text: Column) -> Column:
    """Braces and brackets that a text opens and doesn't close."""

    def count(letters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, letters, ""))

    return count("[{") - count("]}")


def _tasks(text: DataFrame) -> int:
    """Tasks for the pieces of a scan, by the bytes of its files."""
    size = int(str(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return -(-size // TASK_BYTES) or 1


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between commas: value, place, whether it begins inside a text (``inside``), and
    how many braces are open before (``depth``) and after it (``after``). The texts are stored."""
    text = spark.read.option("lineSep", ",").text(path)
    tasks = _tasks(text)
    if len(text.columns) > 1:  # folders by a column
        text = text.select("value")
    rows = with_source_position(text, file=_BLOCK[0])
    rows = rows.withColumn(_BLOCK[1], F.shiftright(SOURCE_POS, BLOCK_BITS))
    # Escapes never reach over a comma, so what is left of a piece has only real quotes.
    escaped, quoted = F.col("value").contains("\\"), F.col("_bare").contains('"')
    rows = rows.withColumn("_bare", F.when(escaped, F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value")))
    in_texts = r'(?s)"[^"]*("|$)'
    # What lies outside texts, if the piece begins outside of one and if it begins inside.
    rows = rows.withColumns(
        {
            "_t0": F.when(quoted, F.regexp_replace("_bare", in_texts, "")).otherwise(F.col("_bare")),
            "_t1": F.when(quoted, F.regexp_replace(F.concat(F.lit('"'), "_bare"), in_texts, "")).otherwise(""),
        }
    )
    quotes = F.length("_bare") - F.length(F.translate(F.col("_bare"), '"', ""))
    rows = rows.select(
        *_BLOCK, SOURCE_POS, "value", quotes.alias("_quotes"),
        _opened(F.col("_t0")).alias("_d0"), _opened(F.col("_t1")).alias("_d1"),
    )
    rows = rows.repartition(tasks, _BLOCK[1])
    in_block = Window.partitionBy(*_BLOCK).orderBy(SOURCE_POS).rowsBetween(*_BEFORE)
    odd = F.pmod(F.coalesce(F.sum("_quotes").over(in_block), F.lit(0)), F.lit(2))
    rows = rows.withColumn("_odd", odd)
    # Change of depth if the block begins outside a text, and if it begins inside one.
    rows = rows.withColumns(
        {
            "_c0": F.when(F.col("_odd") == 0, F.col("_d0")).otherwise(F.col("_d1")),
            "_c1": F.when(F.col("_odd") == 1, F.col("_d0")).otherwise(F.col("_d1")),
        }
    )
    rows = rows.withColumns({f"_s{i}": F.coalesce(F.sum(f"_c{i}").over(in_block), F.lit(0)) for i in (0, 1)})
    rows = pin(rows.drop("_d0", "_d1"))
    # One row per block of a file.
    ends = rows.groupBy(*_BLOCK).agg(*[F.sum(c).alias(f"t{c}") for c in ("_quotes", "_c0", "_c1")])
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(*_BEFORE)
    start = F.pmod(F.coalesce(F.sum("t_quotes").over(earlier), F.lit(0)), F.lit(2))
    ends = ends.withColumn("_begins", start)
    own = F.when(F.col("_begins") == 0, F.col("t_c0")).otherwise(F.col("t_c1"))
    ends = ends.withColumn("_own", own).withColumn("_base", F.coalesce(F.sum("_own").over(earlier), F.lit(0)))
    ends = pin(ends.select(*_BLOCK, "_begins", "_base"))
    rows = rows.join(F.broadcast(ends), list(_BLOCK))
    outside = F.col("_begins") == 0
    depth = F.col("_base") + F.when(outside, F.col("_s0")).otherwise(F.col("_s1"))
    return rows.select(
        *_BLOCK,
        SOURCE_POS,
        "value",
        (F.pmod(F.col("_odd") + F.col("_begins"), F.lit(2)) == 1).alias("inside"),
        depth.alias("depth"),
        (depth + F.when(outside, F.col("_c0")).otherwise(F.col("_c1"))).alias("after"),
    )


_OPENING = r"^[\s\x{FEFF}]*"


def entries(spark: SparkSession, path: str, inner: str | None = None) -> DataFrame:
    """(entry, SOURCE_POS): the members of the object or list that each file is, as texts.

    With ``inner``, the members of the object under that key where a file has it at the top.
    """
    rows = pieces(spark, path)
    tasks = _tasks(spark.read.option("lineSep", ",").text(path))
    level, first = F.lit(1), rows.groupBy("_file").agg(F.min(SOURCE_POS).alias("_from"))
    opens = rf"{_OPENING}[\[{{]"
    if inner is not None:
        named = rf'{_OPENING}(\{{\s*)?"{inner}"\s*:\s*\{{'
        top = ~F.col("inside") & ((F.col("depth") == 1) | ((F.col("depth") == 0) & F.col("value").rlike(rf"{_OPENING}\{{")))
        here = top & F.col("value").rlike(named)
        ranges = rows.groupBy("_file").agg(
            F.min(SOURCE_POS).alias("_first"), F.min(F.when(here, F.col(SOURCE_POS))).alias("_named")
        )
        rows = rows.join(F.broadcast(ranges), "_file")
        behind = ~F.col("inside") & (F.col("depth") == 1) & (F.col(SOURCE_POS) > F.col("_named"))
        until = rows.groupBy("_file").agg(F.min(F.when(behind, F.col(SOURCE_POS))).alias("_until"))
        rows = rows.join(F.broadcast(until), "_file").filter(
            F.coalesce((F.col(SOURCE_POS) >= F.col("_named")) & (F.col(SOURCE_POS) < F.coalesce("_until", F.lit(2**63 - 1))), F.col("_named").isNull())
        )
        is_inner = F.col("_named").isNotNull()
        rows = rows.withColumn("_from", F.coalesce("_named", "_first")).withColumn("_level", F.when(is_inner, 2).otherwise(1))
        level = F.col("_level")
        cut = F.when(is_inner, F.regexp_replace("value", named, "")).otherwise(F.regexp_replace("value", opens, ""))
    else:
        rows = rows.join(F.broadcast(first), "_file").withColumn("_level", F.lit(1))
        cut = F.regexp_replace("value", opens, "")
    is_first = F.col(SOURCE_POS) == F.col("_from")
    begins = is_first | (~F.col("inside") & (F.col("depth") == level))
    in_order = Window.partitionBy(*_BLOCK).orderBy(SOURCE_POS).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        *_BLOCK, SOURCE_POS, "after", level.alias("_level"),
        F.when(is_first, cut).otherwise(F.col("value")).alias("value"), begins.cast("long").alias("_begins"),
    )
    rows = rows.repartition(tasks, _BLOCK[1]).withColumn("_nth", F.sum("_begins").over(in_order))
    # The pieces of an entry come together within their block ...
    whole = F.array_sort(F.collect_list(F.struct(SOURCE_POS, "value")))
    parts = rows.groupBy(*_BLOCK, "_nth").agg(
        F.array_join(F.transform(whole, lambda p: p["value"]), ",").alias("text"),
        F.min(SOURCE_POS).alias(SOURCE_POS),
        F.max_by(F.col("_level") - F.col("after"), SOURCE_POS).alias("_closed"),
    )
    parts = pin(parts)
    # ... and what a block begins with belongs to the last entry before it: one row per block.
    last = pin(parts.groupBy(*_BLOCK).agg(F.max("_nth").alias("_last")))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(*_BEFORE)
    opened = F.when(F.col("_last") > 0, F.struct(F.col("_block").alias("b"), F.col("_last").alias("n")))
    owner = last.select(*_BLOCK, F.last(opened, ignorenulls=True).over(earlier).alias("_owner"))
    rest = parts.filter("_nth = 0").join(owner, list(_BLOCK))
    rest = rest.groupBy("_file", F.col("_owner.b").alias("_block"), F.col("_owner.n").alias("_nth")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(SOURCE_POS, "text"))), lambda p: p["text"]), ",").alias("_rest"),
        F.max_by("_closed", SOURCE_POS).alias("_closed_there"),
    )
    # Only the last entry of a block can go on; the others are not shuffled again.
    parts = parts.filter("_nth > 0").join(F.broadcast(last), list(_BLOCK))
    done = parts.filter("_nth < _last").withColumns({c: F.lit(None).cast(rest.schema[c].dataType) for c in ("_rest", "_closed_there")})
    parts = done.unionByName(parts.filter("_nth = _last").join(rest, [*_BLOCK, "_nth"], "left"))
    text = F.concat_ws(",", "text", "_rest")
    closed = F.coalesce("_closed_there", "_closed")
    text = (
        F.when(closed == 1, F.regexp_replace(text, r"\s*[\]}]\s*$", ""))
        .when(closed == 2, F.regexp_replace(text, r"\s*[\]}]\s*[\]}]\s*$", ""))
        .otherwise(text)
    )
    return parts.select(F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")).alias("entry"), SOURCE_POS).filter("entry <> ''")


def opens_list(spark: SparkSession, path: str) -> bool:
    """Whether a JSON file starts with ``[``; reads up to its first comma only."""
    first = spark.read.option("lineSep", ",").text(path).filter(F.trim("value") != "").first()
    return first is not None and first["value"].lstrip("﻿ \t\r\n").startswith("[")


def read_members(spark: SparkSession, path: str, inner: str | None = None) -> DataFrame:
    """(key, value, SOURCE_POS) of an object's members; values that aren't texts are JSON."""
    member = F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), "map<string,string>", {"mode": "FAILFAST"})
    return entries(spark, path, inner).select(F.explode(member).alias("key", "value"), SOURCE_POS)


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON list of objects, all columns as text; nested values are JSON.

    A record may lack fields that others have. What is not an object stops the job instead of
    vanishing.
    """
    body = entries(spark, path)
    # the fields of all records, as the first one that has each orders them
    fields = body.select(SOURCE_POS, F.posexplode(F.json_object_keys("entry")).alias("_at", "_name"))
    order = fields.groupBy("_name").agg(F.min(F.struct(SOURCE_POS, "_at")).alias("_first")).orderBy("_first")
    names = [r["_name"] for r in order.collect()]
    if not names:
        return spark.createDataFrame([], "key string, value string")
    kind = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return body.select(F.from_json("entry", kind, {"mode": "FAILFAST"}).alias("r"), SOURCE_POS).select("r.*", SOURCE_POS)


def read_json_object(spark: SparkSession, path: str) -> DataFrame:
    """An object's (key, value), the last of a repeated key, or a list's records."""
    if opens_list(spark, path):
        return read_json_records(spark, path)
    members = read_members(spark, path)
    return members.groupBy("key").agg(F.max_by(F.struct("value"), SOURCE_POS).alias("m")).select("key", "m.value")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels from a JSON object, from the object under its key ``target``, or from records."""
    if opens_list(spark, path):
        return read_json_records(spark, path)
    # of an object's repeated keys the last one holds: it comes first in this order
    return read_members(spark, path, "target").select("key", "value", (-F.col(SOURCE_POS)).alias(SOURCE_POS))
