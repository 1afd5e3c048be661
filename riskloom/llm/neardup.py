"""Near-duplicates by b-bit MinHash (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.blocks import block_links
from riskloom.llm.components import components
from riskloom.llm.store import Scratch
from riskloom.llm.textscan import LOWER, SPACE, hash_spans, mix, releasing, row_slices, spans, text_bytes

#: 48 bands of 6 minima: a pair of similarity 0.8 shares no band once in two million times.
BANDS, BAND_ROWS = 48, 6
HASHES = BANDS * BAND_ROWS
#: Bands are taken in rounds, of so many bands each. The first rounds join what is very alike,
#: so that later ones have little left to compare.
ROUNDS = (4, 44)
#: Bits kept of each minimum, and how far below the limit an estimate may lie: more than
#: five standard deviations of an estimate from 288 two-bit minima.
BITS, SLACK = 2, 0.15
#: Members whose texts are fetched with a broadcast of their ids (16 bytes each).
BROADCAST_IDS = 1_000_000

_RANDOM = np.random.default_rng(20_240_817)
_TIMES = (_RANDOM.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1) | np.uint32(1))[:, None]
_PLUS = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's number and the sorted distinct hashes of its shingles of ``words`` words
    (ASCII lower case, split at ASCII white space). Fewer words are one shingle."""
    data, starts = text_bytes(column)
    for first, last in row_slices(starts):
        part = LOWER[data[starts[first] : starts[last]]]
        begin, end, row = spans(~SPACE[part], starts[first : last + 1] - starts[first])
        h = hash_spans(part, begin, end)
        edges = np.searchsorted(row, np.arange(last - first + 1))
        run = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for j in range(words):
            run = mix((run + _FOLD) ^ h[j : j + len(run)])
        for i in range(last - first):
            a, b = int(edges[i]), int(edges[i + 1])
            if b - a >= words:
                own = np.sort(run[a : b - words + 1])
                yield first + i, own[np.append(True, own[1:] != own[:-1])]
            elif b > a:
                one = np.zeros(1, np.uint64)
                for x in h[a:b]:
                    one = mix((one + _FOLD) ^ x)
                yield first + i, one
            else:
                yield first + i, np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(out, (x[at : at + 512] * _TIMES + _PLUS).min(axis=1), out=out)
    return out


def low_bits(least: np.ndarray) -> np.ndarray:
    """BITS low bits of each scrambled minimum, packed: rows of HASHES * BITS / 8 bytes."""
    code = ((least ^ (least >> np.uint32(16))) * np.uint32(0x85EBCA6B)) >> np.uint32(20) & np.uint32(3)
    code = code.astype(np.uint8).reshape(len(least), -1, 4)
    return code[:, :, 0] | code[:, :, 1] << 2 | code[:, :, 2] << 4 | code[:, :, 3] << 6


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band's minima and number: rows of BANDS keys."""
    parts = least.reshape(len(least), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(least), BANDS))
    for j in range(BAND_ROWS):
        key = mix((key + _FOLD) ^ parts[:, :, j])
    return key.astype(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, n_shingles, two keys of the set, the packed bits and the band keys."""
    schema = "doc_id long, n_shingles long, k1 long, k2 long, bits binary, bands array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, count, k1, k2, least = batch.column(0), [], [], [], []
            salt = np.uint64(0xD6E8FEB86659FD93)

            def done(first: int) -> pa.RecordBatch:
                m = np.array(least).reshape(len(count), HASHES)
                edges = pa.array(np.arange(len(count) + 1) * BANDS, pa.int32())
                bands = pa.ListArray.from_arrays(edges, pa.array(band_keys(m).ravel()))
                bits = pa.array([x.tobytes() for x in low_bits(m)], pa.binary())
                keys = [pa.array(np.array(k, np.uint64).astype(np.int64)) for k in (k1, k2)]
                return pa.RecordBatch.from_arrays([ids.slice(first, len(count)), pa.array(count, pa.int64()), *keys, bits, bands], names=["doc_id", "n_shingles", "k1", "k2", "bits", "bands"])

            first = 0
            for row, own in shingle_sets(batch.column(1), words):
                if len(count) == 2000:
                    yield done(first)
                    first, count, k1, k2, least = row, [], [], [], []
                count.append(len(own))
                k1.append(own.sum(dtype=np.uint64))
                k2.append(mix(own ^ salt).sum(dtype=np.uint64))
                least.append(minima(own))
            if count:
                yield done(first)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(work), schema)


def most_unlike(similarity: float) -> int:
    """The most unequal codes of a pair whose estimate is within SLACK of ``similarity``.

    Codes of unequal minima still agree once in 2^BITS times; the estimate is what is left
    of the agreement when those are taken out."""
    chance = 0.5**BITS
    return int(np.floor(HASHES * (1 - chance) * (1 - (similarity - SLACK))))


def unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of unequal codes between rows of packed bits (as uint64)."""
    x = a ^ b
    return np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=-1, dtype=np.int64)


def bit_matrix(similarity: float):
    limit = most_unlike(similarity)

    def matrix(payload: list[bytes]) -> np.ndarray:
        bits = np.frombuffer(b"".join(payload), np.uint64).reshape(len(payload), -1)
        out = np.zeros((len(bits), len(bits)), bool)
        for i in range(0, len(bits), 64):
            out[i : i + 64] = unlike(bits[i : i + 64, None], bits[None]) <= limit
        return out

    return matrix


def set_matrix(percent: int):
    """Exact: which sets of 64-bit hashes have 100 * intersection >= percent * union."""

    def matrix(payload: list[bytes]) -> np.ndarray:
        sets = [np.frombuffer(p, np.uint64) for p in payload]
        size = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        order = np.argsort(flat, kind="stable")
        new = np.append(True, np.diff(flat[order]) != 0) if len(flat) else np.zeros(0, bool)
        column = np.cumsum(new) - 1
        shared = np.bincount(column)[column] > 1 if len(flat) else new
        owner, column = owner[order][shared], column[shared]
        column = np.cumsum(np.append(0, np.diff(column) != 0)) if len(column) else column
        inter = np.zeros((len(sets), len(sets)), np.float32)
        step = 4096
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            a, b = np.searchsorted(column, [at, at + step])
            dense = np.zeros((len(sets), step), np.float32)
            dense[owner[a:b], column[a:b] - at] = 1
            inter += dense @ dense.T
        inter = inter.astype(np.int64)
        return 100 * inter >= percent * (size[:, None] + size[None] - inter)

    return matrix


def near_duplicates(docs: DataFrame, words: int, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of ``words``-word shingles have 100 *
    intersection >= ``percent`` * union. component_id is the smallest doc_id reachable; kept
    says whether it is the document's own.

    1. Equal sets are one class, which its smallest doc_id stands for.
    2. Classes that share a band of minima are candidates; two low bits of each minimum give
       their similarity, corrected for chance, and drop pairs far below the limit.
       Bands are taken in rounds; what hangs together already is not compared again, so the
       copies of a large group meet in a few bands and not in all.
    3. Candidates that hang together are a group. Their texts are read again and full sets
       compared exactly, in blocks of bounded size (``blocks``), so that a group of copies of
       any size is never expanded into pairs.

    A null or empty text and one without words have an empty set, which links with nothing.
    A null doc_id has a null component, is kept and links with nothing. A doc_id on several
    rows is one document with several texts; equal rows come back each. Long texts take part
    whole. Other columns are left behind, so their names can't clash. An empty table gives
    no row. Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    made = scratch.write(sketches(docs, words), "sketches")
    classes = scratch.write(
        made.filter("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("n_docs"), F.min_by("bits", "doc_id").alias("bits"), F.min_by("bands", "doc_id").alias("bands"),
        ),
        "classes",
    )
    groups = rough_groups(classes, percent / 100, scratch)
    members = scratch.write(member_sets(docs, groups, words), "members")
    links = block_links(members, set_matrix(percent), scratch)
    again = repeated_ids(made, classes)
    links = links if again is None else links.union(again)
    found = scratch.write(components(links, scratch), "components")
    label = classes.select("k1", "k2", "rep", "n_docs").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    label = label.filter("n_docs > 1 or component is not null").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    return (
        made.select("doc_id", "n_shingles", "k1", "k2")
        .join(label, ["k1", "k2"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def rough_groups(classes: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """id, component of the classes that hang together by estimates near ``similarity`` or
    above, from pairs that share a band. Only what hangs together counts here, so a pair within
    a component of earlier rounds needn't be looked at again.

    The first round compares whole buckets. In later ones a component sends at most four of its
    classes to a bucket, which settles nearly all that belongs to a large group. Buckets that
    still hold several components and from which a class was left out are compared whole at
    the end."""
    spark = classes.sparkSession
    groups = spark.createDataFrame([], "id long, component long")

    def keyed(first: int, bands: int) -> DataFrame:
        known = groups.withColumnRenamed("id", "rep")
        known = F.broadcast(known) if known.count() <= BROADCAST_IDS else known
        own = classes.select("rep", F.slice("bands", first + 1, bands).alias("own")).join(known, "rep", "left")
        return own.select("rep", F.coalesce("component", "rep").alias("component"), F.explode("own").alias("grp"))

    def with_links(pairs: DataFrame, members: DataFrame) -> DataFrame:
        larger = members.join(classes.select("rep", F.col("bits").alias("payload")), "rep")
        larger = scratch.write(larger.select("grp", F.col("rep").alias("id"), "payload"), "larger")
        found = pair_links(pairs, classes, similarity).union(block_links(larger, bit_matrix(similarity), scratch))
        # the components so far are stars, so they stand for all links found before
        links = groups.select(F.col("id").alias("a"), F.col("component").alias("b")).union(found)
        made = scratch.write(components(links, scratch), "groups")
        scratch.drop(larger)
        return made

    first, thinned = 0, []
    for bands in ROUNDS:
        own = keyed(first, bands)
        ends = ((f, c) for f in ("min", "max") for c in ("component", "rep"))
        buckets = own.groupBy("grp").agg(F.count("*").alias("n"), *(getattr(F, f)(c).alias(f"{f}_{c}") for f, c in ends))
        buckets = scratch.write(buckets.filter("min_component < max_component"), "buckets")
        many = buckets.filter("n > 2").select("grp", "n")
        if first:
            some = F.array(F.min("rep"), F.max("rep"), *(F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(2)))
            thin = own.groupBy("grp", "component").agg(F.array_distinct(some).alias("reps")).join(many, "grp")
            thinned.append(scratch.write(thin, "thin"))
            members = thinned[-1].select("grp", F.explode("reps").alias("rep"))
        else:
            members = own.join(many.select("grp"), "grp").select("grp", "rep")
        pairs = buckets.filter("n = 2").select(F.col("min_rep").alias("a"), F.col("max_rep").alias("b"))
        groups = with_links(pairs, members)
        first += bands
        scratch.drop(buckets)
    now = groups.select(F.col("id").alias("component"), F.col("component").alias("now"))
    left = [t.join(now, "component", "left").withColumn("now", F.coalesce("now", "component")) for t in thinned]
    left = reduce(DataFrame.union, left)
    left = left.groupBy("grp").agg(F.min("now").alias("lo"), F.max("now").alias("hi"), F.max("n").alias("n"), F.sum(F.size("reps")).alias("seen"))
    left = scratch.write(left.filter("lo < hi and n > seen").select("grp"), "left")
    if not left.isEmpty():
        groups = with_links(spark.createDataFrame([], "a long, b long"), keyed(ROUNDS[0], first - ROUNDS[0]).join(left, "grp").select("grp", "rep"))
    for done in thinned:
        scratch.drop(done)
    return groups


def repeated_ids(made: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links a, b between a doc_id that stands on several rows and the classes of its texts."""
    own = made.filter("n_shingles > 0 and doc_id is not null")
    several = own.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    if several.isEmpty():
        return None
    return own.join(several, "doc_id").join(classes, ["k1", "k2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def pair_links(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs a, b whose packed bits agree often enough."""
    bits = classes.select("rep", "bits")
    both = pairs.join(bits.toDF("a", "bits_a"), "a").join(bits.toDF("b", "bits_b"), "b").select("a", "b", "bits_a", "bits_b")
    limit = most_unlike(similarity)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (2, 3)]
            near = pa.array(unlike(*own) <= limit)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    return both.mapInArrow(releasing(work), "a long, b long")


def member_sets(docs: DataFrame, groups: DataFrame, words: int) -> DataFrame:
    """grp, id, payload (the sorted hashes) of the documents in ``groups`` (id, component)."""
    known = groups.select(F.col("id").alias("doc_id"), F.col("component").alias("grp"))
    known = F.broadcast(known) if groups.count() <= BROADCAST_IDS else known
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(known, "doc_id").select("grp", "doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [own.astype("<u8").tobytes() for _, own in shingle_sets(batch.column(2), words)]
            for at in range(0, len(sets), 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets[at : at + 1000], pa.binary())], names=["grp", "id", "payload"])

    return texts.mapInArrow(releasing(work), "grp long, id long, payload binary").filter(F.length("payload") > 0)


def clean(docs: DataFrame, words: int, percent: int = 80) -> DataFrame:
    """One document of each group: the rows of ``docs`` whose doc_id is their component's
    smallest, with the same columns. Of several rows with one doc_id and the same text one
    stays, rows with other texts stay each; rows with a null doc_id all stay."""
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    found = scratch.write(near_duplicates(docs, words, percent).select("doc_id", "kept"), "kept")
    ids = found.filter("doc_id is not null").groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n"))
    ids = scratch.write(ids.filter("not kept or n > 1"), "ids")
    many = ids.filter("kept").select("doc_id")
    sized = lambda x: F.broadcast(x) if x.count() <= BROADCAST_IDS else x
    rest = docs.join(sized(ids.select("doc_id")), "doc_id", "left_anti").select(docs.columns)
    if not many.limit(1).count():
        return rest
    order = Window.partitionBy("doc_id", "text").orderBy("doc_id")
    again = docs.join(sized(many), "doc_id", "left_semi").withColumn("_rank", F.row_number().over(order))
    return rest.union(again.filter("_rank = 1").select(docs.columns))
