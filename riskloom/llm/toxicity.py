"""Toxicity by multiple-instance learning (operator 8).

A text is a bag of sentences. Each sentence has a logistic score of its words, a text's
score is their noisy-or, and only labels of whole texts are needed to learn both. The
sentence scores then tell where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch
from riskloom.llm.textscan import LOWER, hash_spans, mix, releasing, row_slices, spans, text_bytes

#: Labelled rows that the weights are fitted on, at most (about: they are drawn by a hash of
#: the id, so that the share fits the bound). Features are chosen by counts over all of them.
FIT_ROWS = 10_000
#: Labels that are joined with a broadcast (12 bytes each).
BROADCAST_LABELS = 1_000_000
BUCKETS = 1 << 20
#: Features kept for the fit: the most telling ones, by their log odds in standard errors.
FEATURES, MIN_ERRORS, MIN_TEXTS = 2048, 2.5, 4
PREFIXES, SUFFIX = (3, 4, 5), 4
THRESHOLD = 0.3
STEPS, RATE, DECAY = 200, 0.2, 0.05

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


@dataclass(frozen=True)
class Model:
    """Weights by feature bucket and the bias of a sentence; ``fitted`` is false where there
    was nothing to learn from, and then every score is 0."""

    weights: np.ndarray
    bias: float
    fitted: bool = True


def sentences(column: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """Per run of rows: for each sentence with a word its row and byte range, and for each
    feature its sentence and bucket. Features of a word (ASCII lower case) are the word, its
    first 3 to 5 bytes and its last 4."""
    data, starts = text_bytes(column)
    for first, last in row_slices(starts):
        raw, edges = LOWER[data[starts[first] : starts[last]]], starts[first : last + 1] - starts[first]
        begin, end, row = spans(_WORD[raw], edges)
        before = np.append(0, np.cumsum(_END[raw]))[begin] + row
        new = np.append(True, before[1:] != before[:-1]) if len(begin) else np.zeros(0, bool)
        sentence = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(begin))[: len(heads)] - 1
        size = end - begin
        parts = [hash_spans(raw, begin, end)]
        owner = [sentence]
        for k in PREFIXES:
            fits = size >= k
            parts.append(mix(hash_spans(raw, begin[fits], begin[fits] + k) + np.uint64(k)))
            owner.append(sentence[fits])
        fits = size >= SUFFIX
        parts.append(mix(hash_spans(raw, end[fits] - SUFFIX, end[fits]) + np.uint64(77)))
        owner.append(sentence[fits])
        yield {
            "first": first, "rows": last - first, "row": row[heads], "begin": begin[heads] - edges[row[heads]], "end": end[tails] - edges[row[heads]] if len(heads) else heads,
            "sentence": np.concatenate(owner), "bucket": (np.concatenate(parts) >> np.uint64(44)).astype(np.int64),
        }


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learns from the labelled rows that aren't held out, ``rows`` of them at most.

    Counts of texts by feature and label are gathered over all of them (at most BUCKETS
    rows), the most telling FEATURES are kept, and what a sample has of those is fitted on the
    driver: what it gets is bounded by the parameters, whatever the size of the corpus. Null
    labels and ids are left out; of several labels of an id the largest holds. Features that
    tie are taken by their number. Without labels of both kinds, or without texts that have
    them, the model is not fitted and scores 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).dropna().filter(~held_out())
    known = scratch.write(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    total = known.count()
    share = int(min(1.0, rows / max(total, 1)) * (1 << 20))
    known = F.broadcast(known) if total <= BROADCAST_LABELS else known
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(known, "doc_id")
    drawn = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int32)
        seen = [0, 0]
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False) > 0
            for x in sentences(batch.column(1)):
                own = toxic[x["first"] : x["first"] + x["rows"]]
                seen[0] += int((~own).sum())
                seen[1] += int(own.sum())
                keys = np.unique(x["row"][x["sentence"]] * BUCKETS + x["bucket"])
                row, bucket = keys // BUCKETS, keys % BUCKETS
                for side in (0, 1):
                    np.add.at(sums[side], bucket[own[row] == bool(side)], 1)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), *(pa.array(np.append(sums[s][at], seen[s]).astype(np.int64)) for s in (0, 1))], names=["bucket", "clean", "toxic"])

    counts = texts.select("toxic", "text").mapInArrow(releasing(count), "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = scratch.write(counts.filter(f"bucket < 0 or clean + toxic >= {MIN_TEXTS}"), "counts")
    whole = counts.filter("bucket < 0").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, False)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (whole["toxic"] + 1 - a)) - F.log(b / (whole["clean"] + 1 - b))
    told = counts.filter("bucket >= 0").select("bucket", (F.abs(odds) / F.sqrt(1 / a + 1 / b)).alias("errors")).filter(F.col("errors") >= MIN_ERRORS)
    best = told.orderBy(F.desc("errors"), "bucket").limit(FEATURES).collect()
    chosen = np.array([r["bucket"] for r in best], np.int64)
    place = np.full(BUCKETS, -1, np.int16)
    place[chosen] = np.arange(len(chosen))
    places = spark.sparkContext.broadcast(place)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False) > 0
            for x in sentences(batch.column(1)):
                feature = places.value[x["bucket"]]
                has = feature >= 0
                sentence, feature = x["sentence"][has], feature[has]
                keys = np.unique(sentence * FEATURES + feature)  # a feature counts once a sentence
                sentence, feature = keys // FEATURES, keys % FEATURES
                row = x["row"][sentence]
                cuts = np.searchsorted(row, np.arange(x["rows"] + 1))
                plain = np.bincount(x["row"], minlength=x["rows"])
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(v.astype(np.int32))) for v in (sentence, feature)]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[x["first"] : x["first"] + x["rows"]]), pa.array(plain), *lists], names=["toxic", "sentences", "at", "features"])

    made = drawn.mapInArrow(releasing(reduce), "toxic boolean, sentences long, at array<int>, features array<int>").toArrow()
    places.unpersist()
    return learn(made, chosen)


def learn(made: pa.Table, chosen: np.ndarray) -> Model:
    """Gradient descent (with momentum and scaled steps) on the noisy-or likelihood."""
    toxic = made.column("toxic").to_numpy()
    plain = made.column("sentences").to_numpy().astype(np.int64)
    at, features = (made.column(c).combine_chunks() for c in ("at", "features"))
    doc = np.repeat(np.arange(len(toxic), dtype=np.int32), np.diff(at.offsets.to_numpy()))
    local, feature = at.values.to_numpy(), features.values.to_numpy()
    new = np.append(True, (doc[1:] != doc[:-1]) | (local[1:] != local[:-1])) if len(doc) else np.zeros(0, bool)
    sentence = (np.cumsum(new) - 1).astype(np.int32)
    doc = doc[new]
    plain = plain - np.bincount(doc, minlength=len(toxic))  # sentences without a feature
    w, bias = np.zeros(len(chosen)), -5.0
    moment = [np.zeros(len(chosen) + 1) for _ in range(2)]
    for step in range(1, STEPS + 1):
        _, grad = likelihood(w, bias, toxic, plain, doc, sentence, feature)
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad**2
        move = RATE * moment[0] / (1 - 0.9**step) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights = np.zeros(BUCKETS, np.float32)
    weights[chosen] = w
    return Model(weights, float(bias))


def likelihood(
    w: np.ndarray, bias: float, toxic: np.ndarray, plain: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray
) -> tuple[float, np.ndarray]:
    """The mean negative log likelihood of the labels with its penalty, and the gradient by the
    weights and the bias. doc: each sentence's text; sentence, feature: what stands where;
    plain: sentences of each text without a feature."""
    z = bias + np.bincount(sentence, w[feature], len(doc)) if len(doc) else np.zeros(0)
    clear = -np.logaddexp(0, z)  # log of the chance that a sentence is clean
    quiet = -np.logaddexp(0, bias)
    log_clean = np.bincount(doc, clear, len(toxic)) + plain * quiet
    p = np.maximum(-np.expm1(log_clean), 1e-9)
    loss = np.where(toxic, -np.log(p), -log_clean).mean() + DECAY / len(toxic) / 2 * (w * w).sum()
    pull = np.where(toxic, -np.exp(log_clean) / p, 1.0) / len(toxic)
    by_sentence = pull[doc] / (1 + np.exp(-z))
    grad = np.append(
        np.bincount(feature, by_sentence[sentence], len(w)) + DECAY / len(toxic) * w,
        by_sentence.sum() + (pull * plain).sum() / (1 + np.exp(-bias)),
    )
    return float(loss), grad


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score, predicted and offences (begin, end: bytes of the text; score) of each row
    of ``docs`` (doc_id, text), and the columns in ``carry`` as c_<name>.

    The offences are the sentences that alone reach the threshold. An empty or null text, and
    one without words, has no sentence and scores 0. Null ids stay null; repeated rows are
    scored each; whole texts are read, however long.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)
    schema = "doc_id long, score double, predicted int, offences array<struct<begin:long,end:long,score:double>>"
    names = ["doc_id", "score", "predicted", "offences", *(f"c_{c}" for c in carry)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        for batch in batches:
            for x in sentences(batch.column(1)):
                n = len(x["row"])
                keys = x["sentence"] * BUCKETS + x["bucket"]
                hit = np.unique(keys[own.weights[x["bucket"]] != 0])
                z = own.bias + np.bincount(hit // BUCKETS, own.weights[hit % BUCKETS], n) if n else np.zeros(0)
                p = 1 / (1 + np.exp(-z)) * own.fitted
                value = -np.expm1(np.bincount(x["row"], -np.logaddexp(0, z) * own.fitted, x["rows"])) + 0.0
                bad = np.flatnonzero(p >= threshold)
                cuts = pa.array(np.searchsorted(x["row"][bad], np.arange(x["rows"] + 1)), pa.int32())
                items = pa.StructArray.from_arrays([pa.array(x["begin"][bad]), pa.array(x["end"][bad]), pa.array(p[bad])], names=["begin", "end", "score"])
                part = batch.slice(x["first"], x["rows"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32)), pa.ListArray.from_arrays(cuts, items), *part.columns[2:]], names=names
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").alias("_text"), *(F.col(c).alias(f"c_{c}") for c in carry))
    return rows.mapInArrow(releasing(work), schema + "".join(f", `c_{c}` {kinds[c]}" for c in carry))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Learns from ``labels`` (doc_id, toxic) and scores all of ``docs``: doc_id, held_out, score,
    predicted, offences. See ``fit`` and ``score``. Null and empty texts score 0, repeated rows
    come back each, other columns are left behind; without labels all score 0; an empty table
    gives no row."""
    return score(docs, fit(docs, labels), threshold).withColumn("held_out", held_out())


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with the same columns."""
    columns = docs.columns
    made = score(docs, fit(docs, labels), threshold, tuple(columns)).filter("predicted = 0")
    return made.select(*(F.col(f"c_{c}").alias(c) for c in columns))
