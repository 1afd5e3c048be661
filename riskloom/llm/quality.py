"""Quality rules (operator 2): cross-document line frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.memo import distinct
from riskloom.llm.store import Scratch
from riskloom.llm.textscan import LOWER, SPACE, hash_spans, mix, per_row, releasing, row_slices, spans, text_bytes

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: A line goes if more than MAX_DOCS distinct documents of a host hold it, however large the
#: host.
MAX_DOCS = 20
#: A document is depleted if less than this share of its words is left.
MIN_LEFT = 0.3
MIN_WORDS = 50
#: Common lines that are joined with a broadcast (about 40 bytes each).
BROADCAST_LINES = 500_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ", ".join(f"{c} long" for c in COUNTS) + ", lines array<long>, line_words array<int>"


def _repeats(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each value stands in its row, and whether it's the first of its kind there."""
    keys, where, back = distinct(mix(values ^ mix(rows.astype(np.uint64) + _STEP)))
    first = np.zeros(len(values), bool)
    first[where] = True
    return np.bincount(back, minlength=len(keys))[back], first


def measure(column: pa.Array) -> Iterator[dict[str, np.ndarray | pa.Array]]:
    """Per run of rows the base counts, and the lines with their words.

    A line is normalised to its words in ASCII lower case, whatever stands between them."""
    data, starts = text_bytes(column)
    for first, last in row_slices(starts):
        raw, edges, n = data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], last - first
        is_word = ~SPACE[raw]
        begin, end, row = spans(is_word, edges)
        within = lambda mask: np.diff(np.append(0, np.cumsum(mask))[edges])
        out = {"rows": np.arange(first, last), "n_words": per_row(row, n)}
        out["word_chars"] = within(is_word & (raw & 0xC0 != 0x80))
        out["n_symbols"] = within(SYMBOLS[raw])
        # raw lines that hold a word
        line_begin, line_end, line_row = spans(raw != 0x0A, edges)
        filled = np.append(0, np.cumsum(is_word))
        worded = filled[line_end] > filled[line_begin]
        line_begin, line_end, line_row = line_begin[worded], line_end[worded], line_row[worded]
        _, new = _repeats(hash_spans(raw, line_begin, line_end), line_row)
        out["n_dup_lines"] = per_row(line_row[~new], n)
        # words in three-word windows that the text has more than once
        h = hash_spans(raw, begin, end)
        window = np.zeros(max(0, len(h) - 2), np.uint64)
        for j in range(3):
            window = mix((window + _STEP) ^ h[j : j + len(window)])
        whole = row[2:] == row[:-2] if len(row) > 2 else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        count, _ = _repeats(window[at], row[at])
        again = at[count > 1]
        marked = np.zeros(len(h), bool)
        for j in range(3):
            marked[again + j] = True
        out["n_repeat_words"] = per_row(row[marked], n)
        # the method's lines
        low = hash_spans(LOWER[raw], begin, end)
        line_of = np.searchsorted(line_begin, begin, "right") - 1
        heads = np.searchsorted(line_of, np.arange(len(line_begin)))
        place = np.arange(len(low)) - heads[line_of] if len(low) else np.zeros(0, np.int64)
        sums = np.add.reduceat(mix(low + place.astype(np.uint64) * _STEP), heads) if len(heads) else np.zeros(0, np.uint64)
        counts = np.searchsorted(line_row, np.arange(n + 1))
        out["lines"] = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(mix(sums).astype(np.int64)))
        sizes = np.diff(np.append(heads, len(low))).astype(np.int32)
        out["line_words"] = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(sizes))
        yield out


def document_key() -> Column:
    """What distinct documents are told apart by: the set of their normalised lines."""
    return F.xxhash64(F.array_sort(F.array_distinct("lines"))).alias("document")


def measures(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: _row (its number), doc_id, host (the source, or an empty name), what
    ``measure`` gives, and the columns in ``carry``."""
    kinds = dict(docs.dtypes)
    schema = f"_row long, doc_id long, host string, {SCHEMA}" + "".join(f", `c_{c}` {kinds[c]}" for c in carry)
    names = ["_row", "doc_id", "host", *COUNTS, "lines", "line_words", *(f"c_{c}" for c in carry)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for found in measure(batch.column(2)):
                own = batch.slice(int(found["rows"][0]), len(found["rows"]))
                made = (found[c] for c in (*COUNTS, "lines", "line_words"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + len(own))), *own.columns[:2], *(x if isinstance(x, pa.Array) else pa.array(x) for x in made), *own.columns[3:]],
                    names=names,
                )
                number += len(own)

    host = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host")
    own = docs.select(F.col("doc_id").cast("long"), host, F.col("text").alias("_text"), *(F.col(c).alias(f"c_{c}") for c in carry))
    return own.mapInArrow(releasing(work), schema)


def line_counts(made: DataFrame) -> DataFrame:
    """Per host and line: in how many documents it stands, and in how many distinct ones."""
    lines = made.select("host", document_key(), F.explode(F.array_distinct("lines")).alias("line"))
    distinct = lines.groupBy("host", "line", "document").agg(F.count("*").alias("n"))
    return distinct.groupBy("host", "line").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_distinct"))


def common_lines(made: DataFrame) -> DataFrame:
    """host, line, n_docs, n_distinct: the lines above the limit."""
    return line_counts(made).filter(F.col("n_distinct") > MAX_DOCS)


def assess(docs: DataFrame, scratch: Scratch, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row's measures, _at (the places of its common lines among its lines with words),
    n_left (words outside them), base_failed and kept. See ``quality_rules``."""
    made = scratch.write(measures(docs, carry), "measures")
    sized = lambda x: F.broadcast(x) if x.count() <= BROADCAST_LINES else x
    common = sized(scratch.write(common_lines(made).select("host", "line"), "common-lines"))
    lines = made.select("_row", "host", F.posexplode(F.arrays_zip("lines", "line_words")).alias("_place", "_line"))
    lines = lines.select("_row", "host", "_place", F.col("_line.lines").alias("line"), F.col("_line.line_words").alias("words"))
    gone = lines.join(common, ["host", "line"]).groupBy("_row").agg(F.collect_list("_place").alias("_at"), F.sum("words").alias("_gone"))
    left = F.col("n_words") - F.coalesce("_gone", F.lit(0))
    return (
        made.drop("lines", "line_words").join(gone, "_row", "left")
        .withColumn("n_left", left)
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= MIN_LEFT * F.col("n_words")))
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    and n_left for each row of ``docs`` (doc_id, text, source).

    Lines are hashed as their words in ASCII lower case. On each host a line is common if
    more than MAX_DOCS distinct documents hold it; documents with the same set of lines are
    one. A document that passes the base rules is depleted, and not kept, if less than MIN_LEFT
    of its words stand outside common lines.

    A null or empty text has no words and fails the base rules. A null source is a host of
    its own; a null doc_id stays null. Repeated rows are judged each. Whole texts count,
    however long. Other columns are left behind. An empty table gives no row.
    """
    made = assess(docs, Scratch(docs.sparkSession, "quality"))
    return made.select("doc_id", *(c for c in COUNTS), "base_failed", "kept", "n_left")


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` without their common lines, with the same columns. n_chars,
    where there is one, follows the new text."""
    columns = docs.columns
    made = assess(docs, Scratch(docs.sparkSession, "quality"), tuple(columns)).filter("kept")
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_at = columns.index("text")
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(text_at).to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                if gone:
                    drop, place, lines = set(gone), -1, []
                    for line in text.split("\n"):
                        place += (worded := any(c not in " \t\n\v\f\r" for c in line))
                        if not (worded and place in drop):
                            lines.append(line)
                    text = "\n".join(lines)
                texts.append(text)
            arrays = batch.columns[: len(columns)]
            arrays[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    places = "_at"
    while places in columns:
        places += "_"
    out = made.select(*(F.col(f"c_{c}").alias(c) for c in columns), F.col("_at").alias(places)).mapInArrow(releasing(work), schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in columns else out
