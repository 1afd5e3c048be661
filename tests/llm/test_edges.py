"""Columns with the operators' own names, and odd tables for the pipeline."""

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import decontamination, fill_middle, licences, neardup, packing, pieces, quality, token_counts, toxicity, training_order

from .test_filters import some_words

MODEL, BYTES = path("piece_bpe_32k.model"), path("byte_bpe_50k.json")
#: Names of columns that some operator adds.
OWN = (
    "n_tokens", "n_bytes", "over_limit", "n_shingles", "component_id", "kept", "component", "grp", "start", "length", "ids_crc32", "doc_tokens",
    "sequence_id", "offset", "slot", "shard", "seq_no", "ids", "begins", "ends", "decoded", "n_left", "hits", "offences", "held_out", "form", "output",
    "spans", "items", "_row", "_part", "_at", "_bucket", "host", "lines", "u", "v", "a", "b", "n", "rep", "bits", "bands", "c_text", "toxic",
)


@pytest.fixture
def clashing(documents):
    """Documents with every such column, each full of text."""

    def make(rows):
        return documents(rows).withColumns({c: F.lit(f"own {c}") for c in OWN})

    return make


ROWS = [(1, "one two three four\nfive"), (2, None), (None, "x y z"), (3, ""), (1, "one two three four\nfive"), (4, "under the mit license " * 20)]


def test_columns_with_the_operators_own_names(spark, clashing, documents):
    labels = spark.createDataFrame([(1, 1, "t"), (4, 0, "t")], "doc_id long, toxic int, score string")
    items = spark.createDataFrame([(7, "two three four", "x")], "item_id long, text string, spans string")
    operators = [
        lambda d: quality.quality_rules(d),
        lambda d: token_counts.count_tokens(d, MODEL),
        lambda d: neardup.near_duplicates(d, 2),
        lambda d: training_order.training_order(d, BYTES),
        lambda d: licences.scan(d),
        lambda d: packing.pack(d, BYTES),
        lambda d: toxicity.toxicity(d, labels),
        lambda d: pieces.encode_decode(d, MODEL),
        lambda d: fill_middle.transform(d),
        lambda d: decontamination.contamination(d, items),
    ]
    shown = lambda df: sorted(map(str, df.collect()))
    for operator in operators:
        got, plain = operator(clashing(ROWS)), operator(documents(ROWS))
        assert got.columns == plain.columns
        if operator is not operators[5]:  # pieces that tie in packing may change places
            assert shown(got) == shown(plain)
    for clean in (lambda d: quality.clean(d), lambda d: toxicity.clean(d, labels), lambda d: neardup.clean(d, 2)):
        docs = clashing(ROWS)
        made = clean(docs)
        assert made.columns == docs.columns
        assert all(r[c] == f"own {c}" for r in made.collect() for c in OWN)


def run_pipeline(spark, folder, rows, labels, documents):
    docs = documents(rows).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, score string").write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_pipeline_on_odd_tables(spark, tmp_path, clashing):
    rng = np.random.default_rng(4)
    text = lambda: some_words(rng, 80)
    same, copied = text(), text()
    rows = [(1, same), (1, same), (1, text()), (2, copied), (3, copied), (None, text()), (None, None), (4, None), (5, ""), (6, "too short"), (7, copied.replace(copied[:5], "other", 1))]
    rows += [(20 + i, text()) for i in range(10)]
    got = run_pipeline(spark, tmp_path, rows, [(1, 0, "x"), (2, 1, "y"), (None, 1, "z"), (99, None, "z")], clashing)
    whole = {}
    for r in got:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert set(whole) == {1, 2, None, *range(20, 30)}
    library = Tokenizer.from_file(BYTES)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids) + 1
    assert whole[1] == size(same) + size(rows[2][1])  # equal rows of an id once, its other text too
    assert whole[2] == size(copied) and whole[None] == size(rows[5][1])


def test_pipeline_on_empty_tables(spark, tmp_path, clashing):
    assert run_pipeline(spark, tmp_path, [], [], clashing) == []

