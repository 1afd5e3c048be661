"""The pipeline's stages one after another, and the queries against DuckDB."""

import os

import duckdb
import pytest

import corpus_pipeline
from riskloom.llm import queries

from .test_filters import base_rules
from .test_neardup import brute

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def test_pipeline_takes_each_stage_over_all_that_the_last_kept(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    seen, table = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf_small).cache()
        assert table.columns == docs.columns, name
        seen.append({r.doc_id: r for r in table.collect()})
    first, calm, last = seen
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(first) <= {i for i, t in texts.items() if not base_rules(t)[-1]} and len(first) > 0.7 * len(texts)
    assert all(len(r.text) == r.n_chars and len(r.text) <= len(texts[i]) for i, r in first.items())
    assert set(calm) <= set(first) and all(calm[i] == first[i] for i in calm)
    groups = brute([(i, r.text) for i, r in calm.items()], 5)
    assert set(last) == {c for _, _, c in groups}
    packed = corpus_pipeline.run(spark, sf_small).collect()
    whole = {}
    for r in packed:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
        assert r.length <= 2048
    assert set(whole) == set(last) and all(whole[r.doc_id] == r.doc_tokens for r in packed)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_small, t)}.parquet')")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    key = lambda r: tuple((x is not None, x) for x in r)
    rows = sorted(want.fetchall(), key=key)
    got = queries.QUERIES[name](spark, sf_small)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=key) == [tuple(r) for r in rows]


def test_every_operator_has_a_query(spark):
    assert [sum(k.startswith(f"op{n}_") for k in queries.QUERIES) for n in range(1, 14)] == [1] * 13
