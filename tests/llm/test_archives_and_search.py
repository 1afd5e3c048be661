"""WARC round trips and nearest neighbours against brute force."""

import hashlib
import struct

import numpy as np
import pytest
import zstandard

from riskloom.llm import ann, warc
from riskloom.llm.files import locate
from riskloom.llm.store import Scratch, new_path


@pytest.fixture
def pages(spark):
    long, short = "<p>" + "same " * 60, "<p>tiny</p>"
    rows = [(5, "http://a/ b\r\nX: y", long), (3, None, long), (9, "http://c/", long), (1, "http://d/", short), (2, "http://d/", short), (4, "u", None), (6, "u", ""), (7, "u", "é\r\n\r\nWARC/1.1\r\n" * 30), (None, "u", long), (8, "u", "x" * 700_000), (3, "again", long)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string"), rows


@pytest.mark.parametrize("frame, bundle", [(256 << 10, 64 << 20), (300, 400)])
def test_warc_round_trip(spark, pages, monkeypatch, frame, bundle):
    monkeypatch.setattr(warc, "FRAME_BYTES", frame)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", bundle)
    frame_rows, rows = pages
    folder = new_path(spark, "warc")
    index = warc.write_archives(frame_rows, folder)
    got = warc.read_archives(index, folder).collect()
    assert len(got) == len(rows) == index.count()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 100 and i != first.get(html or "")
        want.append((i if i is not None else -1, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else -1, None if revisit else raw))
    key = lambda r: (r[0], r[1], r[3])
    have = [(r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to if r.refers_to is not None else -1, r.payload if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    some = index.filter("page_id in (7, 8, 9)")
    fetched = {r.page_id: r for r in warc.fetch(some, folder).collect()}
    assert set(fetched) == {7, 8, 9} and bytes(fetched[8].payload) == b"x" * 700_000 and fetched[9].refers_to == 3


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, pages):
    folder = new_path(spark, "warc")
    index = warc.write_archives(pages[0], folder)
    for name in {r.bundle for r in index.collect()}:
        store, path = locate(f"{folder}/{name}")
        raw = store.open_input_stream(path, compression=None).read()
        count, _, magic = struct.unpack("<IBI", raw[-9:])
        assert magic == warc.SEEKABLE
        with store.open_input_file(path) as file:
            frames = warc.seek_table(file)
        assert len(frames) == count
        text = b"".join(zstandard.ZstdDecompressor().decompress(raw[a : a + n]) for a, n in frames)
        assert text.count(b"WARC-Record-ID") == index.filter(index.bundle == name).count()
        assert raw[sum(n for _, n in frames) :][:4] == struct.pack("<I", warc.SKIPPABLE)


def test_empty_archive(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute(rows, every, k):
    best = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            best[i] = min(best.get(i, v), v)
    out = []
    for q, a in best.items():
        if q % every == 0:
            found = sorted((-sum(np.float64(x) * np.float64(y) for x, y in zip(a, b, strict=True)), i) for i, b in best.items() if i != q and len(b) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("leaf, shard, block", [(4, 50, 7), (128, 16384, 16384)])
def test_exact_search_at_factor_one(spark, monkeypatch, leaf, shard, block):
    monkeypatch.setattr(ann, "LEAF", leaf)
    monkeypatch.setattr(ann, "SHARD_ROWS", shard)
    monkeypatch.setattr(ann, "QUERY_ROWS", block)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(160, 5)).round(1) * rng.uniform(0.2, 3, (160, 1)).round(1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(200 + i, x[3].tolist()) for i in range(30)] + [(300, None), (301, []), (302, [0.0] * 5), (303, [1.0, None, 0.0, 0.0, 0.0]), (304, [float("nan")] * 5), (305, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    rows += [(None, [1.0] * 5), (40, x[9].tolist()), (40, x[40].tolist()), (400, [1.0, 2.0]), (404, [2.0, 1.0])]
    vectors = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, rank string, shard int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.neighbours(vectors, 4, 6, factor=1).collect())
    want = brute(rows, 4, 6)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    np.testing.assert_allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def test_recall_at_the_factor_of_the_query(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = Scratch(spark, "test").write(ann.trees(vectors, 21), "index")
    queries = vectors.filter("vec_id % 20 = 0")
    near = {(r.query_id, r.vec_id) for r in ann.search(index, queries, 20).collect()}
    exact = {(r.query_id, r.vec_id) for r in ann.search(index, queries, 20, factor=1).collect()}
    assert len(exact) == 20 * queries.count() and len(near & exact) >= 0.95 * len(exact)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.neighbours(none, 20, 20).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert ann.neighbours(one, 20, 20).count() == 0
