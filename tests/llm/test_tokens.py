"""Counts, pieces, packing and training order against the tokenizer libraries."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import byte_tokens, packing, pieces, token_counts, training_order
from riskloom.llm.files import locate
from riskloom.llm.memo import safe_breaks
from riskloom.llm.store import new_path

MODEL, BYTES, WORDS = path("piece_bpe_32k.model"), path("byte_bpe_50k.json"), path("word_bpe_49k.json")
ODD = [
    "", None, " ", "  ", " a", "a ", "a  b", "日本 語 ▁x ▁", "a b", "a  b c", "\x00 x", "é è\n\n  q",
    "🙂🙃 z 🙂", "xxxxx   y", "<s> </s> <0x0A> <unk>", "it's we'll 'd a", "tab\t x\t\ty", "a <|endoftext|> b<|endoftext|>",
    "one two three", "one two three", "Wort für Wort, ça va ? ¿qué?", "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture
def odd(documents):
    return documents([(i if i != 3 else None, t) for i, t in enumerate(ODD)])


def test_breaks_are_single_blanks_between_plain_characters():
    data = np.frombuffer("a b  c é d  e".encode(), np.uint8)
    assert safe_breaks(data).tolist() == [1, 6, 9]


def test_piece_ids_and_spans_are_the_librarys(library):
    own = pieces.engine(MODEL, True)
    got = [x for _, rows in pieces.encoded_rows(own, pa.array(ODD)) for x in rows]
    for text, (ids, begin, end) in zip(ODD, got, strict=True):
        want = library.encode(text or "", return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want]
        assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(p.begin, p.end) for p in want]


def test_long_text_in_parts(library):
    text = "Ein langer Text, ohne Ende. " * 200_000
    own = pieces.engine(MODEL, True)
    ((_, ((ids, begin, end),)),) = pieces.encoded_rows(own, pa.array([text]))
    assert ids.tolist() == library.encode(text)
    assert begin[0] == 0 and end[-1] == len(text) and (begin[1:] == end[:-1]).all()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_character_map_is_the_librarys(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    own = pieces.CharMap(library.serialized_model_proto())
    for text in ("ﬁne Ａ  ｂ ①㍿ x y  ", "é é \t q", "  lead", "", "   ", "ǅ ß Å"):
        got, origin = own.normalise(text.encode())
        assert got.decode() == library.normalize(text)
        assert len(origin) == len(got) + 1 and origin == sorted(origin)


def test_encode_decode(odd, library):
    rows = {r.doc_id: r for r in pieces.encode_decode(odd, MODEL).collect()}
    assert len(rows) == len(ODD)
    apart = {r.doc_id: r for r in pieces.decode(pieces.encode(odd, MODEL), MODEL).collect()}
    for i, text in enumerate(ODD):
        row = rows[i if i != 3 else None]
        assert row.ids == library.encode(text or "") and row.decoded == library.decode(row.ids)
        assert apart[row.doc_id].decoded == row.decoded
        raw = (text or "").encode()
        assert all(raw[b:e].decode() is not None for b, e in zip(row.begins, row.ends, strict=True))


@pytest.mark.parametrize("file", [MODEL, BYTES, WORDS])
def test_counts(odd, library, file):
    rows = {r.doc_id: r for r in token_counts.count_tokens(odd, file, limit=2999).collect()}
    other = None if file == MODEL else Tokenizer.from_file(file)
    for i, text in enumerate(ODD):
        want = library.encode(text or "") if file == MODEL else other.encode(text or "", add_special_tokens=False).ids
        row = rows[i if i != 3 else None]
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (len(want), len((text or "").encode()), len(want) > 2999)


def test_byte_ids_are_the_librarys():
    other = Tokenizer.from_file(BYTES)
    got = [x for _, rows in byte_tokens.token_rows(byte_tokens.engine(BYTES), pa.array(ODD)) for x in rows]
    assert [x.tolist() for x in got] == [other.encode(t or "", add_special_tokens=False).ids for t in ODD]


def test_empty_tables(documents):
    none = documents([])
    assert token_counts.count_tokens(none, MODEL).count() == 0
    assert pieces.encode_decode(none, MODEL).count() == 0
    assert packing.pack(none, BYTES).count() == 0
    assert training_order.training_order(none, BYTES).count() == 0


def test_histogram_packs_every_piece_once():
    rng = np.random.default_rng(3)
    for most in (7, 64, 2048):
        histogram = {int(k): int(rng.integers(1, 400)) for k in rng.integers(1, most + 1, 60)}
        fill = {}
        for length, rank, count, sequence, offset in packing.pack_histogram(histogram, most):
            for i in range(count):
                fill.setdefault(sequence + i, []).append((offset, length, rank + i))
        seen = sorted((length, rank) for x in fill.values() for _, length, rank in x)
        assert seen == [(length, i) for length in sorted(histogram) for i in range(histogram[length])]
        for x in fill.values():
            x.sort()
            assert [o for o, _, _ in x] == [sum(y[1] for y in x[:i]) for i in range(len(x))]
            assert sum(y[1] for y in x) <= most
        total = sum(k * n for k, n in histogram.items())
        assert len(fill) <= 1.15 * total / most + 2


@pytest.mark.parametrize("ranked", [5, 100_000])
def test_pack(documents, monkeypatch, ranked):
    monkeypatch.setattr(packing, "BUCKET_ROWS", ranked)
    texts = ODD + ["same text here"] * 40
    docs = documents([(i if i != 3 else None, t) for i, t in enumerate(texts)])
    rows = packing.pack(docs, BYTES, max_tokens=64).collect()
    other = Tokenizer.from_file(BYTES)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*other.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[i if i != 3 else None], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(ids))
        assert sum(r.length for r in own) == len(ids)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= 64


@pytest.mark.parametrize("size", [1, 2, 3, 5, 17, 64, 1000, 4097])
def test_permutation_is_a_bijection_that_the_key_chooses(size):
    slots = training_order.permute(np.arange(size), size, "a")
    assert sorted(slots.tolist()) == list(range(size))
    if size > 60:
        assert slots.tolist() != training_order.permute(np.arange(size), size, "b").tolist()
        assert np.abs(np.corrcoef(np.arange(size), slots)[0, 1]) < 0.3


def test_training_order(spark, documents):
    docs = documents([(i if i != 3 else None, t) for i, t in enumerate(ODD)])
    folder = new_path(spark, "shards")
    index = training_order.materialise(docs, BYTES, folder, "k", tokens=16, shard_rows=100)
    rows = index.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    other, by_doc = Tokenizer.from_file(BYTES), {}
    for r in rows:
        store, path = locate(training_order.shard_path(folder, r.shard))
        raw = store.open_input_stream(path, compression=None).read()
        assert (r.shard, r.offset) == (r.slot // 100, r.slot % 100 * 32)
        by_doc.setdefault(r.doc_id, {})[r.seq_no] = np.frombuffer(raw[r.offset : r.offset + 32], "<u2")[: r.n_tokens]
    for i, text in enumerate(ODD):
        own = by_doc[i if i != 3 else None]
        assert np.concatenate([own[k] for k in range(len(own))]).tolist() == [*other.encode(text or "", add_special_tokens=False).ids, 1]
    read = training_order.read_shards(spark, index, folder, BYTES, 16, resume_at=150, shard_rows=100).collect()
    assert sorted(r.slot for r in read) == list(range(150, len(rows)))
    again = training_order.training_order(docs.filter("doc_id > 3"), BYTES)
    assert again.agg(F.count("*"), F.countDistinct("slot")).first()[0] == again.select("slot").distinct().count()


def test_digests_of_the_query(spark, sf_small, library):
    from riskloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in QUERIES["op10_pieces"](spark, sf_small).collect():
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
