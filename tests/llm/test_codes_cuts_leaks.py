"""Vector codes, fill-in-middle and decontamination against plain Python."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import decontamination, fill_middle, vector_codes

LEAK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Plain loops over Python integers."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[2]))[:entries]
    books = [[cut(r[2], p) for r in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            own = {}
            for _, _, v in kept:
                own.setdefault(near(v, p)[1], []).append(cut(v, p))
            for k, vs in own.items():
                new[p][k] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
        books = new
    out = [(i, label, [near(v, p) for p in range(parts)]) for i, label, v in kept]
    made = [(i, label, [k for _, k in best], sum(d for d, _ in best)) for i, label, best in out]
    total = {}
    for _, label, _, error in made:
        total[label] = total.get(label, 0) + error
    return [(*r, total[r[1]]) for r in made], books


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, (rng.normal(size=8) * 0.01).tolist()) for i in range(1, 60)]
    rows += [(70 + i, None, rows[4][2]) for i in range(3)]  # ties and equal vectors, null labels
    rows += [rows[5], (None, 1, rows[6][2]), (80, 1, None), (81, 1, [None] + [0.0] * 7), (82, 2, [math.nan] + [0.0] * 7), (83, 2, [math.inf] * 8), (84, 2, [0.0] * 8)]
    return rows


def test_vector_codes(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_VALUES", 200)
    monkeypatch.setattr(vector_codes, "DISTANCE_ROWS", 7)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, label int, embedding array<double>, error int").repartition(3)
    made, books = vector_codes.compress(df, entries=8)
    want, want_books = brute_codes(rows, entries=8)
    key = lambda r: str(r)
    got = [(r.vec_id, r.label, list(r.codes), r.error, r.label_error) for r in made.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert books.tolist() == want_books
    assert vector_codes.books_sha256(books) == hashlib.sha256(",".join(str(c) for b in want_books for e in b for c in e).encode()).hexdigest()


def test_vector_codes_of_odd_tables(spark):
    kind = "vec_id long, label string, embedding array<float>"
    made, books = vector_codes.compress(spark.createDataFrame([], kind))
    assert made.count() == 0 and books.size == 0
    rows = [(1, "a", [0.5, 0.25, 0.5]), (2, "a", [0.5, 0.25, 0.5]), (3, None, [1.0]), (4, "b", [-0.5, 0.0, 1.0])]
    made, books = vector_codes.compress(spark.createDataFrame(rows, kind), parts=2)
    got = {r.vec_id: r for r in made.collect()}
    assert set(got) == {1, 2, 4} and all(r.error == 0 for r in got.values())  # another length takes no part; zeros fill up
    assert list(got[2].codes) == [0, 0] and got[4].label_error == 0 and books.shape == (2, 3, 2)
    assert made.filter("vec_id = 4").select(vector_codes.code_text()).first()[0] == "0202"
    far, _ = vector_codes.compress(spark.createDataFrame([(1, "a", [1e5, 0.0, 0.0, 0.0]), (2, "a", [-1e5, 0.0, 0.0, 0.0])], kind), entries=1)
    assert far.agg(F.sum("error")).first()[0] > 1 << 40  # beyond 32 bits


def cut_rows():
    rng = np.random.default_rng(8)
    rows = [(1, None), (2, ""), (3, "\n"), (4, "no end"), (5, "ends\n"), (6, "\n\n\n"), (7, "holds <M> x\ny"), (8, "é\nüü\r\n\U0001f600\n" * 5), (9, "<P\n<S\n>M>\n<"), (None, "a\nb\nc\nd")]
    rows += [(100 + i, "".join(rng.choice(["é", "b", "\n", "<", ">", "S"], rng.integers(0, 60)))) for i in range(150)]
    return [*rows, rows[7], (500, "x\n" * 5000 + "tail"), (501, "one line " * 300_000)]


def brute_cut(doc_id, text, fim=100):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    lo, hi = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:lo]), "".join(lines[lo:hi]), "".join(lines[hi:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= fim:
        return doc_id, len(lines), "plain", None, None, text
    if h[3] % 100 < 50:
        return doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("fim", [100, 40])
def test_fill_middle(documents, fim):
    rows = cut_rows()
    made = fill_middle.transform(documents(rows), fim_percent=fim)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = made.withColumn("text", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: str(r)
    assert sorted((tuple(r)[:6] for r in back), key=key) == sorted((brute_cut(i, t, fim) for i, t in rows), key=key)
    assert sorted(str((r.doc_id, r.text)) for r in back) == sorted(str((i, t or "")) for i, t in rows)
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    assert fill_middle.transform(documents([])).count() == 0


def test_express_lanes_reach_every_rank():
    rng = np.random.default_rng(1)
    units = np.array([0, 1, 2, 0, 3000, 17])
    points = rng.integers(0, 9, units.sum())
    lists = fill_middle.SkipLists(units, points)
    assert 5 <= len(lists.lanes) <= 14
    bottom = lists.lanes[0]
    assert all(len(a.units) >= len(b.units) for a, b in zip(lists.lanes, lists.lanes[1:], strict=False)) and len(bottom.units) == units.sum() + 6
    text = np.repeat(np.arange(6), units + 1)
    rank = np.concatenate([np.arange(n + 1) for n in units])
    edges = np.cumsum(units) - units
    want = [points[edges[t] : edges[t] + r].sum() for t, r in zip(text, rank, strict=True)]
    assert lists.points_before(text, rank).tolist() == want


def leak_words(text):
    return LEAK_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_leaks(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = leak_words(text)
        for i in range(len(w) - min(window, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, own = leak_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    own |= windows[k]
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(own), digest, bool(hit)))
    return out


def leak_tables():
    rng = np.random.default_rng(6)
    vocabulary = ["".join(rng.choice(list("abcé0"), 3)) for _ in range(60)]
    some = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    items = [(i, " ".join(some(int(rng.integers(8, 60))))) for i in range(1, 30)]
    items += [(40, None), (41, ""), (42, "!?"), (43, "solo9"), (44, "Two, WORDS"), (None, " ".join(some(12))), (2, " ".join(some(15))), (45, items[3][1]), (10, " ".join(some(11)))]
    docs = [(1, None), (2, ""), (3, "... !"), (4, "x solo9-y two\nwords ÀÉ"), (None, items[0][1].upper()), (5, " ".join(some(3000)))]
    for i in range(60):
        w = some(40)
        own = (items[i % 29][1] or "").split()
        at = i % max(1, len(own) - 12)
        w[10:10] = own[at : at + 5 + i % 12]
        docs.append((100 + i, "\n".join([" ,".join(w[:25]).title(), "¿".join(w[25:])]) if i % 3 else " ".join(w)))
    return [*docs, docs[-1], (7, (items[5][1] + " éé ") * 3000)], items


@pytest.mark.parametrize("bounds", [(200_000, 4096), (150, 13)])
def test_contamination(spark, documents, monkeypatch, bounds):
    monkeypatch.setattr(decontamination, "AUTOMATON_WORDS", bounds[0])
    monkeypatch.setattr(decontamination, "PIECE_WORDS", bounds[1])
    docs, items = leak_tables()
    table = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    found = decontamination.contamination(documents(docs), table)
    key = lambda r: str(r)
    assert sorted(map(tuple, decontamination.summary(found).collect()), key=key) == sorted(brute_leaks(docs, items), key=key)
    texts = {i: t for i, t in docs if i is not None}
    for r in found.filter("doc_id is not null").collect():
        w = leak_words(texts[r.doc_id])
        for s in r.spans:  # offsets of the original text
            assert leak_words(texts[r.doc_id][s.begin : s.end]) == w[s.first : s.last]
        assert all(a.last < b.first for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_contamination_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, list(r.spans), list(r.items)) for r in decontamination.contamination(documents([(1, "a b")]), none).collect()] == [(2, [], [])]
    assert decontamination.contamination(documents([]), none).count() == 0
