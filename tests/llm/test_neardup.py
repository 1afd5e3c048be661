"""Near-duplicates against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest

from riskloom.llm import blocks, neardup
from riskloom.llm import components as C
from riskloom.llm.components import components
from riskloom.llm.store import Scratch


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute(rows, words, percent=80):
    sets, parent = [shingles(t, words) for _, t in rows], {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if i is not None and j is not None and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted((i if i is not None else -1, len(s), root(i) if i is not None else -1) for (i, _), s in zip(rows, sets, strict=True))


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  Two\n"), (None, "one two"), (8, "a a a a"), (9, "a a a a a")]
    n = 20
    for size, copies in ((6, 5), (40, 12), (120, 60), (2500, 4)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(max(1, size // 14) + 1)):
                own[rng.randrange(size)] = word()
            rows.append((n, " ".join(own)))
            n += 1
    chain = [word() for _ in range(60)]  # each near its neighbour, the ends far apart
    for step in range(14):
        rows.append((n, " ".join([*(word() for _ in range(0)), *chain[step * 2 :], *("x%d" % k for k in range(step * 2))])))
        n += 1
    rows += [(n + i, " ".join(word() for _ in range(rng.randrange(1, 80)))) for i in range(60)]
    rows += [rows[12], rows[12]]  # repeated rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, block, rounds", [(2, 1024, (4, 44)), (5, 1024, (4, 44)), (2, 8, (1, 11, 36))])
def test_components_are_those_of_all_pairs(documents, monkeypatch, words, block, rounds):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", block)
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    rows = corpus()
    got = neardup.near_duplicates(documents(rows), words).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got) == brute(rows, words)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [300, 900])
def test_groups_of_few_long_rows_leave_blocks_empty(documents, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    rng = random.Random(11)
    rows = []
    for n in range(24):  # groups of two or three copies, each copy longer than a block
        base = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(120)]
        for copy in range(2 + n % 2):
            rows.append((10 * n + copy, " ".join([*base[:60], f"x{copy}", *base[61:]])))
    got = neardup.near_duplicates(documents(rows), 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 2)


def test_an_id_with_two_texts_is_one_document(documents):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "k l m n"), (3, "k l m n"), (4, "p q")]
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(documents(rows), 2).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_clean_keeps_one_of_each_group(documents):
    rows = corpus()
    kept = sorted(r.doc_id for r in neardup.clean(documents(rows), 2).collect() if r.doc_id is not None)
    assert kept == sorted({c for i, _, c in brute(rows, 2) if i >= 0})
    several = [(1, "a b c d"), (1, "a b c d"), (1, "k l m n"), (2, "k l m n"), (None, "p q"), (None, "p q")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in neardup.clean(documents(several), 2).collect()))) == sorted(
        map(str, [(1, "a b c d"), (1, "k l m n"), (None, "p q"), (None, "p q")])
    )


def test_a_large_group_meets_in_the_first_round_only(spark, documents, monkeypatch):
    """Later rounds leave out the buckets whose classes hang together already."""
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    rows = []
    for i in range(400):
        own = list(base)
        own[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(100))) for i in range(50)]
    seen = []
    inner = neardup.block_links

    def counted(members, matrix, scratch):
        seen.append(members.count())
        return inner(members, matrix, scratch)

    monkeypatch.setattr(neardup, "block_links", counted)
    got = neardup.near_duplicates(documents(rows), 2).collect()
    assert all(r.component_id == (0 if r.doc_id < 1000 else r.doc_id) for r in got)
    assert sum(seen[:-1]) <= 12 * 400  # of 48 bands


def test_empty(documents):
    assert neardup.near_duplicates(documents([]), 2).count() == 0
    assert neardup.clean(documents([(1, None), (2, "")]), 2).count() == 2


def test_exact_matrix():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(80)]
    got = neardup.set_matrix(50)([s.tobytes() for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * both >= 50 * (len(a) + len(b) - both))


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(2)
    for similarity in (0.0, 0.5, 0.8):
        values = []
        for _ in range(20):
            pool = rng.integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2)
            shared = int(2000 * similarity / (1 + similarity))
            a, b = pool[:1000], np.concatenate([pool[1000 - shared : 1000], pool[1000 : 2000 - shared]])
            bits = neardup.low_bits(np.array([neardup.minima(a), neardup.minima(b)])).view(np.uint64)
            agree = 1 - neardup.unlike(bits[:1], bits[1:])[0] / neardup.HASHES
            values.append((agree - 0.25) / 0.75)
        assert abs(np.mean(values) - shared / (2000 - shared)) < 0.04


@pytest.mark.parametrize("hub, few", [(1, 0), (256, 0), (256, 20_000)])
def test_connected_components(spark, monkeypatch, hub, few):
    monkeypatch.setattr(C, "HUB_LINKS", hub)
    monkeypatch.setattr(C, "SMALL_LINKS", few)
    rng = random.Random(5)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(500, 540)] + [(900, 900)] + [(600, i) for i in range(601, 640)] + [(640, i) for i in range(620, 660)]
    parent = {x: x for p in pairs if p[0] != p[1] for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "test")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)
