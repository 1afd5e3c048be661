"""Quality rules, licence scans and toxicity."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import licences, quality, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            marked |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed


def some_words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghijklm"), 5)) for _ in range(n))


def quality_corpus():
    rng = np.random.default_rng(4)
    common = some_words(rng, 12)
    rows = [(1, None), (2, ""), (3, "a b c a b c\nx\nx\n\n x"), (4, "é #x |\nA b\na  B"), (None, "x " * 60), (5, "q\r\nq\r\n"), (6, "one two three " * 30)]
    rows += [(100 + i, some_words(rng, 80) + "\n" + common.upper() + "\n" + some_words(rng, 10)) for i in range(60)]  # clean, with a common line
    base = [some_words(rng, 20) for _ in range(6)]
    rows += [(200 + i, "\n".join(base)) for i in range(60)]  # a family of exact copies
    for i in range(60):  # near copies: one line of the family changes
        own = [some_words(rng, 20) for _ in range(5)] if i < 0 else list(base)
        own[i % 6] = own[i % 6].replace(own[i % 6].split()[i % 20], "changed%d" % i)
        rows.append((300 + i, "\n".join(own)))
    rows += [(400 + i, "\n".join([common] * 5) + "\n" + some_words(rng, 12)) for i in range(3)]  # little beside common lines
    return rows


def dealt(rows):
    """Words outside common lines of each row, by plain counts: rows are (id, text, host)."""
    low = lambda line: tuple(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORDS.findall(line))
    lines = [[low(x) for x in (text or "").split("\n") if WORDS.search(x)] for _, text, _ in rows]
    holders = {}
    for own, (_, _, host) in zip(lines, rows, strict=True):
        for line in own:
            holders.setdefault((host, line), set()).add(frozenset(own))
    return [sum(len(x) for x in own if len(holders[host, x]) <= quality.MAX_DOCS) for own, (_, _, host) in zip(lines, rows, strict=True)]


def test_quality(documents):
    rows = quality_corpus()
    got = {r.doc_id: r for r in quality.quality_rules(documents(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_rules(text)
        assert r.kept <= (not r.base_failed)
    for (i, _), left in zip(rows, dealt([(*r, "") for r in rows]), strict=True):
        assert got[i].n_left == left and got[i].kept == (not got[i].base_failed and left >= quality.MIN_LEFT * got[i].n_words)
    assert all(got[100 + i].kept and got[100 + i].n_left == 90 for i in range(60))
    assert got[400].n_left == 12 and not got[400].kept


def test_depleted_and_cleaned(documents):
    rng = np.random.default_rng(5)
    lines = [some_words(rng, 12) for _ in range(5)]
    rows = [(i, "\n".join([some_words(rng, 70), *lines])) for i in range(40)]
    rows += [(100, "\n".join([*lines, some_words(rng, 15)])), (101, some_words(rng, 60))]
    got = {r.doc_id: r for r in quality.quality_rules(documents(rows)).collect()}
    assert not got[100].base_failed and not got[100].kept and got[100].n_left == 15
    kept = {r.doc_id: r.text for r in quality.clean(documents(rows)).collect()}
    assert kept[101] == rows[-1][1] and 100 not in kept
    assert all(kept[i] == rows[i][1].split("\n")[0] for i in range(40))


def test_common_lines_against_plain_counts(documents):
    rows = [(i, t, f"host{i % 2}" if i else None) for i, t in quality_corpus()]
    docs = documents(rows)
    got = {(r.host, r.line): (r.n_docs, r.n_distinct) for r in quality.line_counts(quality.measures(docs)).collect()}
    want = Counter()
    for _, text, host in rows:
        lines = {tuple(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORDS.findall(line)) for line in (text or "").split("\n")}
        want.update((host or "", line) for line in lines if line)
    assert sorted(n for n, _ in got.values()) == sorted(want.values())
    assert all(1 <= distinct <= n for n, distinct in got.values())


@pytest.mark.parametrize("shared", [70, 80, 90, 95, 96, 97, 99])
def test_pages_of_mostly_shared_lines_are_depleted(documents, shared):
    """A host with nothing but pages of the same navigation and a few words of their own."""
    rng = np.random.default_rng(shared)
    navigation = [some_words(rng, 10) for _ in range(shared // 5)]  # 200 words a page
    rows = []
    for i in range(60):
        lines = list(navigation)
        lines.insert(i % len(lines), some_words(rng, 200 - 2 * shared))
        rows.append((i, "\n".join(lines), "pages"))
    rows += [(100 + i, rows[i][1], "pages") for i in range(30)]  # copies of some of them
    base = some_words(rng, 150).split()
    for i in range(75):  # a family of copies, each with one word changed
        own = [*base[: 2 * i], f"x{i}", *base[2 * i + 1 :]]
        rows.append((200 + i, "\n".join(" ".join(own[at : at + 10]) for at in range(0, 150, 10)), "near copies"))
    rows += [(300 + i, "\n".join(base[:60] if i % 2 else reversed(base[:60])), "copies") for i in range(80)]  # the same lines
    got = {r.doc_id: r for r in quality.quality_rules(documents(rows)).collect()}
    for (i, _, _), left in zip(rows, dealt(rows), strict=True):
        assert got[i].n_left == left and not got[i].base_failed
        assert got[i].kept == (left >= quality.MIN_LEFT * got[i].n_words)
    assert not any(got[i].kept for i, _, host in rows if host == "pages" and shared > 70)
    assert not any(got[i].kept for i, _, host in rows if host == "near copies")  # 74 distinct documents hold each line
    assert all(got[i].kept for i, _, host in rows if host == "copies")


def test_the_limit_of_common_lines_does_not_grow_with_the_host(documents):
    rng = np.random.default_rng(8)
    line, copied = some_words(rng, 40), some_words(rng, 60)
    rows = [(i, line + "\n" + some_words(rng, 15)) for i in range(quality.MAX_DOCS + 1)]
    rows += [(100 + i, copied if i < 2000 else None) for i in rng.permutation(5000).tolist()]
    got = {r.doc_id: r for r in quality.quality_rules(documents(rows)).collect()}
    assert all(got[i].n_left == 15 and not got[i].kept for i in range(quality.MAX_DOCS + 1))
    assert all(got[100 + i].n_left == 60 and got[100 + i].kept for i in range(2000))


def test_empty_tables(spark, documents):
    none = documents([])
    assert quality.quality_rules(none).count() == 0 and quality.clean(none).count() == 0
    assert licences.scan(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(none, labels).count() == 0
    scored = toxicity.toxicity(documents([(1, "a b")]), labels).collect()
    assert [(r.score, r.predicted) for r in scored] == [(0.0, 0)]


def test_licences(documents):
    texts = [
        None, "", "under the MIT license", "xunder the mit license", "under\nthe-MIT, License; under the mit license",
        "Licensed under the Apache License, Version 2.0. CC BY-NC 4.0 cc by nc", "apache license version 2x", "cc by ñnc", "mit license under the",
        "This work is licensed under the GNU General Public License, version 3.", "gnu general public license", "All rights reserved", "cc by nc " * 2000,
        "plain words only", "under the mit license",
    ]
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    got = {r.doc_id: r for r in licences.summary(licences.scan(documents(list(enumerate(texts))))).collect()}
    for i, text in enumerate(texts):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(k, at) for k, p in phrases.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(a for _, a in places), max(a for _, a in places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({k for k, _ in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
    assert got[9].labels == "gpl-3" and got[9].score > 0.99 and got[11].labels == "all-rights-reserved"
    assert got[10].labels == "" and got[13].score == 0


NOTICES = {
    "gpl-3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.",
    "bsd": "Redistribution and use in source or binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "mit": "Permission is hereby granted, free of charge, to any natural or legal person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
}


def test_notices_with_words_inserted_or_changed(documents):
    rng = np.random.default_rng(9)
    rows = [(0, NOTICES["gpl-3"]), (1, NOTICES["bsd"]), (2, NOTICES["mit"])]
    rows += [(3 + i, some_words(rng, 700) + " " + t + " " + some_words(rng, 300)) for i, t in enumerate(NOTICES.values())]
    rows += [(6, " ".join([*NOTICES.values()] * 40)), (7, "permission granted copy software restriction " * 50), (8, NOTICES["gpl-3"].replace("version 3", "version 2"))]
    rows += [(9, NOTICES["gpl-3"].replace("version 3", "version 7")), (10, NOTICES["mit"].replace("free of charge", "at a charge"))]
    rows += [(20 + i, some_words(rng, 80) + " in the and of to is for use any") for i in range(60)]
    got = {r.doc_id: r for r in licences.summary(licences.scan(documents(rows))).collect()}
    assert [got[i].labels for i in range(9)] == ["gpl-3", "bsd", "mit"] * 2 + ["bsd,gpl-3,mit", "", "gpl-2"]
    assert [got[i].labels for i in (9, 10)] == ["", ""]  # a key phrase is missing
    assert not any(got[20 + i].labels for i in range(60))
    hits = {r.doc_id: r.hits for r in licences.scan(documents(rows)).collect()}
    assert [h.word for h in hits[3]] == [700] and len([h for h in hits[6] if h.label == "gpl-3"]) == 40


def test_index_finds_what_a_scan_of_all_places_finds(documents):
    """Against every template tried at every place of every text."""
    rng = np.random.default_rng(10)
    some = lambda n: some_words(rng, n).split()
    rows = []
    for i in range(60):
        w = licences.TEMPLATES[i % len(licences.TEMPLATES)].text.split()
        for _ in range(i % 4):  # words inserted, left out or changed
            at = int(rng.integers(len(w)))
            w = [w[:at] + some(1) + w[at:], w[:at] + w[at + 1 :], w[:at] + some(1) + w[at + 1 :]][int(rng.integers(3))]
        rows.append((i, " ".join([*some(int(rng.integers(0, 40))), *w, *some(int(rng.integers(0, 40)))])))
    rows += [(100 + i, " ".join(some(60) + ["the", "of", "software", "in"])) for i in range(30)] + [(None, rows[4][1]), (5, rows[5][1])]
    counts = Counter(w for _, t in rows for w in set(t.split()))
    index = licences.Index(licences.TEMPLATES, counts, len(rows))
    number = {w: i for i, w in enumerate(index.vocabulary)}
    want = []
    for i, text in rows:
        words = np.array([number.get(w, -1) for w in text.split()])
        found = {label for label, p in licences.BASE_PHRASES if f" {p} " in f" {text} "}
        for t, template in enumerate(licences.TEMPLATES):
            slack = index.slack[t]
            if any(index.share(t, b, words, 0, len(words)) >= licences.MIN_SHARE for b in range(-slack, len(words))):
                found.add(template.label)
        want.append((i, ",".join(sorted(found))))
    got = [(r.doc_id, r.labels) for r in licences.summary(licences.scan(documents(rows))).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sum(bool(x) for _, x in want) > 40


@pytest.fixture(scope="module")
def toxic_corpus():
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9))) for _ in range(400)]
    rows = []
    for i in range(800):
        lines = [" ".join(rng.choice(words, rng.integers(4, 14))) for _ in range(rng.integers(1, 12))]
        toxic = i % 8 == 0
        if toxic:
            at = rng.integers(len(lines))
            lines[at] += " " + rng.choice(["vilest", "rotfish", "Rotfisch"]) + " " + rng.choice(words)
        rows.append((i, ". ".join(lines) + ".", int(toxic)))
    return rows


def test_toxicity_on_held_out_rows_and_offending_sentences(spark, documents, toxic_corpus):
    extra = [(9000, None), (9001, ""), (9002, "..!\n"), (None, "vilest words"), (9003, toxic_corpus[8][1]), (9003, toxic_corpus[8][1])]
    docs = documents([r[:2] for r in toxic_corpus] + extra)
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_corpus] + [(None, 1), (5, None), (123456, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 806
    got = {r.doc_id: r for r in rows}
    held = [(got[i], y) for i, _, y in toxic_corpus if got[i].held_out]
    assert 100 < len(held) < 300
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert [got[i].predicted for i in (9000, 9001, 9002)] == [0, 0, 0]
    for i, text, y in toxic_corpus:
        for o in got[i].offences if y and got[i].predicted else []:
            assert re.search("vilest|rotfis", text.encode()[o.begin : o.end].decode().lower())
    clean = toxicity.clean(docs, labels)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows if not r.predicted}


def plain_features(sentence):
    """Buckets of a sentence: words, their first 3 to 5 bytes and last 4, as ``sentences`` has them."""
    column = next(toxicity.sentences(pa.array([sentence])))
    return set(column["bucket"].tolist())


def test_scores_are_the_noisy_or_of_sentences(documents):
    """Against sentence by sentence in plain Python, with the same weights."""
    rng = np.random.default_rng(3)
    rows = [(i, ". ".join(some_words(rng, int(rng.integers(1, 9))) for _ in range(int(rng.integers(1, 7)))) + "!\nX y? ..") for i in range(40)]
    rows += [(90, None), (91, " .. "), (92, "one " * 700_000 + ". two")]  # a text above one slice
    weights = np.where(rng.random(toxicity.BUCKETS) < 0.5, rng.normal(0, 1.5, toxicity.BUCKETS), 0).astype(np.float32)
    model = toxicity.Model(weights, -2.0)
    got = {r.doc_id: r for r in toxicity.score(documents(rows), model).collect()}
    for i, text in rows:
        clean, bad = 1.0, 0
        for sentence in re.split(r"[.!?\n]", text or ""):
            if re.search("[0-9a-zA-Z\x80-\uffff]", sentence):
                p = 1 / (1 + np.exp(-(model.bias + sum(float(weights[b]) for b in plain_features(sentence)))))
                clean *= 1 - p
                bad += p >= toxicity.THRESHOLD
        assert got[i].score == pytest.approx(1 - clean, abs=1e-9) and len(got[i].offences) == bad
        assert got[i].predicted == int(1 - clean >= toxicity.THRESHOLD)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    docs, features = 12, 6
    toxic, plain = rng.random(docs) < 0.4, rng.integers(0, 4, docs)
    doc = np.sort(rng.integers(0, docs, 25))
    sentence, feature = rng.integers(0, 25, 60), rng.integers(0, features, 60)
    w, bias = rng.normal(size=features), -0.7
    _, grad = toxicity.likelihood(w, bias, toxic, plain, doc, sentence, feature)
    for k in range(features + 1):
        step = np.zeros(features + 1)
        step[k] = 1e-6
        ends = [toxicity.likelihood(w + d * step[:-1], bias + d * step[-1], toxic, plain, doc, sentence, feature)[0] for d in (1, -1)]
        assert grad[k] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-6)


def test_features_are_counted_beyond_the_fitted_sample(spark, documents):
    """A word of few labelled texts is learnt though the sample of the fit has none or few of them."""
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        rows.append((i, some_words(rng, 12) + (" vilest rotfish" if toxic else "") + "."))
        labels.append((i, int(toxic)))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(documents(rows), known, rows=60)
    assert (model.weights != 0).sum() > 0
    got = toxicity.score(documents(rows), model).collect()
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in got]) > 0.97
