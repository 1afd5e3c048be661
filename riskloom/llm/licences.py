"""Licence scans by a positional index of rare words (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.textscan import LOWER, hash_spans, row_slices, spans, text_bytes

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Template:
    """A licence notice. All ``keys`` must stand word for word where the notice stands."""

    label: str
    text: str
    keys: tuple[str, ...]


# The phrases of the contract, label and words.
BASE_PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
# How common licences introduce themselves.
_FREE = "this program is free software you can redistribute it and or modify it under the terms of the gnu {} public license as published by the free software foundation either version {} of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {} public license for more details"
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("apache license", "version 2")),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    Template("gpl-3", _FREE.format("general", "3", "general"), ("gnu general public license", "version 3")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl-2", _FREE.format("general", "2", "general"), ("gnu general public license", "version 2")),
    Template("gpl-2", "under the terms of the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("lgpl", _FREE.format("lesser general", "2 1", "lesser general"), ("gnu lesser general public license",)),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl-3", _FREE.format("affero general", "3", "affero general"), ("gnu affero general public license", "version 3")),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistribution and use in source", "with or without modification")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source", "with or without modification")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify", "with or without fee")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license", ("creative commons attribution", "license")),
    Template("cc-by", "this work is licensed under a creative commons attribution license", ("creative commons attribution license",)),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)

#: Licence words looked up in each stretch of so many words, the rarest ones.
RAREST, STRETCH_WORDS = 16, 64
#: Of a template's words, weighed by rarity, what must stand near their places, and how far off
#: they may stand: a share of its length, at least LEAST_SLACK words.
MIN_SHARE, SLACK, LEAST_SLACK = 0.7, 0.1, 4


class Index:
    """The rarity of the templates' words, and postings (template, position) of the rare ones."""

    def __init__(self, templates: tuple[Template, ...], texts_with: dict[str, int] | None = None, texts: int = 0) -> None:
        self.templates = templates
        phrases = [p for _, p in BASE_PHRASES]
        self.vocabulary = sorted({w for t in (*(t.text for t in templates), *phrases) for w in t.split()})
        raw = "\n".join(self.vocabulary).encode()
        begin, end, _ = spans(np.frombuffer(raw, np.uint8) != 0x0A, np.array([0, len(raw)]))
        hashes = hash_spans(np.frombuffer(raw, np.uint8), begin, end)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        counts = texts_with or {}
        self.idf = np.array([np.log((1 + texts) / (1 + counts.get(w, 0))) + 1 for w in self.vocabulary])
        number = {w: i for i, w in enumerate(self.vocabulary)}
        numbers = lambda text: np.array([number[w] for w in text.split()])
        self.words = [numbers(t.text) for t in templates]
        self.keys = [[numbers(k) for k in t.keys] for t in templates]
        self.slack = [max(LEAST_SLACK, int(SLACK * len(w))) for w in self.words]
        self.phrases = [numbers(p) for p in phrases]
        self.anchors = [int(np.argmax(self.idf[p])) for p in self.phrases]
        # postings of word i are those from edges[i] to edges[i + 1]; rarer half of each template
        rare = [np.isin(w, u[np.argsort(-self.idf[u], kind="stable")][: max(2, -(-len(u) // 2))]) for w in self.words for u in (np.unique(w),)]
        template = np.concatenate([np.full(len(w), k) for k, w in enumerate(self.words)])
        place = np.concatenate([np.arange(len(w)) for w in self.words])
        word = np.concatenate(self.words)
        kept = np.concatenate(rare)
        template, place, word = template[kept], place[kept], word[kept]
        by_word = np.argsort(word, kind="stable")
        self.template, self.place = template[by_word], place[by_word]
        self.edges = np.searchsorted(word[by_word], np.arange(len(self.vocabulary) + 1))
        self.posted = np.append(np.diff(self.edges) > 0, False)  # the last one stands for -1

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The number of each word in the templates' vocabulary, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.number[at], -1)

    def base_places(self, words: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Per base phrase: the first words of its places in the run of ``words``. Only the
        places of its rarest word are looked at."""
        for k, (key, anchor) in enumerate(zip(self.phrases, self.anchors, strict=True)):
            base = np.flatnonzero(words == key[anchor]) - anchor
            base = base[(base >= 0) & (base + len(key) <= len(words))]
            for j, word in enumerate(key.tolist()):
                base = base[words[base + j] == word]
            yield k, base[row[base] == row[base + len(key) - 1]] if len(base) else base

    def rarest(self, words: np.ndarray, row: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Where the RAREST rarest licence words of each stretch of each row stand."""
        at = np.flatnonzero(self.posted[words])
        if not len(at):
            return at
        stretch = row[at] * (len(words) // STRETCH_WORDS + 1) + (at - heads[row[at]]) // STRETCH_WORDS
        pair, back = np.unique(stretch * len(self.vocabulary) + words[at], return_inverse=True)
        own, word = np.divmod(pair, len(self.vocabulary))
        order = np.lexsort((word, -self.idf[word], own))
        first = np.searchsorted(own[order], own[order])
        rank = np.empty(len(pair), np.int64)
        rank[order] = np.arange(len(pair)) - first
        return at[rank[back] < RAREST]

    def candidates(self, words: np.ndarray, row: np.ndarray, heads: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, template, word at which the template would begin), where the postings of at
        least two different rare words agree. Of neighbours within the slack the one with most
        agreement counts."""
        at = self.rarest(words, row, heads)
        many = self.edges[words[at] + 1] - self.edges[words[at]]
        posting = np.repeat(self.edges[words[at]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        at = np.repeat(at, many)
        template, begin = self.template[posting], at - self.place[posting]
        votes = np.unique(np.column_stack([row[at], template, begin, words[at]]), axis=0) if len(at) else np.zeros((0, 4), np.int64)
        if not len(votes):
            return
        new = np.append(True, (votes[1:, :3] != votes[:-1, :3]).any(axis=1))
        first = np.flatnonzero(new)
        agree = np.diff(np.append(first, len(votes)))
        weight = np.add.reduceat(self.idf[votes[:, 3]], first)
        best: tuple[int, int, int, float] | None = None
        for (r, t, begin, _), n, w in zip(votes[first].tolist(), agree.tolist(), weight.tolist(), strict=True):
            if n < 2:
                continue
            if best and best[:2] == (r, t) and begin - best[2] <= self.slack[t]:
                if w > best[3]:
                    best = (r, t, begin, w)
                continue
            if best:
                yield best[:3]
            best = (r, t, begin, w)
        if best:
            yield best[:3]

    def share(self, t: int, begin: int, words: np.ndarray, low: int, high: int) -> float:
        """How much of template ``t``, by rarity, stands near its places if it begins at
        ``begin``; 0 where one of its key phrases doesn't. The row is words low to high."""
        own, slack = self.words[t], self.slack[t]
        a, b = max(low, begin - slack), min(high, begin + len(own) + slack)
        near = words[a:b]
        for key in self.keys[t]:
            head = np.flatnonzero(near[: max(0, len(near) - len(key) + 1)] == key[0])
            for j, word in enumerate(key.tolist()):
                head = head[near[head + j] == word]
            if not len(head):
                return 0.0
        seen = np.zeros((len(own), len(near) + 1), np.int64)
        np.cumsum(near[None] == own[:, None], axis=1, out=seen[:, 1:])
        place = begin - a + np.arange(len(own))
        lo, hi = np.clip(place - slack, 0, len(near)), np.clip(place + slack + 1, 0, len(near))
        found = seen[np.arange(len(own)), hi] > seen[np.arange(len(own)), lo]
        return float(self.idf[own[found]].sum() / self.idf[own].sum())


def _word_runs(index: Index, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, starts = text_bytes(column)
    for first, last in row_slices(starts):
        raw, edges = LOWER[data[starts[first] : starts[last]]], starts[first : last + 1] - starts[first]
        begin, end, row = spans(_WORD[raw], edges)
        yield first, last - first, index.lookup(hash_spans(raw, begin, end)), row


def word_rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many of all texts each word of the templates stands, and the number of texts.
    As many rows reach the driver as the templates have words."""
    index = Index(templates)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts, size = np.zeros(len(index.vocabulary), np.int64), 0, len(index.vocabulary)
        for batch in batches:
            for _, rows, words, row in _word_runs(index, batch.column(0)):
                known = words >= 0
                seen = np.unique(row[known] * size + words[known]) % size
                sums += np.bincount(seen, minlength=size)
                texts += rows
        yield pa.RecordBatch.from_arrays([pa.array([*index.vocabulary, ""]), pa.array([*sums.tolist(), texts])], names=["word", "n"])

    counts = docs.select("text").mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in counts}
    return found, found.pop("", 0)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and hits (label, word, share, base) of each row of ``docs`` (doc_id, text).

    A base hit is a place where a base phrase stands word for word (share 1). Other hits are
    notices: the rarest licence words of each stretch of the text are looked up in the
    templates' postings; where two of them agree on where a template begins, so much of the
    template as stands near its places (within the slack, so words may be inserted or left out)
    is its share, by rarity. It counts from MIN_SHARE, if all key phrases stand there. word is
    the hit's first word (from 0; not below 0 where a notice lacks its beginning).

    Words are runs of ASCII letters and digits, in lower case, and of characters beyond ASCII.
    Hits are in order of place, all of them. A null or empty text has no words and no hits; a
    null doc_id stays null; repeated rows are scanned each; whole texts are read; other columns
    are left behind, so their names can't clash. An empty table gives no row.
    """
    index = Index(templates, *word_rarity(docs, templates))
    kind = "array<struct<label:string,word:long,share:double,base:boolean>>"
    own = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("share", pa.float64()), ("base", pa.bool_())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, words, row in _word_runs(index, batch.column(1)):
                heads = np.searchsorted(row, np.arange(rows + 1))
                hits: dict[int, list[tuple]] = {}
                for k, places in index.base_places(words, row):
                    for at in places.tolist():
                        hits.setdefault(int(row[at]), []).append((int(at - heads[row[at]]), BASE_PHRASES[k][0], 1.0, True))
                for r, t, begin in index.candidates(words, row, heads):
                    low, high = int(heads[r]), int(heads[r + 1])
                    share = index.share(t, begin, words, low, high)
                    if share >= MIN_SHARE:
                        hits.setdefault(r, []).append((max(0, begin - low), templates[t].label, share, False))
                made = [[{"label": k, "word": w, "share": x, "base": y} for w, k, x, y in sorted(hits.get(i, ()))] for i in range(rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(np.diff(heads)), pa.array(made, own)], names=["doc_id", "n_words", "hits"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, f"doc_id long, n_words long, hits {kind}")


def summary(hits: DataFrame) -> DataFrame:
    """Per row of ``scan``: n_base, first_word, last_word, base_labels, labels and score (the
    largest share of a template that was found; 0 without a hit)."""
    base = F.filter("hits", lambda h: h["base"])
    join = lambda x: F.array_join(F.array_sort(F.array_distinct(x["label"])), ",")
    return hits.select(
        "doc_id", "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"), F.array_max(base["word"]).alias("last_word"),
        join(base).alias("base_labels"), join(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: F.least(h["share"], F.lit(1.0)))), F.lit(0.0)).alias("score"),
    )
