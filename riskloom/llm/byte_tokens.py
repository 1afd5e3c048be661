"""Ids of a byte-level vocabulary file, text by text, from a memo of distinct pieces."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from riskloom.llm.memo import Memo, segments
from riskloom.llm.textscan import text_bytes

#: Fixed value: how byte-level vocabularies of this kind split text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter by which such vocabulary files write each byte, and back to the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteEngine:
    """Gives the ids that ``tokenizers`` gives for the file, special strings included.

    Where the file is a plain byte-level merge list whose ids are the merges' ranks, new
    pieces go through the same merges in ``tiktoken``, which is several times as fast;
    pieces that hold a special string, and all pieces of other files, go through
    ``tokenizers`` itself.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.apart = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and spec.get("normalizer") is None and model["type"] == "BPE" and not model.get("dropout")
            and not any(b" " in t for t in self.special)
        )
        letters = _byte_letters()
        known = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if t not in known} if self.apart else {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        in_rank = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        self.fast = None
        if self.apart and in_rank:
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, i in ranks.items():
                self.sizes[i] = len(token)
        self.memo = Memo(self.encode)

    def encode(self, texts: list[bytes], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        odd = np.array([any(s in t for s in self.special) for t in texts], bool)
        if self.fast is None:
            odd[:] = True
        count, parts = np.zeros(len(texts), np.int64), {}
        plain = np.flatnonzero(~odd)
        if len(plain):
            # the pieces meet at safe breaks, so they can be encoded as one text; but a piece
            # that opens a text could join the one before it, and goes alone
            run = [i for i in plain.tolist() if texts[i][:1] == b" " and len(texts[i]) > 1]
            alone = set(plain.tolist()) - set(run)
            if run:
                ids = np.array(self.fast.encode_ordinary(b"".join(texts[i] for i in run).decode("utf-8", "replace")), np.int32)
                ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(texts[i]) for i in run]), "right")
                for i, part in zip(run, np.split(ids, ends[:-1]), strict=True):
                    parts[i] = part
            for i in alone:
                parts[i] = np.array(self.fast.encode_ordinary(texts[i].decode("utf-8", "replace")), np.int32)
        if odd.any():
            at = np.flatnonzero(odd).tolist()
            made = self.library.encode_batch_fast([texts[i].decode("utf-8", "replace") for i in at], add_special_tokens=False)
            for i, x in zip(at, made, strict=True):
                parts[i] = np.array(x.ids, np.int32)
        for i, part in parts.items():
            count[i] = len(part)
        return count, np.concatenate([parts[i] for i in range(len(texts))]) if texts else np.zeros(0, np.int32)


@lru_cache(4)
def engine(path: str) -> ByteEngine:
    return ByteEngine(path)


def token_rows(own: ByteEngine, column: pa.Array) -> Iterator[tuple[range, list[np.ndarray]]]:
    """Runs of rows with the ids (uint32) of each."""
    data, starts = text_bytes(column)
    if not own.apart:
        for i, text in enumerate(column.to_pylist()):
            yield range(i, i + 1), [np.array(own.library.encode(text or "", add_special_tokens=False).ids, np.uint32)]
        return
    held: list[np.ndarray] = []  # the parts of a long row
    for row, byte, edges in segments(data, starts):
        opens, closes = byte == starts[row], edges[-1] == starts[row + len(edges) - 1]
        piece_row, _, count, (ids,) = own.memo.segment(data, edges, opens)
        sizes = np.bincount(piece_row, weights=count, minlength=len(edges) - 1).astype(np.int64)
        rows = np.split(ids.astype(np.uint32), np.cumsum(sizes)[:-1])
        if held:
            rows[0] = np.concatenate([*held, rows[0]])
            held = []
        if not closes:
            held = [rows[0]]
            continue
        yield range(row, row + len(rows)), rows
