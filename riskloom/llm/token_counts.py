"""Token counts (operator 3): lengths only, from batches balanced by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import byte_tokens, pieces
from riskloom.llm.memo import segments
from riskloom.llm.textscan import text_bytes

OVER_LIMIT = 4096


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = OVER_LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token counts of whole texts: id_col, n_bytes, n_tokens, over_limit.

    ``vocabulary`` is a .model file (sentencepiece) or a .json file (tokenizers). Inside
    a task texts are gathered into batches of equal bytes, and texts longer than a batch
    are cut where no token can reach across; only lengths leave the task. A null text
    counts as empty and has 0 tokens; a null id stays null; repeated rows are counted
    each; further columns are left behind, so their names can't clash. An empty table
    gives no row.
    """
    schema = f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean"
    piece_model = vocabulary.endswith(".model")

    def lengths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        own = pieces.engine(vocabulary, False) if piece_model else byte_tokens.engine(vocabulary)
        data, starts = text_bytes(column)
        total = np.zeros(len(starts) - 1, np.int64)
        if own.apart:
            for row, byte, edges in segments(data, starts):
                piece_row, _, count = own.memo.segment(data, edges, byte == starts[row])[:3]
                total[row : row + len(edges) - 1] += np.bincount(piece_row, weights=count, minlength=len(edges) - 1).astype(np.int64)
        else:
            for i, text in enumerate(column.to_pylist()):
                made = own.library.encode(text or "") if piece_model else own.library.encode(text or "", add_special_tokens=False).ids
                total[i] = len(made)
        return np.diff(starts), total

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, count = lengths(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(count), pa.array(count > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"]
            )

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(work, schema)
