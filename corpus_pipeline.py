"""From raw documents to packed sequences: quality rules, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and
returns the columns of ``documents``; the last returns the packed pieces. Other columns of the table go along, whatever their names; an empty
table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import neardup, packing, quality, toxicity
from riskloom.llm.queries import BYTE_VOCABULARY, find_package, table
from riskloom.llm.store import Scratch

#: Near-duplicates share 0.8 of their shingles of five words.
SHINGLE_WORDS, PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules or are depleted, and common lines of the others.

    Null and empty texts fail the rules; rows with a null or repeated doc_id are judged each."""
    find_package(spark)
    return quality.clean(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic; without labels to learn from all stay."""
    find_package(spark)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates. Rows with a null doc_id all stay,
    and of a repeated doc_id one row of each text."""
    find_package(spark)
    return neardup.clean(docs, SHINGLE_WORDS, PERCENT)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of what is left into sequences; see ``packing.pack``."""
    find_package(spark)
    return packing.pack(docs, BYTE_VOCABULARY)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Tokens and a fitted model are beyond SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
