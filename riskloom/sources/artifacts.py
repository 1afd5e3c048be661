"""Inventory and digests of the files a run leaves behind."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

# Artifact type per file name; any other file is "other".
ARTIFACT_TYPES = {
    "pipeline": "pipeline",
    "model_metadata": "metadata_table",
    "metadata.json": "metadata_json",
    "threshold_analysis.csv": "threshold_analysis",
    "leakage_audit.json": "leakage_audit",
}


def artifact_type(name):
    mapping = F.create_map(*[F.lit(x) for pair in ARTIFACT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, name), F.lit("other"))


#: Bytes of a file that a task holds at once, and most tasks that hash.
CHUNK_BYTES, MOST_TASKS = 8 << 20, 10_000


def _opened(uri: str):
    """The file as a stream, on whatever store its scheme names."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream(unquote(re.sub("^file:/*", "/", uri)), compression=None)
    store, path = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
    return store.open_input_stream(path, compression=None)


def _hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for uri in batch.column(0).to_pylist():
            digest = hashlib.sha256()
            with _opened(uri) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests)], names=["uri", "size_bytes", "sha256"])


def file_digests(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """(uri, name, sha256, size_bytes) per file of any size.

    The scan lists the files without their contents; tasks then read them in chunks, so a
    large file never lies in a row or in memory as a whole.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(directory)
        .select(F.col("path").alias("uri"), F.col("length").alias("size_bytes"))
    )
    spread = files.repartition(max(1, min(files.count(), MOST_TASKS)), "uri")
    hashed = spread.mapInArrow(_hash_files, "uri string, size_bytes bigint, sha256 string")
    return hashed.select("uri", F.element_at(F.split("uri", "/"), -1).alias("name"), "sha256", "size_bytes")


def inventory(spark: SparkSession, run_id: str, directory: str) -> DataFrame:
    """Artifact rows of the files directly in a run folder."""
    return file_digests(spark, directory).select(
        F.lit(run_id).alias("run_id"),
        artifact_type(F.col("name")).alias("artifact_type"),
        "uri",
        "sha256",
        "size_bytes",
        F.current_timestamp().alias("created_at"),
    )


def _combined_digest():
    """One sha256 over the file digests of a group, in path order; 64 letters per file."""
    ordered = F.array_sort(F.collect_list(F.struct("uri", "sha256")))
    return F.sha2(F.array_join(F.transform(ordered, lambda f: f["sha256"]), ""), 256)


def folder_digest(spark: SparkSession, directory: str) -> str:
    """Digest of all files below a folder.

    Spark hides names starting with ``_`` and ``.``, so commit markers do not count.
    """
    return file_digests(spark, directory, recursive=True).agg(_combined_digest()).first()[0]


def folder_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """(name, sha256, size_bytes) per entry of a folder, its own parts added up."""
    files = file_digests(spark, directory, recursive=True)
    # Spark reports the folder with its scheme, whether or not it was given with one.
    base = re.sub("^[a-z0-9]+:/+", "/", directory.rstrip("/")) + "/"
    inside = F.substring_index("uri", base, -1)
    return (
        files.withColumn("name", F.element_at(F.split(inside, "/"), 1))
        .groupBy("name")
        .agg(_combined_digest().alias("sha256"), F.sum("size_bytes").alias("size_bytes"))
    )
