"""Tables and files in the folder that all executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


class Scratch:
    """Intermediate Parquet tables of one job.

    Writing a table cuts the lineage: a lost executor costs its running tasks, never
    the tables. ``drop`` frees a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, job: str) -> None:
        self.spark, self.root, self.steps = spark, new_path(spark, job), 0

    def write(self, df: DataFrame, name: str, level: int = 3) -> DataFrame:
        self.steps += 1
        path = f"{self.root}/{self.steps:03d}-{name}"
        df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        remove(self.spark, df._scratch_path)
