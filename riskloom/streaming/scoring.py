"""Score records as they arrive, with the same service as the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.plans.scoring import ScoringService
from riskloom.session import join_path, pinned_scope

BATCH = "batch"


def record_stream(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    """JSON records dropped into a folder."""
    return spark.readStream.schema(schema).json(directory)


def start_scoring(
    records: DataFrame, service: ScoringService, target: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write scored records as Parquet, one folder per micro-batch.

    A batch that is repeated after a failure replaces its own folder, so every
    record is written once.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        folder = join_path(target, f"{BATCH}={number}")
        with pinned_scope(batch.sparkSession):
            service.predict_frame(batch).write.mode("overwrite").parquet(folder)

    return (
        records.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def scored_records(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).withColumn(BATCH, F.col(BATCH).cast("bigint"))
