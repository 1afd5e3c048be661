import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskloom.llm.queries import find_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    find_package(spark)


@pytest.fixture
def documents(spark):
    """Makes documents with columns whose names clash with those that operators add."""
    kind = StructType(
        [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType()), StructField("n_words", StringType()), StructField("score", StringType()), StructField("rank", StringType())]
    )

    def make(rows):
        rows = [(*r, "web")[:3] for r in rows]
        return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], kind)

    return make
