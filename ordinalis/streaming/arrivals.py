"""Files that arrive in a folder, read as a stream a few at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def arriving(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files in ``path``, each of which is written whole and once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
