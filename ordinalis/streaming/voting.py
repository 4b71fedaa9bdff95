"""Votes and their evaluation while predictions and labels are still arriving.

The state store holds one set of class counters per id, as a batch vote's buffers do. Each batch
writes the votes that it changed under its own number; a batch that runs again after a failure
replaces what it wrote, so every prediction counts once. The evaluation reads the last vote of each id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ordinalis.operators.agreement import evaluate
from ordinalis.operators.ensemble import vote_mode
from ordinalis.storage import names_in, path_complete

BATCH = "batch="


def vote_stream(rows: DataFrame, by: list[str], label: str = "label", y: str = "y", num_classes: int = 5,
                time: str | None = None, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """(by..., y, label): the most frequent class so far, the smallest on ties, as ``vote_mode`` gives.

    A prediction has a ``label``, and ``y`` if its true class is known; a true class that arrives later is a
    row with ``y`` alone. A null id is an id of its own. Ids without predictions have a null label.

    Without ``time`` every id keeps its counters for good. With it, ids vote once per ``window`` of
    that column (``window`` is then a key too): counters go when the watermark, ``delay`` behind the latest
    time seen, has passed their window, and rows that arrive after that are left out.
    """
    if time is not None:
        rows = rows.withWatermark(time, delay).withColumn("window", F.window(time, window))
        by = ["window", *by]
    return vote_mode(rows, by, label, num_classes, carry=[y])


def write_votes(votes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Handles everything available and stops; a later call with the same checkpoint goes on from there."""
    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}{batch}")

    return (votes.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def latest_votes(spark: SparkSession, path: str, schema: StructType, by: list[str]) -> DataFrame:
    """The last vote of each key in ``by``, from batches that were written whole. None written: no rows."""
    path = path.rstrip("/")
    whole = [f"{path}/{name}" for name in names_in(spark, path) if name.startswith(BATCH)]
    whole = [folder for folder in whole if path_complete(spark, folder)]
    if not whole:
        return spark.createDataFrame([], schema)
    rest = [name for name in schema.names if name not in by]
    number = StructType([*schema.fields]).add("batch", "long")
    log = spark.read.option("basePath", path).schema(number).parquet(*whole)
    last = log.groupBy(*by).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*[F.col(name) if name in by else F.col("_last")[name].alias(name) for name in schema.names])


def evaluate_votes(spark: SparkSession, path: str, schema: StructType, by: list[str], label: str = "label",
                   y: str = "y", num_classes: int = 5) -> DataFrame:
    """(metric, class, value) of the votes so far whose true class is known."""
    judged = latest_votes(spark, path, schema, by).where(F.col(y).isNotNull() & F.col(label).isNotNull())
    return evaluate(judged, y, label, num_classes)
