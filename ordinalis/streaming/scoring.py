"""Score arriving reviews: text features and class scores hold no state, so they stream as is."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ordinalis.operators.sentiment import score_sentiment
from ordinalis.plans.features import score_columns, text_features
from ordinalis.settings import Settings


def score_stream(reviews: DataFrame, model: PipelineModel, settings: Settings, working: str = "review") -> DataFrame:
    """The same plan as in batch, on a streaming table of reviews."""
    scored = score_sentiment(text_features(reviews, working), model, "text", "replyContent")
    return score_columns(scored, settings.num_classes)


def write_scores(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table, handling everything available and then stopping."""
    return (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
