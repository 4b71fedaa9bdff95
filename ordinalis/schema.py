"""Column names and schemas of the review data model."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("review", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("thumbsUpCount", T.LongType()),
    T.StructField("reviewCreatedVersion", T.StringType()),
    T.StructField("replyContent", T.StringType()),
    T.StructField("timeToReply", T.StringType()),
])

# The test file has every column but the label.
TEST_SCHEMA = T.StructType([f for f in REVIEW_SCHEMA.fields if f.name != "score"])

SUBMISSION_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("value", T.IntegerType()),
])

FLAG_COLUMNS = ("has_5star", "has_issues", "has_sorry", "has_transactions",
                "has_thanks", "has_bank_handle", "has_phone", "has_question_mark")

# Columns of the feature table that never reach the regressors.
NOT_FEATURES = ("review", "text", "timeToReply", "thumbsUpCount",
                "review_length", "replyContent", "score", "language", "translated_review",
                "translate_error", "reviewCreatedVersion")

TEXT_COLUMNS = ("review", "text", "replyContent", "timeToReply", "translated_review", "reviewCreatedVersion")


def prob_names(num_classes: int) -> list[str]:
    return [f"{k}_prob" for k in range(num_classes)]


def onehot_names(num_classes: int) -> list[str]:
    return [f"sentiment_{k}" for k in range(num_classes)]


def pca_names(components: int) -> list[str]:
    return [f"pca_{i + 1}" for i in range(components)]


def model_columns(num_classes: int = 5, components: int = 2) -> list[str]:
    """The numeric model matrix: one-hot, days, flags, importance, principal components."""
    return [*onehot_names(num_classes), "days_to_reply", *FLAG_COLUMNS,
            "review_importance", *pca_names(components)]
