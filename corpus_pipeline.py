"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of documents. The models of a stage are fitted on that stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinalis.llm import jaccard, languages, substrings
from ordinalis.llm.queries import held_out, packed
from ordinalis.storage import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Cuts a worker of the last stage remembers: executors still hold what the stages before left behind.
PACKING_CUTS = 50_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text looks like none of the learned languages go, and those without a letter."""
    models = languages.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return languages.identify(docs, models).where("not rejected").select(*COLUMNS)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return jaccard.keep_one(docs).select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their repeated passages; a text that has none stays as it is."""
    done = substrings.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return done.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed(spark, docs, PACKING_CUTS)


STAGES = [("language_id", identify_language), ("ngram_jaccard_join", join_near_duplicates),
          ("substring_dedup", remove_repeated_passages), ("packing", pack_sequences)]

#: Language models, and ids of a tokenizer, can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
