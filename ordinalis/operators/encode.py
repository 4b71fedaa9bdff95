"""Fixed-length token ids and masks for the review and the reply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ordinalis.operators.lookup import lookup_join, most_counted
from ordinalis.storage import cut

# Ids of the special tokens; vocabulary words follow.
PAD, UNK, CLS, SEP, FIRST_WORD = 0, 1, 2, 3, 4

# A run of letters and digits, or one other character that is not blank.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\p{Z}\t\n\x0B\f\r]"
ID_RANGE = 1 << 20  # above any token id


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def build_vocabulary(df: DataFrame, texts: list[str], size: int) -> DataFrame:
    """(token, token_id): the ``size`` most frequent tokens of all texts, ties by token.

    Numbering sorts ``size`` rows in one task; it is the model's vocabulary size, a parameter.
    """
    counts = cut(df.select(F.explode(F.concat(*[tokens(F.col(c)) for c in texts])).alias("token"))
                 .groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token-counts")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), F.col("token").asc()))
    numbered = most_counted(counts, "token", size).select("token", (place + (FIRST_WORD - 1)).cast("int").alias("token_id"))
    return cut(numbered, "vocabulary")


def encode_text_pair(df: DataFrame, id_col: str, review: str, reply: str, vocabulary: DataFrame,
                     max_length: int = 512) -> DataFrame:
    """(id, review_ids, review_mask, reply_ids, reply_mask), each ``max_length // 2`` long.

    Both texts go through one explode, one join with the vocabulary (broadcast if it is
    measured small) and one regrouping. Place and token id travel in one number, so a row ships at most
    ``max_length`` of them and putting them back in order sorts plain numbers.
    """
    length = max_length // 2
    cut_to = lambda text: F.slice(tokens(F.col(text)), 1, length - 2)
    lists = df.select(id_col, cut_to(review).alias("_a"), cut_to(reply).alias("_b"))
    pieces = lists.select(id_col, F.size("_a").alias("_n"),
                          F.posexplode_outer(F.concat("_a", "_b")).alias("_at", "token"))
    packed = F.col("_at").cast("bigint") * ID_RANGE + F.coalesce("token_id", F.lit(UNK))
    rows = (lookup_join(pieces, vocabulary, ["token"]).groupBy(id_col)
            .agg(F.max("_n").alias("_n"), F.sort_array(F.collect_list(packed)).alias("_packed"))
            .select(id_col, "_n", F.transform("_packed", lambda x: (x % ID_RANGE).cast("int")).alias("_ids")))
    sides = rows.select(id_col, F.slice("_ids", F.lit(1), F.col("_n")).alias("_a"),
                        F.slice("_ids", F.col("_n") + 1, F.lit(length)).alias("_b"))

    def framed(side: str) -> Column:
        padding = F.array_repeat(F.lit(PAD), F.lit(length - 2) - F.size(side))
        return F.concat(F.array(F.lit(CLS)), side, F.array(F.lit(SEP)), padding)

    def mask(side: str) -> Column:
        used = F.size(side) + 2
        return F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used))

    return sides.select(id_col, framed("_a").alias("review_ids"), mask("_a").alias("review_mask"),
                        framed("_b").alias("reply_ids"), mask("_b").alias("reply_mask"))
