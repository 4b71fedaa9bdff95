"""Token counts by a two-tier lookup, without shuffling pre-tokens.

First tier: every task counts its own pre-tokens (cuts at white space) in bounded memory and
passes on its most frequent ones; the summed list, cut to ``table_size`` entries, is encoded
once and broadcast as a compact table of lengths. Second tier: what the table lacks is encoded
by the worker that meets it and kept in its bounded cache. The table decides the speed only;
the counts are the same without it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.bpe import WordEndBpe, loaded
from ordinalis.llm.common import small_batches
from ordinalis.storage import cut

#: Entries of the broadcast table: at most this many pre-tokens of at most LONGEST letters.
TABLE_SIZE = 1 << 16
LONGEST = 32

#: Texts that the table is fitted on, and tasks that count them.
SAMPLE_TEXTS = 20_000
SAMPLE_TASKS = 8


def frequent_pretokens(texts: DataFrame, text_col: str, vocabulary: Broadcast, table_size: int = TABLE_SIZE,
                       sample: int = SAMPLE_TEXTS) -> list[str]:
    """The most frequent pre-tokens of a sample of about ``sample`` texts, at most ``table_size``.

    A hash of the row's place draws the sample over all rows, so copies don't crowd it; the table
    decides speed only, so a sample is enough. It is written and counted by at most eight tasks,
    each with at most ``4 * table_size`` counters (when there are more, those below their
    median go); their ``table_size // 4`` largest are added up here, and no pre-token is shuffled.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = loaded(vocabulary), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(bpe.cuts(text.as_py()))
                if len(seen) > 4 * table_size:
                    seen = Counter(dict(seen.most_common(2 * table_size)))
        top = [(c, n) for c, n in seen.most_common(table_size // 4) if n > 1 and len(c) <= LONGEST]
        yield pa.RecordBatch.from_pydict({"cut": [c for c, _ in top], "n": [n for _, n in top]},
                                         schema=pa.schema([("cut", pa.string()), ("n", pa.int64())]))

    rows = texts.select(F.col(text_col).alias("_text"))
    share = sample / max(texts.count(), 1)
    if share < 1:
        drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30))
        rows = rows.withColumn("_drawn", drawn).where("_drawn").drop("_drawn")
    drawn_texts = cut(rows, "pretoken-sample").coalesce(SAMPLE_TASKS)
    total = Counter()
    for row in drawn_texts.mapInArrow(summary, "cut string, n long").collect():  # SAMPLE_TASKS * table_size // 4 at most
        total[row["cut"]] += row["n"]
    return [c for c, _ in total.most_common(table_size)]


def length_table(texts: DataFrame, text_col: str, vocabulary: Broadcast, table_size: int = TABLE_SIZE) -> Broadcast:
    """The broadcast table: the cuts in one string and their token counts in one byte each."""
    bpe = WordEndBpe(vocabulary.value)
    known = [(c, n) for c in frequent_pretokens(texts, text_col, vocabulary, table_size) if (n := bpe.count_cut(c)) < 256]
    return texts.sparkSession.sparkContext.broadcast((" ".join(c for c, _ in known), bytes(n for _, n in known)))


def token_count(text: Column | str, vocabulary: Broadcast, table: Broadcast) -> Column:
    """long: the tokens of each whole text; null and empty texts have 0."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        bpe = loaded(vocabulary)
        if bpe.known_from is not table.value:
            cuts, lengths = bpe.known_from = table.value
            bpe.know_counts(dict(zip(cuts.split(" "), lengths)) if cuts else {})
        return pa.array([bpe.count(t.as_py()) for t in texts], pa.int64())

    return count(text)


def with_token_counts(docs: DataFrame, vocabulary: Broadcast, text_col: str = "text", limit: int = 2048,
                      table: Broadcast | None = None) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Null texts count as empty. Columns of these names are replaced; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    table = table or length_table(docs, text_col, vocabulary)
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
            .withColumn("n_tokens", token_count(text_col, vocabulary, table))
            .withColumn("over_limit", F.col("n_tokens") > limit))
