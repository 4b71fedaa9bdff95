"""The registered queries of this folder: each operator over its whole table.

``LLM_QUERIES`` maps a name to (spark, sf_dir) -> DataFrame; the digest columns of the
contracts are derived here from what the operators return.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinalis.llm import (bpe, byteranks, completion, counts, fingerprints, importance, jaccard, languages, neighbours, packing,
                           substrings, urls, warc, zones)
from ordinalis.storage import fresh_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
LLM_QUERIES = {}


def query(build):
    LLM_QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(spark: SparkSession):
    return bpe.share_vocabulary(spark, public_tokenizers.path(VOCABULARY))


@query
def op1_block_neighbours(spark, sf_dir):
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op2_warc_bundles(spark, sf_dir):
    records = warc.with_revisits(_table(spark, sf_dir, "pages"), "page_id", F.col("html"), least_bytes=0)
    manifest = warc.write_bundles(records, fresh_path(spark, "warc"), id_col="page_id", url_col="url")
    return (warc.read_records(manifest, id_col="page_id")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query
def op3_bpe_roundtrip(spark, sf_dir):
    vocabulary = _vocabulary(spark)
    coded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
    texts = bpe.decode(coded, vocabulary)
    return texts.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_ngram_jaccard(spark, sf_dir):
    return jaccard.similar_components(_table(spark, sf_dir, "documents"))


URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


@query
def op5_url_templates(spark, sf_dir):
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op6_token_counts(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = counts.with_token_counts(docs, _vocabulary(spark))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


@query
def op7_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = languages.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = languages.identify(docs.select("doc_id", "text", held_out().alias("held_out")), models)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def packed(spark: SparkSession, docs: DataFrame, cached_cuts: int = bpe.CACHED_CUTS) -> DataFrame:
    vocabulary = _vocabulary(spark)
    pieces = packing.pack(docs, lambda text: bpe.loaded(vocabulary, cached_cuts, bpe.RankedBpe).encode(text), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op8_window_packing(spark, sf_dir):
    # an executor that does nothing else has room for more cuts
    return packed(spark, _table(spark, sf_dir, "documents"), 1_000_000)


@query
def op9_substring_dedup(spark, sf_dir):
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op10_chunk_fingerprints(spark, sf_dir):
    compared = fingerprints.edit_comparison(_table(spark, sf_dir, "documents"))
    return compared.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
                           "edited_fingerprint", "near_edited", "near_next")


BYTE_VOCABULARY = "byte_bpe_50k.json"
BYTE_END_ID = 0


@query
def op11_bin_completion(spark, sf_dir):
    vocabulary = bpe.share_vocabulary(spark, public_tokenizers.path(BYTE_VOCABULARY))
    pattern = public_tokenizers.PATTERN
    pieces = completion.pack_whole(_table(spark, sf_dir, "documents"), lambda text: byteranks.loaded(vocabulary, pattern).encode(text),
                                   BYTE_END_ID)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op12_importance_resampling(spark, sf_dir):
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_zone_clusters(spark, sf_dir):
    found = zones.cluster(_table(spark, sf_dir, "embeddings"), k=16, rounds=3)
    centroid = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid.alias("centroid_sha256"))
