"""Registered queries of the dealt operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countloom.llm import oracles, toxicity
from countloom.llm.bm25 import search
from countloom.llm.bpe import encode_decode
from countloom.llm.hilbert import hilbert_shards
from countloom.llm.host_reputation import filter_urls, url_parts
from countloom.llm.licenses import license_scan
from countloom.llm.mixing import in_training_order, mix
from countloom.llm.ngram_join import near_duplicates
from countloom.llm.periodic import find_runs, longest, repeated_tail
from countloom.llm.quality_classifier import features, fit, score
from countloom.llm.quality_rules import quality_rules
from countloom.llm.store import stored
from countloom.llm.token_counts import token_counts
from countloom.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents for the whole text of every document whose id is divisible by 100."""
    docs = _table(spark, sf_dir, "documents")
    queries = docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"))
    return search(docs, queries, 10)


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return made.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = hilbert_shards(_table(spark, sf_dir, "documents"), 24, "rows")
    return made.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree source/lang/hundred/id."""
    docs = _table(spark, sf_dir, "documents")
    folder = F.floor(F.col("doc_id") / 100).cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), folder, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = license_scan(docs.select(path.alias("path"), "text"))
    return found.select(F.substring_index("path", "/", -1).try_cast("bigint").alias("doc_id"), "path", "license", "cosine", "origin", "from_path")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    # One pass over the texts: learning and scoring read the written features.
    made = stored(features(docs.select("doc_id", "text")).drop("text"), "features")
    model = fit(made, labels.where(~held_out), text=None, threshold=0.3)
    return score(made, model, text=None).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mix(_table(spark, sf_dir, "documents"), (3, 1, 2), 1.5)
    return in_training_order(made).select("doc_id", "size", "source_size", "target", "taken", "passes", "position", "positions")


def op8_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's path ends in the number of the document it shows; the document's label is the page's outcome."""
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    host, path = url_parts(F.col("url"))
    shown = pages.select(host.alias("host"), F.regexp_extract(path, r"/(\d{1,18})(?:\.html|/)?$", 1).alias("n"))
    shown = shown.where(F.col("n") != "").select("host", F.col("n").cast("bigint").alias("doc_id"))
    bad = labels.select("doc_id", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    return filter_urls(pages, shown.join(bad, "doc_id").select("host", "bad"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out), threshold=0.7)
    made = toxicity.score(docs.select("doc_id", "text"), model)
    return made.select("doc_id", held_out.alias("held_out"), "score", "predicted", "segments")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of whole texts, a tenth of which get a periodic tail by their id."""
    made = find_runs(repeated_tail(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    made = made.withColumn("best", longest(F.col("runs")))
    return made.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector and component."""
    made = whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")
    made = made.select("*", F.posexplode("whitened").alias("at", "value"))
    return made.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").cast("bigint").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bm25_search, op2_bpe_tree, op3_hilbert_shards, op4_license_scan, op5_ngram_join, op6_quality_classifier,
        op7_mixing, op8_host_reputation, op9_token_counts, op10_quality_rules,
        op11_toxic_segments, op12_periodic_runs, op13_embedding_whitening, pipeline,
    )
}
ORACLES: dict[str, str] = oracles.SQL
