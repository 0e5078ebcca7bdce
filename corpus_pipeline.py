"""Corpus pipeline: rules, classifier, near-duplicate removal, mixing and encoding, each stage on what the one before kept.

Every stage takes all rows of its predecessor.  All but the last return the
columns of ``documents``.  Empty input passes through every stage as no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countloom.llm.bpe import encode_decode
from countloom.llm.mixing import in_training_order, mix
from countloom.llm.ngram_join import one_of_each
from countloom.llm.quality_classifier import fit, score
from countloom.llm.quality_rules import quality_rules
from countloom.llm.store import stored
from countloom.session import scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
THRESHOLD = 0.3
WEIGHTS, SHARE = (3, 1, 2), 1.5


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps.

    It learns from all labelled documents of the corpus, since those that the
    rules kept are nearly all good, and judges the rows of this stage.
    """
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs.select(*COLUMNS), fit(corpus, labels, threshold=THRESHOLD)).where("predicted = 1").select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id."""
    return one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, as often as it takes them, in the order of their training positions.

    A document taken in part is written whole: encoding works on whole texts.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "mixed")
    mixed = mix(rows, WEIGHTS, SHARE, keep=("_row",)).where("passes > 0").select("_row", "passes", "position")
    taken = rows.join(mixed, "_row").withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    return in_training_order(taken).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, checked against their decoded text."""
    made = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return made.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", deduplicate),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", encode),
]

#: The classifier is fitted and the tokenizer is a library: no SQL for run().
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
