"""Token counts without a shuffle of pre-tokens: two tiers of look-up inside the map tasks.

The first tier is a compact table from frequent pre-tokens to their token
counts, broadcast to all tasks.  Pre-tokens that it lacks go to a bounded cache
of the worker, and those that are new there are encoded, once, by the library.
Counts are the same with any table; the table only saves time.

A pre-token here is a space with all that follows up to the next space between
two non-blanks.  The vocabulary's own pattern never crosses such a space (it
belongs to what follows), so the counts of the pre-tokens add up.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm import vocab
from countloom.llm.ship import ship

TABLE_SIZE = 32_768
SAMPLE_ROWS = 2_000
CACHE_SIZE = 400_000

#: A space between two non-blanks.
BETWEEN = regex.compile(r"(?<=\S) (?=\S)")

_worker: dict = {}


class _Counts(dict):
    """Pre-token to token count, 0 for one that is not there."""

    def __missing__(self, key: str) -> int:
        return 0


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text; all but the first lack their leading space."""
    if vocab.plain(text) and "  " not in text and " \n" not in text and "\n " not in text and text[0] != " " != text[-1]:
        return text.split(" ")
    return BETWEEN.split(text)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the pre-tokens of a task, those seen once left out; memory is bounded by dropping the rarest."""
    seen: Counter = Counter()
    for batch in batches:
        for t in batch["t"]:
            if t:
                seen.update(pre_tokens(t)[1:])
            if len(seen) > 4 * CACHE_SIZE:
                seen = Counter(dict(seen.most_common(CACHE_SIZE)))
    rows = [(p, n) for p, n in seen.items() if n > 1 and len(p) <= 64]
    yield pd.DataFrame({"piece": [p for p, _ in rows], "n": [n for _, n in rows]}).astype({"piece": object, "n": "int64"})


def frequent(docs: DataFrame, text: str, id_col: str, size: int = TABLE_SIZE, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The ``size`` most frequent pre-tokens of about ``sample_rows`` rows, picked by the hash of id and text.

    The sample bounds everything that moves: each task sums its own sampled rows
    before anything is shuffled, and at most ``size`` strings reach the driver.
    """
    rows = docs.count()
    if not rows:
        return []
    keep = min(1.0, sample_rows / rows)
    spot = F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(1_000_003)) < F.lit(int(keep * 1_000_003) + 1)
    counted = docs.where(spot & F.col(text).isNotNull()).select(F.col(text).alias("t")).mapInPandas(_sums, "piece string, n long")
    best = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "piece").limit(size)
    return [r["piece"] for r in best.collect()]


class Encoder:
    """Token counts of single pre-tokens, by the quickest library that must agree with the file's own."""

    def __init__(self, content: bytes, quick: bool) -> None:
        self.library = vocab.tokenizer(content)
        self.quick = vocab.quick_encoder(content, vocab.SPLIT) if quick else None

    def lengths(self, pieces: list[str]) -> list[int]:
        if self.quick is None or not all(map(vocab.plain, pieces)):
            return list(map(len, self.library.encode_batch_fast(pieces, add_special_tokens=False)))
        return list(map(len, map(self.quick.encode_ordinary, pieces)))


def _setup(key: str, content: Broadcast, quick: bool, table: Broadcast) -> dict:
    """What a worker keeps from task to task: the encoder, the shared table and its own cache."""
    if _worker.get("key") != key:
        parts, ids = vocab.special_pattern(content.value)
        _worker.clear()
        _worker.update(
            key=key, encoder=Encoder(content.value, quick), parts=parts, marks=tuple(ids), table=_Counts(table.value), cache={}
        )
    return _worker


def _count_part(text: str, have: dict) -> int:
    """Tokens of a text without special strings."""
    if not text:
        return 0
    first, *pieces = pre_tokens(text)
    counts = list(map(have["table"].__getitem__, pieces))
    total = have["encoder"].lengths([first])[0] + sum(counts)
    if 0 in counts:
        cache = have["cache"]
        rare = [p for p, n in zip(pieces, counts) if not n]
        if len(cache) > CACHE_SIZE:
            cache.clear()
        fresh = [p for p in dict.fromkeys(rare) if p not in cache]
        if fresh:
            cache.update(zip(fresh, have["encoder"].lengths([f" {p}" for p in fresh])))
        total += sum(map(cache.__getitem__, rare))
    return total


def count_text(text: str, have: dict) -> int:
    """Tokens of one whole text by the library's own default treatment of special strings."""
    if not any(mark in text for mark in have["marks"]):
        return _count_part(text, have)
    parts = have["parts"].split(text)
    return sum(_count_part(part, have) for part in parts[::2]) + len(parts) // 2


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", limit: int = 1024,
    table_size: int = TABLE_SIZE, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Counts are those of the tokenizers library for the byte-level vocabulary at
    ``path`` without added special tokens; special strings inside a text count as
    the one token that the library's default makes of them.  Null and empty texts
    count 0.  Only the two named columns are read; repeated rows stay.
    """
    spark = docs.sparkSession
    ship(spark)
    content, quick = vocab.broadcast_file(spark, path)
    pieces = frequent(docs, text, id_col, table_size, sample_rows)
    made = Encoder(content.value, quick)
    marks = vocab.special_pattern(content.value)[1]
    pieces = [p for p in pieces if not any(m in p for m in marks)]
    # At most table_size entries of at most 64 characters.
    table = spark.sparkContext.broadcast(dict(zip(pieces, made.lengths([f" {p}" for p in pieces]))))
    key = uuid.uuid4().hex

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        have = _setup(key, content, quick, table)
        return pd.Series([count_text(t, have) if t else 0 for t in texts], dtype="int64")

    body: Column = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(F.col(id_col), F.octet_length(body).cast("bigint").alias("n_bytes"), tokens(body).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
