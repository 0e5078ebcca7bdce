"""Ranks, quantiles, running sums and p-value adjustment without a one-task sort.

A plain window over a whole family puts the family on one task.  Here equal
values are first collapsed (map-side), every value falls in a fixed bucket that
grows with the value, and only the bucket totals are scanned per family.  The
bucket is a function of the value alone, so a retried task always agrees with
the first attempt.  The number of buckets is bounded by the double format (512
per power of two), not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.functions.missing import finite
from countloom.session import reuse

STEPS_PER_OCTAVE = 512
TIE_SPREAD = 3  # hex digits of the hash: 4096 slices of one tie group


def _bucket(value: Column) -> Column:
    size = F.floor((F.log2(F.abs(value)) + F.lit(1100.0)) * STEPS_PER_OCTAVE)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _family(by: Sequence[str]):
    return W.partitionBy(*by) if by else W.partitionBy(F.lit(0))


def cumulative(
    df: DataFrame, value: str, by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per (family, distinct value) with running sums of each measure.

    For measure ``m``: ``m`` at this value, ``m_below`` over smaller values and
    ``m_total`` over the family.  Keys must not be null; null values are left out.
    """
    by = list(by)
    measures = dict(measures or {"n": F.lit(1)})
    values = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias(value))
        .agg(*[F.sum(m).alias(name) for name, m in measures.items()])
        .withColumn("_bucket", _bucket(F.col(value)))
    )
    buckets = values.groupBy(*by, "_bucket").agg(*[F.sum(m).alias(f"_{m}_in") for m in measures])
    before = _family(by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_{m}_in").over(before), F.lit(0)).alias(f"_{m}_before") for m in measures],
        *[F.sum(f"_{m}_in").over(_family(by)).alias(f"{m}_total") for m in measures],
    )
    inside = W.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    running = values.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_inside") for m in measures]
    )
    joined = running.join(buckets, [*by, "_bucket"])
    return joined.select(
        *by,
        value,
        "_bucket",
        *measures,
        *[(F.col(f"_{m}_before") + F.col(f"_{m}_inside")).alias(f"{m}_below") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def avg_rank(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Rank with ties averaged, added to every row."""
    ranks = cumulative(df, value, by).select(
        *by, F.col(value).alias("_v"), (F.col("n_below") + (F.col("n") + 1) / 2.0).alias(out)
    )
    keyed = df.withColumn("_v", F.col(value).cast("double"))
    return keyed.join(ranks, [*by, "_v"], "left").drop("_v")


def quantiles(df: DataFrame, value: str, by: Sequence[str], points: Mapping[str, float], times: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation; one row per family.

    ``times`` names a whole number: how often a row counts, once without it.
    """
    ranks = cumulative(df, value, by, {"n": F.col(times)} if times else None)
    aggs, outs = [], []
    for name, q in points.items():
        position = F.lit(float(q)) * (F.col("n_total") - 1)
        for end, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            hit = (F.col("n_below") <= index) & (index < F.col("n_below") + F.col("n"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{end}"))
        aggs.append(F.max(position - F.floor(position)).alias(f"_{name}_part"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outs.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
    return ranks.groupBy(*by).agg(*aggs).select(*by, *outs)


def bh_adjust(
    df: DataFrame, p: str, by: Sequence[str] = (), out: str = "padj", small: bool = False
) -> DataFrame:
    """Benjamini-Hochberg per family; missing p stays missing and is not counted.

    ``small`` is for families with a fixed bound (a handful of labels): one
    window per family.  Otherwise families of any size are spread over tasks.
    """
    by = list(by)
    value = finite(p)
    if small:
        up = _family(by).orderBy("_p").rangeBetween(W.unboundedPreceding, W.currentRow)
        down = _family(by).orderBy(F.col("_p").desc_nulls_last()).rangeBetween(W.unboundedPreceding, W.currentRow)
        keyed = df.withColumn("_p", value)
        keyed = keyed.withColumn(
            "_c",
            F.when(
                F.col("_p").isNotNull(),
                F.col("_p") * F.count("_p").over(_family(by)) / F.count("_p").over(up),
            ),
        )
        adjusted = F.when(F.col("_p").isNotNull(), F.least(F.lit(1.0), F.min("_c").over(down)))
        return keyed.withColumn(out, adjusted).drop("_p", "_c")
    keyed = reuse(df.withColumn("_p", value))
    ranks = cumulative(keyed, "_p", by).withColumn(
        "_c", F.col("_p") * F.col("n_total") / (F.col("n_below") + F.col("n"))
    )
    floors = ranks.groupBy(*by, "_bucket").agg(F.min("_c").alias("_m"))
    above = _family(by).orderBy(F.col("_bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    floors = floors.select(*by, "_bucket", F.min("_m").over(above).alias("_above"))
    within = W.partitionBy(*by, "_bucket").orderBy(F.col("_p").desc()).rowsBetween(W.unboundedPreceding, 0)
    adjusted = (
        ranks.withColumn("_in", F.min("_c").over(within))
        .join(floors, [*by, "_bucket"])
        .select(*by, "_p", F.least(F.lit(1.0), F.col("_in"), F.col("_above")).alias(out))
    )
    return keyed.join(adjusted, [*by, "_p"], "left").drop("_p")


def normalized_rank(df: DataFrame, by: Sequence[str], p: str, tie_key: str, out: str = "normalized_rank") -> DataFrame:
    """Position of p within the family divided by the family size.

    Ties are ordered by the md5 of ``tie_key``: fixed, and it spreads one hot
    tied value over 4096 slices instead of one task.
    """
    by = list(by)
    keyed = df.withColumn("_p", F.col(p).cast("double")).withColumn("_h", F.md5(F.col(tie_key).cast("string")))
    keyed = reuse(keyed.withColumn("_s", F.substring("_h", 1, TIE_SPREAD)))
    below = cumulative(keyed, "_p", by).select(*by, "_p", "n_below", "n_total")
    slices = keyed.groupBy(*by, "_p", "_s").agg(F.count(F.lit(1)).alias("_in"))
    earlier = W.partitionBy(*by, "_p").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.select(*by, "_p", "_s", F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(W.partitionBy(*by, "_p", "_s").orderBy("_h"))
    return (
        keyed.withColumn("_local", local)
        .join(slices, [*by, "_p", "_s"])
        .join(below, [*by, "_p"])
        .withColumn(out, (F.col("n_below") + F.col("_before") + F.col("_local")) / F.col("n_total"))
        .drop("_p", "_h", "_s", "_local", "_before", "n_below", "n_total")
    )


def best_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key.  A struct minimum, so partial results combine map-side."""
    names = [f"_o{i}" for i in range(len(order))]
    rest = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[o.alias(n) for o, n in zip(order, names)], *[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.min(ordered).alias("_best"))
    return picked.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def head_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per group (Spark prunes per task before the shuffle)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def duplicates(df: DataFrame, keys: Sequence[str], line: str) -> DataFrame:
    """Rows after the first of each key, with the line of that first row."""
    first = df.groupBy(*keys).agg(F.min(line).alias("first_line"), F.count(F.lit(1)).alias("_n"))
    again = first.where(F.col("_n") > 1).drop("_n")
    return df.join(again, list(keys)).where(F.col(line) > F.col("first_line"))
