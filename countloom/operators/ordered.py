"""Order within a key over many tasks: ranges of rows, stitched at their borders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.session import reuse


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with ``_range``, the number of the range of (keys, order) they lie in.

    Equal rows share a range, and ranges follow each other, so one key fills as
    many ranges as its size asks for.  The result is written once: later passes
    and retried tasks agree on the borders.
    """
    return reuse(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))


def _carry(rows: DataFrame, keys: list[str], measure: Column, before: Column) -> DataFrame:
    """``rows`` with ``_carried``: ``before`` over the measures of the key's earlier ranges.

    Only a key that crosses a border has earlier ranges, and a border is crossed by
    one key: the carried table has fewer rows than there are ranges.
    """
    ends = rows.groupBy(*keys, "_range").agg(measure.alias("_m")).withColumn("_carried", before).where(F.col("_carried").isNotNull())
    side = ends.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"), "_carried")
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)] + [F.col("_range") == F.col("_at")]
    return rows.join(F.broadcast(side), reduce(lambda a, b: a & b, same), "left").drop("_at", *[f"_key{i}" for i in range(len(keys))])


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], name: str = "previous") -> DataFrame:
    """The rows with ``name``: a struct of the columns of the key's row before, null for its first.

    Rows that tie in ``order`` follow each other by ``columns``; a null key is a key
    of its own.
    """
    keys, line = list(keys), [*order, *columns]
    here, place = F.struct(*columns), F.struct(*line)
    before = F.lag("_m").over(W.partitionBy(*keys).orderBy("_range"))
    rows = _carry(ranged(df, keys, order), keys, F.max_by(here, place), before)
    local = F.lag(here).over(W.partitionBy(*keys, "_range").orderBy(*line))
    return rows.withColumn(name, F.coalesce(local, "_carried")).drop("_range", "_carried")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """The rows with ``name``: their place within the key, from 1, by any sortable order."""
    keys = list(keys)
    before = F.sum("_m").over(W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    rows = _carry(ranged(df, keys, order), keys, F.count(F.lit(1)), before)
    local = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order))
    return rows.withColumn(name, local + F.coalesce("_carried", F.lit(0))).drop("_range", "_carried")
