"""Written intermediate tables and global positions, shared by the operators here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.session import scratch

#: Rows that one range of a global order should hold.
ROWS_PER_RANGE = 200_000


def stored(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder, in a folder for each value of ``by``, and read it back.

    Cuts the lineage: a lost executor costs a re-read, and values that depend on
    the layout of the partitions are fixed once written.
    """
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(
    df: DataFrame,
    order: Sequence[Column],
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Adds ``<m>_before``: the sum of measure m over the rows that precede in ``order``.

    With ``by``, sums start anew for each value (nulls are a value) and ``by``
    leads the order.  The rows are range-partitioned and written; each range is
    summed by itself and only the totals of the ranges are scanned, so no key and
    no single task holds the whole table.  Rows equal in ``order`` keep the order
    they were read in.  Column names starting with ``_`` are reserved.
    """
    by = list(by)
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if ranges is None:
        ranges = max(parts, df.count() // ROWS_PER_RANGE + 1)
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.withColumns(
        {
            **{n: c for n, c in zip(names, order)},
            **{f"_m_{m}": c for m, c in measures.items()},
            "_row": F.monotonically_increasing_id(),
        }
    )
    keys = [F.col(c) for c in [*by, *names, "_row"]]
    dealt = stored(
        keyed.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id()), "ordered"
    )
    totals = dealt.groupBy(*by, "_range").agg(*[F.sum(f"_m_{m}").alias(f"_t_{m}") for m in measures])
    # One row per range (and key inside it): as many as there are ranges and keys, never as rows.
    earlier = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    earlier = earlier.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
        F.col("_range").alias("_r"),
        *[F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_b_{m}") for m in measures],
    )
    inside = W.partitionBy(*by, "_range").orderBy(*names, "_row").rowsBetween(W.unboundedPreceding, -1)
    local = dealt.withColumns({f"_i_{m}": F.coalesce(F.sum(f"_m_{m}").over(inside), F.lit(0)) for m in measures})
    match = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(totals, match)
    return joined.select(
        *df.columns, *[(F.col(f"_b_{m}") + F.col(f"_i_{m}")).alias(f"{m}_before") for m in measures]
    )
