"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is cut into 2^bits levels, the levels of a row name a cell, and
the position of the cell on the Hilbert curve orders the rows.  Runs of that
order become shards, so a shard covers a compact region and min/max statistics
prune it in every dimension at once.  Runs are cut by exact cumulative rows or
bytes.  All of it is column expressions; the only collected values are the
2^bits - 1 cut points of a dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm.store import running, stored

BITS = 4


def cut_points(df: DataFrame, column: str, levels: int) -> list:
    """At most ``levels - 1`` values that part the rows into nearly equal shares; nulls are not counted.

    Values are counted map-side first, so a hot value costs one row per task.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    values = running(values, [F.col("v")], {"n": F.col("n")})
    total = values.agg(F.sum("n")).first()[0] or 0
    if not total:
        return []
    level = F.floor(F.col("n_before") * levels / F.lit(total))
    starts = values.groupBy(level.alias("level")).agg(F.min("v").alias("v")).where(F.col("level") > 0)
    return sorted(r["v"] for r in starts.collect())


def level_of(column: str, cuts: Sequence) -> Column:
    """How many cut points are at or below the value; nulls share level 0."""
    level = F.lit(0)
    for cut in cuts:
        level = level + F.when(F.col(column) >= F.lit(cut), 1).otherwise(0)
    return level.cast("int")


def size_level(column: str, bits: int) -> Column:
    """Level of a size on a logarithmic scale from 1 byte to 16 MB; larger ones share the last level."""
    top = (1 << bits) - 1
    return F.least(F.lit(top), F.floor(F.log2(F.greatest(F.col(column), F.lit(1)).cast("double")) * top / 24.0)).cast("int")


def curve_table(dims: int, bits: int) -> list[int]:
    """Position on the Hilbert curve of every cell, cells in mixed-radix order of their levels.

    From the highest bit down, the lower bits of the axes are reflected or
    exchanged with those of the first axis, so that neighbouring sub-cubes join;
    the Gray code of what results is the index.
    """
    out = []
    for cell in range(1 << (dims * bits)):
        x = [(cell >> (bits * (dims - 1 - i))) & ((1 << bits) - 1) for i in range(dims)]
        q = 1 << (bits - 1)
        while q > 1:
            for i in range(dims):
                if x[i] & q:
                    x[0] ^= q - 1
                else:
                    t = (x[0] ^ x[i]) & (q - 1)
                    x[0] ^= t
                    x[i] ^= t
            q >>= 1
        for i in range(1, dims):
            x[i] ^= x[i - 1]
        t, q = 0, 1 << (bits - 1)
        while q > 1:
            t ^= (q - 1) if x[dims - 1] & q else 0
            q >>= 1
        index = 0
        for bit in range(bits - 1, -1, -1):
            for v in x:
                index = index * 2 + (((v ^ t) >> bit) & 1)
        out.append(index)
    return out


def hilbert_shards(
    docs: DataFrame,
    shards: int,
    law: str = "rows",
    id_col: str = "doc_id",
    text: str = "text",
    dims: Sequence[str] = ("source", "lang"),
    bits: int = BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, the dims, hilbert, shard and slot.

    ``size`` is the UTF-8 length of the text (null: 0) plus 8.  ``law`` says what
    the shards share equally: ``rows`` (counts differ by at most one) or ``bytes``
    (cumulative size).  Dimensions are the given columns and the size.  ``slot``
    counts from 0 within the shard without gaps.  Null dimensions share the lowest
    level, equal cells are ordered by id, rows equal in everything keep the order
    they were read in, and an empty table gives no rows.  Only the named columns
    are read; others, clashing or not, are left out.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint") + 8).alias("size"),
        F.crc32(body).cast("bigint").alias("text_crc32"),
        *[F.col(d).alias(f"d{i}") for i, d in enumerate(dims)],
    )
    slim = stored(slim, "slim")
    levels = 1 << bits
    axes = [level_of(f"d{i}", cut_points(slim, f"d{i}", levels)) for i in range(len(dims))]
    axes.append(size_level("size", bits))
    # The index of a cell looks up a constant table: at most 2^(bits * dims) entries, built by rule.
    cell = F.lit(0)
    for axis in axes:
        cell = cell * levels + axis
    table = F.array(*[F.lit(v) for v in curve_table(len(axes), bits)])
    placed = slim.withColumn("_cell", cell).withColumn("hilbert", F.get(table, F.col("_cell")).cast("bigint"))
    weight = F.lit(1).cast("bigint") if law == "rows" else F.col("size")
    ordered = running(placed.drop("_cell"), [F.col("hilbert"), F.col("id")], {"w": weight, "rank": F.lit(1).cast("bigint")})
    total = slim.agg(F.count(F.lit(1)) if law == "rows" else F.sum("size")).first()[0] or 1
    cut = ordered.withColumn("shard", F.floor(F.col("w_before") * F.lit(shards) / F.lit(total)).cast("int"))
    firsts = cut.groupBy("shard").agg(F.min("rank_before").alias("_first"))
    # One row per shard, so the broadcast is bounded by the number of shards.
    out = cut.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank_before") - F.col("_first"))
    return out.select(
        F.col("id").alias(id_col), "size", "text_crc32",
        *[F.col(f"d{i}").alias(d) for i, d in enumerate(dims)], "hilbert", "shard", "slot",
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in slot order, so readers can prune shards and row groups."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
