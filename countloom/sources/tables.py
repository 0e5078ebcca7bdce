"""Reviewed tables, result tables, JSON and event logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countloom.functions.missing import or_na
from countloom.schemas import TABLES


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line, text) with true line numbers, whatever the number of splits.

    A line's number is the count of lines in the file's earlier splits plus its
    place in its own split, so no file has to fit one task.
    """
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("text"))
    from pyspark.sql import Window as W

    splits = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("file", "_block", "_first", before.alias("_before"))
    # One row per split: the lines stay where they are read instead of meeting by split in one task.
    return lines.join(F.broadcast(starts), ["file", "_block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"), "text")


def read_authority(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Reviewed TSV with the fixed columns, all text; a missing file is an empty table.

    The line number stays with each row so that issues can point at it.
    """
    columns = TABLES[table].columns
    try:
        lines = numbered_lines(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns) + ", line bigint")
    cells = F.split("text", "\t", -1)
    body = lines.where((F.col("line") > 1) & (F.regexp_replace("text", "\t", "") != "")).withColumn("_c", cells).where(F.size("_c") == len(columns))
    return body.select(*[F.col("_c")[i].alias(c) for i, c in enumerate(columns)], F.col("line").cast("bigint").alias("line"))


def write_table(df: DataFrame, columns: Sequence[str], path: str, fill: str | None = None) -> None:
    """TSV with the given columns in order; further columns are dropped."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    if fill is not None:
        out = out.select(*[(or_na(c) if fill == "NA" else F.coalesce(c, F.lit(fill))).alias(c) for c in columns])
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("lineSep", "\n").option("quote", "").option("emptyValue", "").csv(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A TSV folder written by ``write_table``; all text, no inference pass."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def read_runinfo(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def merge_events(events: Sequence[DataFrame]) -> DataFrame:
    """Event tables stacked and ordered by time."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), events)
    return whole.orderBy("timestamp_utc")
