"""File inventory with checksums, and read-file integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countloom.operators.audit import is_raw_sequence, module_of
from countloom.sources.tables import numbered_lines


def inventory_files(spark: SparkSession, root: str, skip_raw: bool = True) -> DataFrame:
    """Path, module, size, sha256 and time of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    if skip_raw:
        files = files.where(~is_raw_sequence("path"))
    return files.select("path", module_of("path").alias("module"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("modified_utc"))


def fastq_integrity(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per file: line and record counts, and whether every record has its markers.

    Lines are numbered across splits, so the largest file is as parallel as its splits.
    """
    lines = numbered_lines(spark, paths)
    turn = (F.col("line") - 1) % 4
    per = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if((turn == 0) & ~F.col("text").startswith("@")).alias("bad_headers"), F.count_if((turn == 2) & ~F.col("text").startswith("+")).alias("bad_separators"))
    fine = (F.col("lines") > 0) & (F.col("lines") % 4 == 0) & (F.col("bad_headers") == 0) & (F.col("bad_separators") == 0)
    return per.withColumn("records", F.floor(F.col("lines") / 4)).withColumn("integrity", F.when(fine, F.lit("pass")).otherwise(F.lit("fail")))
