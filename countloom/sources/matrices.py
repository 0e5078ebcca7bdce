"""Count matrices, triplets, gene sets and quantifier output."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.functions.missing import is_missing, to_number
from countloom.functions.text import kept
from countloom.operators.cells import identity_conflicts
from countloom.operators.counts import count_type, profile_matrix
from countloom.sources.tables import numbered_lines


MALFORMED = "_malformed"


def wide_rows(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(rows of a wide matrix, names in its header); comma or tab by the header's counts.

    Columns are read by place: ``c0`` is the gene, ``_malformed`` the text of a row
    with another number of fields than the header.  Names may hold anything, repeats
    included.
    """
    head = spark.read.text(path).first()
    if head is None:
        return spark.createDataFrame([], f"c0 string, {MALFORMED} string"), []
    sep = "," if head[0].count(",") > head[0].count("\t") else "\t"
    names = next(csv.reader([head[0]], delimiter=sep), [""])
    schema = ", ".join([*[f"c{i} string" for i in range(len(names))], f"{MALFORMED} string"])
    # Without pruning the fields of a row are counted whatever columns are asked for.
    read = spark.read.schema(schema).options(header=True, sep=sep, columnPruning=False, columnNameOfCorruptRecord=MALFORMED)
    return read.csv(path), names


def read_count_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Wide matrix to (gene_id, sample_id, value_text), one row for each column of each gene.

    A row short of fields has nulls in the rest; ``matrix_problems`` lists it.
    """
    return _cells(*wide_rows(spark, path))


def _cells(rows: DataFrame, names: list[str]) -> DataFrame:
    if len(names) < 2:
        return rows.sparkSession.createDataFrame([], "gene_id string, sample_id string, value_text string")
    cells = rows.select(F.col("c0").alias("gene_id"), F.posexplode(F.array(*[f"c{i}" for i in range(1, len(names))])).alias("_at", "value_text"))
    return cells.select("gene_id", F.get(F.lit(names[1:]), F.col("_at")).alias("sample_id"), "value_text")


def matrix_problems(spark: SparkSession, path: str) -> DataFrame:
    """One row (problem, gene_id, text) for each fault: rows of another width than the header, and columns named twice."""
    rows, names = wide_rows(spark, path)
    wide = rows.where(F.col(MALFORMED).isNotNull()).select(F.lit("malformed_row").alias("problem"), F.col("c0").alias("gene_id"), F.col(MALFORMED).alias("text"))
    twice = [("repeated_column", None, name) for name, n in Counter(names[1:]).items() if n > 1]
    return wide.unionByName(spark.createDataFrame(twice, "problem string, gene_id string, text string"))


def inspect_matrix(spark: SparkSession, path: str) -> DataFrame:
    """One row on a wide matrix: what its values look like, its rows and its malformed rows.

    Malformed rows are counted and enter no other figure; a file without another row
    has nulls there.
    """
    rows, names = wide_rows(spark, path)
    sizes = rows.agg((F.count("c0") + F.count_if(F.col("c0").isNull())).alias("row_count"), F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed_rows"))
    entries = _cells(rows.where(F.col(MALFORMED).isNull()), names).withColumn("path", F.lit(path))
    whole = sizes.withColumn("path", F.lit(path)).join(profile_matrix(entries, ["path"]), "path", "left")
    # The file's name and header may say what the values are.
    hint = " ".join([path.rstrip("/").rsplit("/", 1)[-1], *names])
    return count_type(whole.withColumn("label", F.lit(hint))).drop("label")


def matrix_columns(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, position, copies) as the header has them, repeats included."""
    head = numbered_lines(spark, path).where(F.col("line") == 1)
    comma = F.regexp_count("text", F.lit(",")) > F.regexp_count("text", F.lit("\t"))
    names = F.when(comma, F.split("text", ",")).otherwise(F.split("text", "\t"))
    each = head.select(F.posexplode(F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0)))).alias("position", "sample_id"))
    return each.groupBy("sample_id").agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("copies"))


def write_wide(counts: DataFrame, samples: Sequence[str], path: str, value: str = "count") -> None:
    """Long counts to one wide TSV, columns in the reviewed order."""
    wide = counts.groupBy("gene_id").pivot("sample_id", list(samples)).agg(F.sum(value)).na.fill(0)
    wide.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


CELL_COLUMNS = ("cell_id", "dataset_id", "sample_id", "subject_id", "group", "cell_type", "gene_id", "count")


def cell_lines(spark: SparkSession, path: str) -> DataFrame:
    """The long single-cell table as text; all eight columns must be there."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    gone = [c for c in CELL_COLUMNS if c not in df.columns]
    if gone:
        raise ValueError(f"missing columns: {gone}")
    return df


def read_cell_counts(spark: SparkSession, path: str) -> DataFrame:
    """The long single-cell table with integer counts; other counts are null and listed by ``cell_problems``."""
    number = to_number("count")
    whole = F.when(number == F.rint(number), number).try_cast("bigint")
    return cell_lines(spark, path).withColumn("count", whole)


def cell_problems(spark: SparkSession, path: str) -> DataFrame:
    """One row (problem, cell_id, detail) for each fault of the long single-cell table.

    Counts that are no raw counts and rows without subject or group are found while
    reading; a cell id with several identities is one row.
    """
    df = cell_lines(spark, path)
    number = to_number("count")
    faults = kept(
        (is_missing("subject_id"), "missing_subject"),
        (is_missing("group"), "missing_group"),
        (number.isNull(), "not_a_number"),
        (number < 0, "negative_count"),
        (number != F.rint(number), "fractional_count"),
    )
    rows = df.select(F.explode(faults).alias("problem"), "cell_id", F.concat_ws(" ", "gene_id", "count").alias("detail"))
    several = identity_conflicts(df).select(F.lit("several_identities").alias("problem"), "cell_id", F.col("identities").cast("string").alias("detail"))
    return rows.unionByName(several)


def listed_names(spark: SparkSession, path: str, place: str, name: str) -> DataFrame:
    """(place, name) of a list of names, one on a line; the files of a folder follow each other by path."""
    lines = numbered_lines(spark, path)
    sizes = lines.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))  # one row per file
    starts = sizes.select("file", F.coalesce(before, F.lit(0)).alias("_before"))
    return lines.join(F.broadcast(starts), "file").select((F.col("_before") + F.col("line")).alias(place), F.split("text", "\t")[0].alias(name))


def mtx_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entry lines of MatrixMarket files with their fields: file, line, text, row, column, count, fields, and the announced number.

    Comment lines start with ``%``; the first other line of a file holds its size.
    """
    lines = numbered_lines(spark, path).where(~F.col("text").startswith("%") & (F.trim("text") != ""))
    cells = F.split(F.trim("text"), r"\s+")
    # One row per file, sent to the lines: a file's lines never meet in one task.
    first = F.min_by(F.struct("line", F.get(cells, F.lit(2)).try_cast("bigint").alias("announced")), "line")
    sizes = lines.groupBy("file").agg(first.alias("_size"))
    entries = lines.join(F.broadcast(sizes), "file").where(F.col("line") > F.col("_size.line"))
    return entries.select(
        "file", "line", "text", F.get(cells, F.lit(0)).try_cast("bigint").alias("row"), F.get(cells, F.lit(1)).try_cast("bigint").alias("column"),
        to_number(F.get(cells, F.lit(2))).alias("count"), F.size(cells).alias("fields"), F.col("_size.announced").alias("announced"),
    )


def read_mtx(spark: SparkSession, path: str, features: str, barcodes: str) -> DataFrame:
    """Triplets of MatrixMarket files beside their names by 1-based position.

    No entry is lost: a position outside a name list has a null name, a value that
    is no number a null count.  ``mtx_problems`` lists those lines.
    """
    entries = mtx_entries(spark, path).select("row", "column", "count")
    named = entries.join(listed_names(spark, features, "row", "gene_id"), "row", "left").join(listed_names(spark, barcodes, "column", "barcode"), "column", "left")
    return named.select("barcode", "gene_id", "count")


def mtx_problems(spark: SparkSession, path: str, features: str, barcodes: str) -> DataFrame:
    """One row (problem, file, line, text) for each fault of an entry line, and one for each file with another number of entries than its size line says."""
    entries = mtx_entries(spark, path)
    sizes = listed_names(spark, features, "row", "name").agg(F.count(F.lit(1)).alias("_rows")).crossJoin(listed_names(spark, barcodes, "column", "name").agg(F.count(F.lit(1)).alias("_columns")))
    # Names stand on consecutive lines, so two counts say which positions have one.
    known = entries.crossJoin(F.broadcast(sizes))  # a single row
    faults = kept(
        (F.col("fields") != 3, "not_three_fields"),
        (F.col("count").isNull(), "not_a_number"),
        (F.coalesce(~F.col("row").between(1, F.col("_rows")), F.lit(True)), "row_without_name"),
        (F.coalesce(~F.col("column").between(1, F.col("_columns")), F.lit(True)), "column_without_name"),
    )
    lines = known.select(F.explode(faults).alias("problem"), "file", "line", "text")
    whole = entries.groupBy("file", "announced").agg(F.count(F.lit(1)).alias("n")).where(~F.col("announced").eqNullSafe(F.col("n")))
    return lines.unionByName(whole.select(F.lit("entry_count_mismatch").alias("problem"), "file", F.lit(None).cast("bigint").alias("line"), F.concat_ws(" ", "announced", "n").alias("text")))


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """(set_name, gene_id, position): name, description, then genes.

    A large set may go over several lines of one name; repeats are dropped and the
    first line that names a gene is its position.
    """
    lines = numbered_lines(spark, path).withColumn("_c", F.split("text", "\t")).where(F.size("_c") >= 3)
    genes = lines.select(F.col("_c")[0].alias("set_name"), "line", F.explode(F.slice("_c", 3, F.size("_c") - 2)).alias("gene_id")).where(F.col("gene_id") != "")
    return genes.groupBy("set_name", "gene_id").agg(F.min("line").alias("position"))


def read_quant(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Transcript tables (Name, Length, EffectiveLength, TPM, NumReads); the folder names the sample."""
    schema = "Name string, Length double, EffectiveLength double, TPM double, NumReads double"
    df = spark.read.schema(schema).option("header", True).option("sep", "\t").csv(paths if isinstance(paths, str) else list(paths))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.select(folder.alias("sample_id"), F.col("Name").alias("transcript_id"), F.col("EffectiveLength").alias("length"), F.col("TPM").alias("abundance"), F.col("NumReads").alias("count"))


def tx_to_gene(quant: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Gene counts and abundance summed; length is the abundance-weighted mean.

    Counts come rounded half to even and unrounded.
    """
    joined = quant.join(tx2gene.select("transcript_id", "gene_id").distinct(), "transcript_id")
    sums = joined.groupBy("sample_id", "gene_id").agg(
        F.sum("count").alias("count_estimate"), F.sum("abundance").alias("abundance"), F.sum(F.col("abundance") * F.col("length")).alias("_w"), F.avg("length").alias("_plain"))
    return sums.select("sample_id", "gene_id", F.bround("count_estimate").cast("bigint").alias("count"), "count_estimate", "abundance", F.when(F.col("abundance") > 0, F.col("_w") / F.col("abundance")).otherwise(F.col("_plain")).alias("length"))


def repeated_transcripts(tx2gene: DataFrame) -> DataFrame:
    return tx2gene.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def normalize_feature_counts(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, value, problem): last column is the count; ``#`` lines are dropped."""
    lines = numbered_lines(spark, path).where(~F.col("text").startswith("#"))
    head = lines.groupBy("file").agg(F.min("line").alias("_head"))
    cells = F.split("text", "\t")
    rows = lines.join(F.broadcast(head), "file").where(F.col("line") > F.col("_head")).withColumn("_c", cells)
    value = F.element_at("_c", -1)
    bad = F.when(F.size("_c") < 7, F.lit("fewer_than_seven_columns")).when(~value.rlike("^[0-9]+$"), F.lit("not_a_count"))
    return rows.select(F.col("_c")[0].alias("gene_id"), F.when(bad.isNull(), value).try_cast("bigint").alias("count"), bad.alias("problem"))


def quant_metrics(logs: DataFrame, samples: DataFrame) -> DataFrame:
    """Reads and mapping rate per sample from quantifier logs (sample_id, kind, text).

    ``json`` logs give num_processed, num_mapped and maybe percent_mapped; ``pipe``
    logs give lines ``name | value``.
    """
    field = lambda n: F.get_json_object("text", f"$.{n}").try_cast("double")
    done, mapped, percent = field("num_processed"), field("num_mapped"), field("percent_mapped")
    from_json = logs.where(F.col("kind") == "json").select("sample_id", done.alias("read_count"), F.coalesce(percent, F.when(done > 0, 100.0 * mapped / done)).alias("mapping_rate"), F.lit("json_log").alias("metric_source"))
    parts = logs.where(F.col("kind") == "pipe").select("sample_id", F.explode(F.split("text", "\n")).alias("_l")).select("sample_id", F.trim(F.split_part("_l", F.lit("|"), F.lit(1))).alias("_k"), F.trim(F.split_part("_l", F.lit("|"), F.lit(2))).alias("_v"))
    number = F.regexp_replace("_v", "%", "").try_cast("double")
    pick = lambda n: F.max(F.when(F.col("_k") == n, number))
    from_pipe = parts.groupBy("sample_id").agg(pick("Number of input reads").alias("read_count"), (F.coalesce(pick("Uniquely mapped reads %"), F.lit(0.0)) + F.coalesce(pick("% of reads mapped to multiple loci"), F.lit(0.0))).alias("mapping_rate")).withColumn("metric_source", F.lit("pipe_log"))
    return samples.select("sample_id").distinct().join(from_json.unionByName(from_pipe), "sample_id", "left").withColumn("metric_source", F.coalesce("metric_source", F.lit("not_available")))
