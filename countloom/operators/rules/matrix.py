"""Rules on one bulk count matrix in long text form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import is_integral
from countloom.operators.counts import looks_normalized, profile_matrix
from countloom.operators.joins import check_order, match_samples
from countloom.operators.rules.issues import blocking, issue, listed, passed, union


def validate_counts(entries: DataFrame, samples: DataFrame, labels: DataFrame, columns: DataFrame | None = None, unreadable: DataFrame | None = None) -> DataFrame:
    """Every rule of the matrix contract, per dataset.

    ``entries`` (dataset_id, gene_id, sample_id, value_text); ``samples`` reviewed
    rows with ``position``; ``labels`` (dataset_id, label) file and column names;
    ``columns`` (dataset_id, sample_id, position) as they stand in the file.
    """
    ids = {"dataset_id": "dataset_id"}
    columns = columns if columns is not None else entries.select("dataset_id", "sample_id").distinct().withColumn("position", F.col("sample_id"))
    profile = profile_matrix(entries, ["dataset_id"])
    tagged = looks_normalized(profile.join(labels, "dataset_id", "left"), "bulk")
    datasets = samples.select("dataset_id").distinct()
    heads = columns.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("_c"))
    missing = datasets.join(heads, "dataset_id", "left_anti")
    empty = datasets.join(heads, "dataset_id", "left_semi").join(entries.select("dataset_id").distinct(), "dataset_id", "left_anti")
    twice = columns.groupBy("dataset_id", "sample_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    again = samples.groupBy("dataset_id", "sample_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    unmatched = match_samples(samples, columns).where(F.col("match_status") != "matched").join(missing, "dataset_id", "left_anti")
    off = listed(unmatched, ["dataset_id"], "sample_id")
    moved = check_order(samples, columns).where(~F.col("same_order")).join(off.select("dataset_id"), "dataset_id", "left_anti")
    critical = lambda df, check, text, action: issue(df, "critical", "bulk_matrix", check, text, action, **ids)
    parts = [
        critical(missing, "BULK_COUNT_MATRIX_MISSING", F.format_string("dataset %s has no matrix", "dataset_id"), "Restore the file."),
        critical(empty, "BULK_COUNT_MATRIX_EMPTY", F.format_string("the matrix of %s has no rows", "dataset_id"), "Provide gene rows."),
        critical(listed(twice, ["dataset_id"], "sample_id"), "DUPLICATE_BULK_SAMPLE_COLUMNS", F.format_string("%d columns are repeated", "n_items"), "Correct the columns."),
        critical(listed(again, ["dataset_id"], "sample_id"), "DUPLICATE_BULK_MANIFEST_SAMPLES", F.format_string("%d reviewed samples are repeated", "n_items"), "Correct the manifest."),
        critical(off, "BULK_SAMPLE_COLUMNS_MISMATCH", F.format_string("%d samples are on one side only", "n_items"), "Make both lists agree."),
        issue(moved, "error", "bulk_matrix", "BULK_SAMPLE_ORDER_MISMATCH", F.format_string("%d samples stand elsewhere", "moved"), "Rebuild the matrix in reviewed order.", **ids),
        critical(profile.where(F.col("blank_genes") > 0), "BLANK_BULK_GENE_IDS", F.format_string("%d gene ids are blank", "blank_genes"), "Restore the ids."),
        critical(profile.where(F.col("duplicate_genes") > 0), "DUPLICATE_BULK_GENE_IDS", F.format_string("%d gene ids are repeated", "duplicate_genes"), "Resolve the ids; rows are not summed."),
        critical(profile.where(F.col("non_numeric") > 0), "NON_NUMERIC_BULK_COUNTS", F.format_string("%d values are not numbers", "non_numeric"), "Use complete raw counts."),
        critical(profile.where(F.col("fractional") > 0), "NON_INTEGER_BULK_COUNTS", F.format_string("%d values have fractions", "fractional"), "Use raw counts."),
        critical(profile.where(F.col("negative") > 0), "NEGATIVE_BULK_COUNTS", F.format_string("%d values are negative", "negative"), "Use raw counts."),
        issue(profile.where((F.col("non_numeric") == 0) & (F.col("all_zero_genes") > 0)), "warning", "bulk_matrix", "ALL_ZERO_BULK_GENES", F.format_string("%d genes are all zero", "all_zero_genes"), "Filter later and say so.", F.struct("all_zero_genes"), **ids),
        critical(tagged.where("likely_normalized"), "NORMALIZED_BULK_MATRIX_SUSPECTED", "the values look normalised", "Use raw counts."),
    ]
    if unreadable is not None:
        parts.append(critical(unreadable, "BULK_COUNT_MATRIX_UNREADABLE", F.format_string("the matrix of %s cannot be parsed", "dataset_id"), "Provide a table with one header row."))
    found = union(parts)
    clean = datasets.join(blocking(found).select("dataset_id").distinct(), "dataset_id", "left_anti")
    return found.unionByName(passed(clean, "bulk_matrix", "BULK_COUNT_MATRIX_VALID", "the matrix keeps the contract", **ids))


def raw_count_problems(df: DataFrame, value: str = "count") -> DataFrame:
    """Rows that are not finite non-negative integers."""
    x = F.col(value).cast("double")
    broken = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))) | (x < 0) | ~is_integral(value)
    return df.where(F.coalesce(broken, F.lit(True)))


def assert_raw_counts(df: DataFrame, source: str, value: str = "count") -> DataFrame:
    """The same table, or an error when any value is not a raw count."""
    if raw_count_problems(df, value).limit(1).count():
        raise ValueError(f"{source} does not hold raw counts")
    return df
