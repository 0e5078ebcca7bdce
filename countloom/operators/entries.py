"""What each reviewed or remote file is, and which pipeline may take it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, col, is_missing, or_na, present
from countloom.functions.text import is_single_cell

# Words in a remote file's name that hint at its content, in this order.
REMOTE_HINTS = ("matrix.mtx", "features.tsv", "barcodes.tsv", "filtered_feature_bc_matrix", ".h5ad", ".h5", ".rds", "count", "tpm", "fpkm", "fastq")
FIELDS = ("dataset_id", "sample_id", "data_type_confirmed", "entry_point", "file_path", "file_format", "file_size", "checksum", "count_type", "is_integer", "likely_normalized",
          "paired_end_status", "recommended_pipeline", "technical_consistency", "requires_manual_review", "source_type", "source_url", "source_id", "has_negative",
          "likely_log_transformed", "duplicate_gene_ids", "sample_columns_match", "status", "message")


def family(data_type: str | Column) -> Column:
    text = F.lower(F.coalesce(col(data_type), F.lit("")))
    return F.when(is_single_cell(text), F.lit("single_cell")).when(text.contains("bulk"), F.lit("bulk")).otherwise(F.lit("unknown"))


def entry_point(file_format: str, kind: str, count_type: str) -> Column:
    f, k = F.coalesce(F.col(file_format), F.lit("unknown")), F.col(kind)
    table = f.isin("tsv_matrix", "csv_matrix", "matrix_market")
    raw = F.coalesce(F.col(count_type) == "raw_integer_counts", F.lit(False))
    return (
        F.when((f == "fastq") & k.isin("bulk", "single_cell"), F.concat(k, F.lit("_fastq"))).when(f == "fastq", F.lit("fastq"))
        .when(f == "10x_mtx_directory", F.lit("single_cell_10x_mtx")).when(f == "cellranger_output_directory", F.lit("single_cell_cellranger_directory"))
        .when(f == "10x_h5", F.lit("single_cell_10x_h5")).when(f == "h5ad", F.lit("single_cell_h5ad")).when(f.startswith("rds"), F.lit("single_cell_rds_candidate"))
        .when(table & (k == "bulk") & raw, F.lit("bulk_gene_count_matrix")).when(table & (k == "bulk"), F.lit("bulk_expression_matrix_exploratory"))
        .when(table & (k == "single_cell"), F.lit("single_cell_matrix_candidate")).when(table, F.lit("expression_matrix")).otherwise(F.lit("unknown"))
    )


def pipeline(entry: str, count_type: str) -> Column:
    e = F.col(entry)
    return (
        F.when((e == "bulk_gene_count_matrix") & (F.col(count_type) == "raw_integer_counts"), F.lit("bulk_raw_count_qc_then_deseq2"))
        .when(e == "bulk_expression_matrix_exploratory", F.lit("exploratory_only_no_deseq2")).when(e == "bulk_fastq", F.lit("bulk_fastq_quantification"))
        .when(e.startswith("single_cell_"), F.lit("single_cell_raw_count_workflow")).otherwise(F.lit("manual_entry_selection_required"))
    )


def classify(rows: DataFrame, content: DataFrame) -> DataFrame:
    """Rows with ``file_path`` beside what was found in the file.

    ``content``: path, recognized, file_format, file_size, checksum, count_type,
    is_integer, likely_normalized, has_negative, likely_log_transformed,
    duplicate_gene_ids, sample_columns_match.
    """
    found = content.withColumnRenamed("path", "file_path")
    d = rows.join(found, "file_path", "left").withColumns({"file_format": F.coalesce("file_format", F.lit("missing")), "recognized": F.coalesce("recognized", F.lit(False)), "_family": family("data_type_confirmed")})
    d = d.withColumn("entry_point", entry_point("file_format", "_family", "count_type"))
    seen = F.when(F.col("entry_point").startswith("single_cell"), F.lit("single_cell")).when(F.col("entry_point").startswith("bulk"), F.lit("bulk")).otherwise(F.lit("unknown"))
    clash = (F.col("_family") != "unknown") & (seen != "unknown") & (F.col("_family") != seen)
    normal = (F.coalesce("likely_normalized", F.lit("NA")) == "true") & (F.col("_family") == "bulk")
    layer = (F.col("file_format") == "h5ad") & (F.coalesce("count_type", F.lit("")) == "requires_h5ad_layer_review")
    state = (
        F.when(clash, F.lit("error:data_type_file_conflict")).when(normal, F.lit("warning:normalized_matrix_exploratory_only")).when(~F.col("recognized"), F.lit("warning:unrecognized_content"))
        .when(layer, F.lit("warning:h5ad_raw_counts_unverified")).otherwise(F.lit("consistent"))
    )
    d = d.withColumns({
        "recommended_pipeline": pipeline("entry_point", "count_type"), "technical_consistency": state, "requires_manual_review": bool_text(state != "consistent"),
        "status": F.when(F.col("recognized"), F.lit("available")).otherwise(F.lit("unrecognized")), "message": F.concat(F.lit("content check: "), state),
    })
    return _fields(d)


def _fields(df: DataFrame) -> DataFrame:
    return df.select(*[(or_na(f) if f in df.columns else F.lit("NA")).alias(f) for f in FIELDS])


def classify_entries(samples: DataFrame, files: DataFrame, content: DataFrame) -> DataFrame:
    """Reviewed matrices, mates, runs, and supplementary files, one row each."""
    layout = F.upper(F.coalesce("library_layout", F.lit("NA")))
    mates = present("fastq_r1").cast("int") + present("fastq_r2").cast("int")
    paired = F.when((layout == "PAIRED") & (mates == 2), F.lit("complete")).when(layout == "PAIRED", F.lit("incomplete")).when(layout == "SINGLE", F.lit("single")).otherwise(F.lit("unknown"))
    base = samples.select("dataset_id", "sample_id", F.col("data_type").alias("data_type_confirmed"), "matrix_path", "fastq_r1", "fastq_r2", "srr_id", layout.alias("_layout"), paired.alias("_paired"))
    named = F.array(
        F.struct(F.col("matrix_path").alias("file_path"), F.lit("reviewed_matrix_path").alias("source_type"), F.lit("NA").alias("source_id"), F.lit("NA").alias("paired_end_status")),
        F.struct(F.col("fastq_r1").alias("file_path"), F.lit("reviewed_fastq_path").alias("source_type"), F.lit("R1").alias("source_id"), F.col("_paired").alias("paired_end_status")),
        F.struct(F.col("fastq_r2").alias("file_path"), F.lit("reviewed_fastq_path").alias("source_type"), F.lit("R2").alias("source_id"), F.col("_paired").alias("paired_end_status")),
    )
    local = base.select("dataset_id", "sample_id", "data_type_confirmed", F.explode(named).alias("_n")).select("dataset_id", "sample_id", "data_type_confirmed", "_n.*").where(present("file_path"))
    expect = F.when(F.col("_layout") == "PAIRED", F.lit("expected_paired")).when(F.col("_layout") == "SINGLE", F.lit("expected_single")).otherwise(F.lit("unknown"))
    runs = base.where(present("srr_id")).select(
        "dataset_id", "sample_id", "data_type_confirmed", F.concat(family("data_type_confirmed"), F.lit("_fastq_candidate")).alias("entry_point"), F.lit("sra_remote").alias("file_format"), expect.alias("paired_end_status"),
        F.lit("sra_prefetch_then_fasterq").alias("recommended_pipeline"), F.lit("unverified").alias("technical_consistency"), F.lit("true").alias("requires_manual_review"), F.lit("SRA").alias("source_type"),
        F.col("srr_id").alias("source_id"), F.lit("remote_candidate").alias("status"), F.lit("the run has not been checked locally").alias("message"))
    name = F.lower(F.concat_ws(" ", "file_name", "url", "file_type"))
    hints = F.array_compact(F.array(*[F.when(F.contains(name, F.lit(h)), F.lit(h)) for h in REMOTE_HINTS]))
    remote = files.select(
        "dataset_id", "sample_id", "data_type_confirmed", F.lit("unverified_remote_candidate").alias("entry_point"), F.lit("remote_uninspected").alias("file_format"), F.col("size_bytes").alias("file_size"), F.lit("unverified").alias("count_type"),
        F.lit("download_then_content_classification").alias("recommended_pipeline"), F.lit("warning:content_not_downloaded").alias("technical_consistency"), F.lit("true").alias("requires_manual_review"), F.lit("GEO_supplementary").alias("source_type"),
        F.col("url").alias("source_url"), F.col("file_name").alias("source_id"), F.lit("remote_candidate").alias("status"), F.concat(F.lit("name hints: "), F.concat_ws(",", hints)).alias("message"))
    return classify(local, content).unionByName(_fields(runs)).unionByName(_fields(remote))


def inventory(classified: DataFrame, verified: DataFrame, content: DataFrame) -> DataFrame:
    """Classified rows, verified downloads classified again, and failed downloads."""
    fine = verified.where((F.col("status") == "verified") & ~is_missing("file_path"))
    again = classify(fine.select("dataset_id", "sample_id", "data_type_confirmed", "file_path", "source_type", "source_url", "source_id", "paired_end_status"), content).withColumn("status", F.lit("verified"))
    failed = verified.where(F.col("status") == "error").withColumns({
        "entry_point": F.lit("download_error"), "file_format": F.lit("unknown"), "recommended_pipeline": F.lit("manual_download_repair_required"),
        "technical_consistency": F.lit("error:download_verification_failed"), "requires_manual_review": F.lit("true")})
    return classified.unionByName(again).unionByName(_fields(failed))


def reviewed_inventory(samples: DataFrame, path: str) -> DataFrame:
    """Inventory of the small all-in-one run, with a 12-character provenance id."""
    key = F.concat_ws(":", "dataset_id", "sample_id", F.lit(path))
    return samples.select("dataset_id", "sample_id", F.col("data_type").alias("data_type_confirmed"), F.lit("reviewed_manifest").alias("entry_point"), F.lit(path).alias("file_path"),
                          F.lit("raw_integer_counts").alias("count_type"), F.lit("true").alias("is_integer"), F.lit("false").alias("likely_normalized"), F.lit("pass").alias("technical_consistency"),
                          F.lit("false").alias("requires_manual_review"), F.substring(F.sha1(key), 1, 12).alias("provenance_id"))


def pick_adapter(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """First enabled adapter by priority whose input kind matches."""
    on = registry.where(F.lower(F.col("enabled").cast("string")) == "true")
    best = on.groupBy("input_kind").agg(F.min_by("adapter", F.struct("priority", "adapter")).alias("adapter"))
    return rows.join(best, "input_kind", "left").withColumn("adapter", or_na("adapter"))
