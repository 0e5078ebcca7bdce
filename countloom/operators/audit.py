"""Audit, exclusion, warning and provenance tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, or_na, present

# Words a result text must not use unqualified, and sequence file endings.
BANNED_WORDS = (" causal ", " driver ", " mechanism ")
RAW_ENDINGS = (".fastq", ".fq", ".fastq.gz", ".fq.gz", ".sra", ".bam", ".cram")
MODULES = ("per_dataset", "merged_analysis", "meta_analysis", "consensus", "integration", "compatibility", "reports")
ROW_KEYS = ("sample_id", "contrast_id", "analysis_id", "dataset_id", "author_label")


def _row_id(df: DataFrame):
    known = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(c).cast("string")) for c in ROW_KEYS if c in df.columns]
    return F.coalesce(*known, F.lit("NA")) if known else F.lit("NA")


def _first(df: DataFrame, *names: str):
    return next((F.col(n).cast("string") for n in names if n in df.columns), F.lit("NA"))


def audit_trail(tables: Mapping[str, DataFrame], version: str) -> DataFrame:
    """One row per (record, field): raw, suggested and final value side by side."""
    out = None
    for source, df in tables.items():
        fields = [c for c in df.columns if not c.endswith(("_raw", "_suggested"))]
        side = lambda f, end, d=df: F.col(f"{f}{end}").cast("string") if f"{f}{end}" in d.columns else F.lit("NA")
        cells = F.array(*[F.struct(F.lit(f).alias("field"), side(f, "_raw").alias("original_value"), side(f, "_suggested").alias("suggested_value"), or_na(f).alias("final_user_value")) for f in fields])
        part = df.select(
            _row_id(df).alias("record_id"), _first(df, "review_status", "status").alias("review_status"), _first(df, "reviewer_note", "notes").alias("reviewer_note"),
            _first(df, "modified_at", "modification_timestamp").alias("modification_timestamp"), F.explode(cells).alias("_c"),
        ).select("_c.*", "record_id", "review_status", "reviewer_note", "modification_timestamp", F.lit(source).alias("source_file"), F.lit(version).alias("pipeline_version"))
        out = part if out is None else out.unionByName(part)
    return out


def exclusions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Reviewed rows with include=false and the reason given."""
    out = None
    for source, df in tables.items():
        if "include" not in df.columns:
            continue
        reason = _first(df, "exclusion_reason", "notes") if {"exclusion_reason", "notes"} & set(df.columns) else F.lit("include=false")
        part = df.where(F.col("include") == "false").select(F.lit("authority").alias("scope"), _row_id(df).alias("record_id"), reason.alias("reason"), F.lit(source).alias("source_file"), _first(df, "review_status", "status").alias("review_status"))
        out = part if out is None else out.unionByName(part)
    return out


def warnings(issues: DataFrame, source: str) -> DataFrame:
    """Everything a reader must see: any severity above info, or a failure."""
    loud = issues.where(F.col("severity").isin("warning", "error", "critical") | (F.col("status") == "fail"))
    return loud.select("severity", "scope", "check_id", "analysis_id", "dataset_id", "message", F.lit(source).alias("source_file"))


def guard_wording(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Marks text that claims a cause."""
    pattern = "|".join(BANNED_WORDS)
    note = " [requires explicit cause-and-effect evidence]"
    return df.withColumns({n: F.when(F.concat(F.lit(" "), F.lower(n), F.lit(" ")).rlike(pattern), F.concat(F.col(n), F.lit(note))).otherwise(F.col(n)) for n in names})


def is_raw_sequence(path: str):
    text = F.lower(path)
    out = F.lit(False)
    for ending in RAW_ENDINGS:
        out = out | text.endswith(ending)
    return out


def module_of(path: str):
    label = F.lit("other")
    for name in reversed(MODULES):
        label = F.when(F.col(path).rlike(f"(^|/){name}(/|$)"), F.lit(name)).otherwise(label)
    return label


def package_manifest(files: DataFrame, outputs: Sequence[str] = ()) -> DataFrame:
    """Which files a package would hold, with the reason; nothing is packed."""
    reason = F.when(is_raw_sequence("path"), F.lit("excluded_large_raw_sequence_file")).when(F.col("path").isin(*outputs) if outputs else F.lit(False), F.lit("excluded_package_output")).otherwise(F.lit("included"))
    kept = reason == "included"
    return files.select("path", bool_text(kept).alias("included"), reason.alias("reason"), "size_bytes", F.when(kept, F.col("sha256")).otherwise(F.lit("NA")).alias("sha256"))


def reproducibility_manifest(files: DataFrame, wanted: Sequence[str]) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.where(F.col("path").isin(*wanted)).select(name.alias("artifact"), "path", "sha256", F.lit("final reporting artifact").alias("description"))


def reference_table(references: DataFrame, files: DataFrame) -> DataFrame:
    """Configured reference fields beside the checksum of the file they name."""
    found = files.select(F.col("path").alias("value"), "sha256", "size_bytes")
    return references.join(found, "value", "left").select("field", "value", or_na("sha256").alias("sha256"), F.col("sha256").isNotNull().alias("exists"))


def result_provenance(results: DataFrame, inputs: DataFrame, samples: DataFrame, **labels: str) -> DataFrame:
    """Every result beside the list of inputs, their checksums and the manifest size."""
    one = inputs.agg(F.concat_ws(";", F.array_sort(F.collect_list("path"))).alias("input_files"), F.concat_ws(";", F.array_sort(F.collect_list(F.concat_ws(":", "path", "sha256")))).alias("input_checksums"))  # the few inputs of one run
    rows = samples.agg(F.count(F.lit(1)).alias("manifest_rows"))
    return results.crossJoin(F.broadcast(one)).crossJoin(F.broadcast(rows)).select(  # single rows
        F.col("path").alias("result_file"), F.col("sha256"), "input_files", "input_checksums", "manifest_rows", *[F.lit(v).alias(k) for k, v in labels.items()])


def manifest_trace(samples: DataFrame) -> DataFrame:
    return samples.select(*[or_na(c).alias(c) for c in ("sample_id", "dataset_id", "include", "review_status")])


def summary_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def bulk_provenance(samples: DataFrame, branches: DataFrame, references: Mapping[str, str], method: str) -> DataFrame:
    """One JSON payload per dataset: branch, samples in order, reference."""
    ordered = samples.groupBy("dataset_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "sample_id"))), lambda s: s["sample_id"]).alias("sample_ids"), F.count(F.lit(1)).alias("sample_count"))
    joined = ordered.join(branches, "dataset_id")
    used = F.when(F.col("entry_branch") == "fastq", F.lit(method)).otherwise(F.lit("provided_matrix"))
    ref = F.struct(*[F.lit(v).alias(k) for k, v in sorted(references.items())]) if references else F.lit(None).cast("string")
    return joined.select("dataset_id", F.to_json(F.struct("dataset_id", "entry_branch", used.alias("quantification_method"), ref.alias("reference"), "sample_count", F.col("sample_ids").alias("sample_ids_in_analysis_order"))).alias("payload"))


def snapshot_hashes(files: DataFrame, names: Sequence[str]) -> DataFrame:
    return files.where(F.regexp_extract("path", r"([^/]*)$", 1).isin(*names) & present("sha256")).select("path", "sha256")
