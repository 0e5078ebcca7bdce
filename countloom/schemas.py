"""Fixed table layouts and their value rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    columns: tuple[str, ...]
    booleans: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    required: tuple[str, ...] = ()  # neither empty nor NA
    filled: tuple[str, ...] = ()  # not empty
    words: dict[str, tuple[str, ...]] = field(default_factory=dict)
    row_rules: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# Columns in file order, and the words each column may hold.
TABLES = {
    "sample_manifest": Table(
        ("dataset_id", "gse_id", "gsm_id", "srx_id", "srr_id", "sample_id", "subject_id", "include", "group", "condition", "tissue", "batch", "sex", "age",
         "timepoint", "treatment", "paired_group", "data_type", "library_layout", "matrix_path", "fastq_r1", "fastq_r2", "notes", "reviewer_note", "review_status"),
        booleans=("include",),
        required=("dataset_id", "sample_id"),
        filled=("gse_id", "gsm_id", "data_type"),
        words={"review_status": ("pending", "confirmed", "excluded")},
        row_rules={
            "include": "(include = 'true' AND review_status <> 'confirmed') OR (review_status = 'excluded' AND include = 'true')",
            "subject_id": "lower(data_type) LIKE '%pseudobulk%' AND subject_id IN ('', 'NA')",
        },
    ),
    "contrasts": Table(
        ("contrast_id", "analysis_id", "data_scope", "numerator", "denominator", "subset_column", "subset_value", "design_formula", "paired", "min_replicates_per_group", "enabled", "notes"),
        booleans=("paired", "enabled"),
        integers=("min_replicates_per_group",),
        required=("contrast_id", "analysis_id", "numerator", "denominator", "design_formula"),
        row_rules={"min_replicates_per_group": "try_cast(min_replicates_per_group AS INT) < 1"},
        words={"data_scope": ("bulk", "scrna_pseudobulk", "bulk_meta", "scrna_meta", "cell_proportion")},
    ),
    "dataset_plan": Table(
        ("analysis_id", "dataset_id", "include", "role", "merge_group", "analysis_strategy", "reference_dataset", "notes"),
        booleans=("include",),
        required=("analysis_id", "dataset_id"),
        words={
            "role": ("discovery", "validation", "supplementary"),
            "analysis_strategy": ("joint_model", "per_dataset_meta", "stratified_validation", "independent_only", "single_cell_integration"),
        },
    ),
    "celltype_ontology": Table(
        ("dataset_id", "author_label", "harmonized_level1", "harmonized_level2", "harmonized_level3", "mapping_method", "confidence", "review_status", "notes"),
        required=("dataset_id", "author_label"),
        filled=("mapping_method",),
        words={"confidence": ("high", "medium", "low"), "review_status": ("pending", "confirmed", "excluded")},
    ),
}
