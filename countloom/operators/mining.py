"""Metadata mining: everything found is a suggestion, formal columns stay blank."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import col, is_missing, or_na, present
from countloom.functions.text import distinct_matches, match_terms, url_file_name
from countloom.operators.rules.issues import listed as listed_items
from countloom.schemas import TABLES

# Formal columns a suggestion never fills.
FORMAL = ("sample_id", "subject_id", "include", "group", "condition", "tissue", "batch", "sex", "age", "timepoint", "treatment", "paired_group",
          "data_type", "matrix_path", "fastq_r1", "fastq_r2", "notes", "reviewer_note", "review_status")


def json_strings(raw: str | Column) -> Column:
    """Strings of a JSON value: a map or list of strings or lists, or a list of {field_name, values}.

    Text that is not JSON is one string.
    """
    text = col(raw)
    listed = F.from_json(text, "array<struct<field_name:string,values:string>>")
    inner = lambda v: F.coalesce(F.from_json(v, "array<string>"), F.array(v))
    from_fields = F.flatten(F.transform(F.filter(listed, lambda s: s["field_name"].isNotNull()), lambda s: inner(s["values"])))
    from_map = F.flatten(F.transform(F.map_values(F.from_json(text, "map<string,string>")), inner))
    from_list = F.flatten(F.transform(F.from_json(text, "array<string>"), inner))
    found = (
        F.when(is_missing(text), F.array().cast("array<string>"))
        .when(F.exists(F.coalesce(listed, F.array().cast(_FIELDS)), lambda s: s["field_name"].isNotNull()), from_fields)
        .when(text.rlike(r"^\s*\{"), F.coalesce(from_map, F.array(text)))
        .when(text.rlike(r"^\s*\["), F.coalesce(from_list, F.array(text)))
        .otherwise(F.array(text))
    )
    return F.filter(found, lambda s: s.isNotNull() & (s != "") & (s != "NA"))


_FIELDS = "array<struct<field_name:string,values:string>>"


def characteristics(raw: str | Column) -> Column:
    """Array of {key, value, raw}; the key ends at the first colon."""
    def split(s: Column) -> Column:
        has = F.contains(s, F.lit(":"))
        return F.struct(
            F.when(has, F.trim(F.substring_index(s, ":", 1))).otherwise(F.lit("")).alias("key"),
            F.when(has, F.trim(F.regexp_replace(s, r"^[^:]*:", ""))).otherwise(F.trim(s)).alias("value"),
            s.alias("raw"),
        )

    return F.transform(json_strings(raw), split)


def keyed_value(found: Column, keys: Sequence[str]) -> tuple[Column, Column, Column]:
    """(value, evidence, confidence) of the characteristics whose key holds one of the words."""
    pattern = "|".join(F_escape(k.lower()) for k in keys)
    hits = F.filter(found, lambda c: F.lower(c["key"]).rlike(pattern) & (c["value"] != ""))
    values = F.array_distinct(F.transform(hits, lambda c: c["value"]))
    value = F.when(F.size(values) == 1, values[0]).when(F.size(values) > 1, F.lit("conflict")).otherwise(F.lit("NA"))
    evidence = F.when(F.size(values) > 0, F.transform(hits, lambda c: c["raw"])).otherwise(F.array(F.lit("no characteristic with such a key")))
    return value, evidence, F.when(F.size(values) == 1, F.lit("high")).otherwise(F.lit("low"))


def F_escape(text: str) -> str:
    import re

    return re.escape(text)


def suggest_manifest(samples: DataFrame, runs: DataFrame, files: DataFrame | None, rules: Mapping[str, Sequence[str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(suggested rows, conflicts, unmapped); every run of a sample keeps its own row."""
    known = samples.select("gsm_accession").where(present("gsm_accession")).distinct()
    usable = runs.join(known, "gsm_accession", "left_semi")
    lost = runs.join(known, "gsm_accession", "left_anti").select(
        *_ids(or_na("gse_accession"), or_na("gsm_accession"), or_na("srx_accession"), or_na("srr_accession")), F.lit("SRA_RUN_WITHOUT_GEO_SAMPLE").alias("reason"),
        F.lit("Review how this run relates to a sample.").alias("suggested_action"))
    attributes = ("srx_accession", "srr_accession", "library_strategy", "library_source", "library_layout")
    # Texts are read once per sample, before its runs multiply the rows.
    found = characteristics("characteristics_ch1_raw")
    parts = F.filter(F.concat(F.array("title", "source_name"), F.transform(found, lambda c: c["raw"])), lambda s: ~is_missing(s))
    read = samples.withColumns({"_found": found, "_text": F.concat_ws(" | ", parts)})
    terms = {n: match_terms("_text", rules[k]) for n, k in (("_case", "case_candidate_terms"), ("_control", "control_candidate_terms"), ("_technical", "technical_replicate_terms"), ("_cell", "scrna_terms"), ("_nucleus", "snrna_terms"))}
    read = read.withColumns(terms).drop("_text")
    joined = read.join(usable.select("gsm_accession", *attributes), "gsm_accession", "left").withColumns({a: or_na(a) for a in attributes})
    real = usable.where(present("srr_accession"))
    per = real.groupBy("gsm_accession").agg(F.count(F.lit(1)).alias("_runs"))
    rows = joined.join(per, "gsm_accession", "left").na.fill(0, ["_runs"])
    bare = rows.where(F.col("_runs") == 0).dropDuplicates(["gsm_accession"]).select(
        *_ids(F.col("gse_accession"), F.col("gsm_accession"), F.col("srx_accession"), F.lit("NA")), F.lit("GEO_SAMPLE_WITHOUT_MAPPED_SRR").alias("reason"),
        F.lit("Confirm whether the sample has runs at all.").alias("suggested_action"))
    some = lambda c: F.size(c) > 0
    group = F.when(some("_case") & some("_control"), F.lit("conflict")).when(some("_case"), F.lit("case_candidate")).when(some("_control"), F.lit("control_candidate")).otherwise(F.lit("NA"))
    kind = (
        F.when(some("_cell") & some("_nucleus"), F.lit("conflict")).when(some("_nucleus"), F.lit("snRNA-seq_candidate")).when(some("_cell"), F.lit("scRNA-seq_candidate"))
        .when(F.lower("library_strategy").contains("rna-seq"), F.lit("bulk_RNA-seq_candidate")).otherwise(F.lit("NA"))
    )
    keyed = {n: keyed_value(F.col("_found"), rules[f"{n}_keys"]) for n in ("condition", "tissue", "batch")}
    from_source = (keyed["tissue"][0] == "NA") & present("source_name")
    tissue = (F.when(from_source, F.col("source_name")).otherwise(keyed["tissue"][0]),
              F.when(from_source, F.array(F.concat(F.lit("source_name="), "source_name"))).otherwise(keyed["tissue"][1]),
              F.when(from_source, F.lit("low")).otherwise(keyed["tissue"][2]))
    sample = F.when(F.col("srr_accession") != "NA", F.concat_ws("__", "gsm_accession", "srr_accession")).otherwise(F.col("gsm_accession"))
    level = lambda c, sure: F.when(F.col(c).isin(*sure), F.lit("medium")).otherwise(F.lit("low"))
    rows = rows.withColumns({
        "suggested_sample_id": sample, "suggested_subject_id": F.lit("NA"), "suggested_group": group, "suggested_condition": keyed["condition"][0], "suggested_tissue": tissue[0],
        "suggested_batch": keyed["batch"][0], "suggested_data_type": kind, "suggested_include": F.lit("undetermined"), "_e_condition": keyed["condition"][1], "_e_tissue": tissue[1], "_e_batch": keyed["batch"][1],
        "_l_condition": keyed["condition"][2], "_l_tissue": tissue[2], "_l_batch": keyed["batch"][2],
    })
    entry = lambda value, evidence, sure: F.struct(evidence.alias("evidence"), sure.alias("confidence"), col(value).alias("value"))
    says = lambda text: F.array(F.lit(text))
    evidence = F.to_json(F.struct(
        entry("suggested_batch", F.col("_e_batch"), F.col("_l_batch")).alias("suggested_batch"),
        entry("suggested_condition", F.col("_e_condition"), F.col("_l_condition")).alias("suggested_condition"),
        entry("suggested_data_type", F.concat("_cell", "_nucleus"), level("suggested_data_type", ("snRNA-seq_candidate", "scRNA-seq_candidate"))).alias("suggested_data_type"),
        entry("suggested_group", F.concat("_case", "_control"), level("suggested_group", ("case_candidate", "control_candidate"))).alias("suggested_group"),
        entry("suggested_include", says("inclusion is a reviewer's decision"), F.lit("low")).alias("suggested_include"),
        entry("suggested_sample_id", says("built from the two accessions"), F.lit("high")).alias("suggested_sample_id"),
        entry("suggested_subject_id", says("subjects are never inferred"), F.lit("low")).alias("suggested_subject_id"),
        entry("suggested_tissue", F.col("_e_tissue"), F.col("_l_tissue")).alias("suggested_tissue"),
    ))
    manifest = rows
    if files is not None:
        listed = files.groupBy(F.when(is_missing("gsm_accession"), F.col("gse_accession")).otherwise(F.col("gsm_accession")).alias("_owner")).agg(
            F.array_sort(F.collect_list(F.struct("supplementary_file_name", "supplementary_url", "file_type"))).alias("_files"))
        by_series = listed.withColumnsRenamed({"_owner": "gse_accession", "_files": "_f1"})
        by_sample = listed.withColumnsRenamed({"_owner": "gsm_accession", "_files": "_f2"})
        manifest = manifest.join(by_series, "gse_accession", "left").join(by_sample, "gsm_accession", "left")
        both = F.concat(F.coalesce("_f1", F.array().cast(listed.schema["_files"].dataType)), F.coalesce("_f2", F.array().cast(listed.schema["_files"].dataType)))
        manifest = manifest.withColumn("supplementary_files", F.when(F.size(both) > 0, F.to_json(both)).otherwise(F.lit("NA")))
    else:
        manifest = manifest.withColumn("supplementary_files", F.lit("NA"))
    manifest = manifest.select(
        *_ids(F.col("gse_accession"), F.col("gsm_accession"), F.col("srx_accession"), F.col("srr_accession")),
        F.col("title").alias("geo_title"), F.col("source_name").alias("geo_source_name"), F.col("characteristics_ch1_raw").alias("geo_characteristics_raw"),
        (or_na("platform") if "platform" in samples.columns else F.lit("NA")).alias("platform"), "library_strategy", "library_source", "library_layout", "supplementary_files",
        *[c for c in rows.columns if c.startswith("suggested_")], evidence.alias("suggestion_evidence"), F.lit("low").alias("suggestion_confidence"), F.lit("true").alias("requires_manual_review"),
        *[F.lit("pending" if f == "review_status" else "").alias(f) for f in FORMAL],
    )
    nothing = F.array(F.lit("NA"))
    missing_layout = is_missing("library_layout")
    found_conflicts = F.array_compact(F.array(
        F.when(some("_case") & some("_control"), _conflict("CONFLICTING_GROUP_TERMS", "critical", F.concat("_case", "_control"))),
        F.when(~some("_case") & ~some("_control"), _conflict("MISSING_GROUP_EVIDENCE", "warning", nothing)),
        F.when(some("_technical"), _conflict("TECHNICAL_REPLICATE_DESCRIPTION", "warning", F.col("_technical"))),
        F.when(missing_layout, _conflict("MISSING_LIBRARY_LAYOUT", "warning", nothing)),
        F.when(F.col("suggested_condition") == "conflict", _conflict("CONFLICTING_CONDITION_VALUES", "warning", says("conflict"))),
        F.when(F.col("suggested_data_type") == "conflict", _conflict("CONFLICTING_DATA_TYPE_TERMS", "critical", F.concat("_cell", "_nucleus"))),
    ))
    ids = _ids(F.col("gse_accession"), F.col("gsm_accession"), F.col("srx_accession"), F.col("srr_accession"))
    # One row per sample; a sample with thousands of runs gets several, each with part of the list.
    several = listed_items(real, ["gsm_accession"], "srr_accession").where(F.col("n_items") > 1)
    first = rows.where(F.col("_runs") > 1).groupBy("gsm_accession").agg(F.min("gse_accession").alias("gse_accession"), F.min("srx_accession").alias("srx_accession"))
    many = several.join(first, "gsm_accession").select(
        *_ids(F.col("gse_accession"), F.col("gsm_accession"), F.col("srx_accession"), F.col("items")[0]), _conflict("MULTIPLE_SRR_FOR_GSM", "warning", F.col("items")).alias("_c"))
    conflicts = rows.select(*ids, F.explode(found_conflicts).alias("_c")).unionByName(many).select(
        "dataset_id", "gse_id", "gsm_id", "srx_id", "srr_id", "_c.conflict_type", "_c.severity", "_c.observed_values", F.lit("Decide by hand.").alias("suggested_action"))
    return manifest, conflicts, lost.unionByName(bare)


def _ids(gse: Column, gsm: Column, srx: Column, srr: Column) -> list[Column]:
    return [gse.alias("dataset_id"), gse.alias("gse_id"), gsm.alias("gsm_id"), srx.alias("srx_id"), srr.alias("srr_id")]


def _conflict(kind: str, severity: str, values: Column) -> Column:
    return F.struct(F.lit(kind).alias("conflict_type"), F.lit(severity).alias("severity"), F.to_json(values).alias("observed_values"))


def supplementary_index(rows: DataFrame, scope: str) -> DataFrame:
    """Every ``supplementary_file*`` value of the raw metadata JSON, with name and type."""
    text = F.col("raw_metadata_json")
    as_map = F.map_entries(F.from_json(text, "map<string,string>"))
    as_list = F.transform(F.from_json(text, _FIELDS), lambda s: F.struct(s["field_name"].alias("key"), s["values"].alias("value")))
    pairs = F.when(text.rlike(r"^\s*\["), as_list).otherwise(as_map)
    keyed = rows.select("gse_accession", "gsm_accession", F.explode(pairs).alias("_p")).where(F.lower("_p.key").startswith("supplementary_file"))
    urls = F.coalesce(F.from_json("_p.value", "array<string>"), F.array("_p.value"))
    each = keyed.select("gse_accession", "gsm_accession", F.col("_p.key").alias("raw_metadata_key"), F.explode(urls).alias("supplementary_url")).where(~is_missing("supplementary_url"))
    name = url_file_name("supplementary_url")
    return each.select(
        "gse_accession", (F.col("gsm_accession") if scope == "GSM" else F.lit("NA")).alias("gsm_accession"), F.lit(scope).alias("source_scope"), "raw_metadata_key",
        or_na(name).alias("supplementary_file_name"), "supplementary_url", F.lit("NA").alias("size_bytes"),
        F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"^[^.]*\.", "")).otherwise(F.lit("NA")).alias("file_type"),
    )


def run_accessions(samples: DataFrame) -> DataFrame:
    """Experiment accessions found in either relation field, one row each; samples without one are kept."""
    both = F.concat_ws(" ", "srx_accessions", "relation_raw")
    return samples.withColumn("srx_accession", F.explode_outer(distinct_matches(both, r"SRX\d+"))).withColumn("srx_accession", or_na("srx_accession"))


def run_rows(samples: DataFrame, runinfo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(run rows, event rows): the run table joined to every experiment accession."""
    wanted = run_accessions(samples)
    names = {"Run": "srr_accession", "LibraryStrategy": "library_strategy", "LibrarySource": "library_source", "LibraryLayout": "library_layout", "ScientificName": "_species"}
    info = runinfo.select(F.col("Experiment").alias("srx_accession"), *[F.col(a).alias(b) for a, b in names.items()], F.to_json(F.struct(*sorted(runinfo.columns))).alias("raw_runinfo_json"))
    joined = wanted.join(info, "srx_accession", "left")
    rows = joined.select(
        "gse_accession", "gsm_accession", "srx_accession", *[or_na(c).alias(c) for c in ("srr_accession", "library_strategy", "library_source", "library_layout")],
        or_na(F.coalesce("_species", "organism")).alias("organism"), or_na("raw_runinfo_json").alias("raw_runinfo_json"))
    none = F.col("srx_accession") == "NA"
    per = joined.groupBy("gsm_accession", "srx_accession").agg(F.count("srr_accession").alias("runs"))
    events = per.select(
        F.when(none, F.lit("WARNING")).when(F.col("runs") == 0, F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
        F.when(none, F.lit("NO_SRX_RELATION")).when(F.col("runs") == 0, F.lit("SRA_RUNINFO_FETCH_FAILED")).otherwise(F.lit("SRA_RUNINFO_FETCH_COMPLETE")).alias("event_code"),
        F.when(none, F.col("gsm_accession")).otherwise(F.col("srx_accession")).alias("accession"), "runs")
    return rows, events


def suggest_plan(manifest: DataFrame, analysis_id: str) -> DataFrame:
    """One suggested row per dataset; the reviewer fills the formal columns."""
    dataset = F.when(present("dataset_id"), F.col("dataset_id")).otherwise(F.col("gse_id"))
    one = manifest.select(dataset.alias("dataset_id"), "gse_id").where(present("dataset_id")).groupBy("dataset_id").agg(F.min("gse_id").alias("gse_id"))
    formal = [c for c in TABLES["dataset_plan"].columns if c != "dataset_id"]
    return one.select(
        "dataset_id", F.when(present("gse_id"), F.col("gse_id")).otherwise(F.col("dataset_id")).alias("gse_id"), F.lit(analysis_id).alias("suggested_analysis_id"),
        F.lit("undetermined").alias("suggested_include"), F.lit("discovery_candidate").alias("suggested_role"), F.lit("unassigned").alias("suggested_merge_group"),
        F.lit("per_dataset_candidate").alias("suggested_analysis_strategy"), F.lit("low").alias("suggestion_confidence"), F.lit("true").alias("requires_manual_review"), *[F.lit("").alias(c) for c in formal],
    )


# File-name hint, suggested type, entry point, confidence, pipeline.
NAME_HINTS = (
    ("ten_x", "single_cell_candidate", "scrna_10x_mtx", "medium", "download_then_10x_content_validation"),
    ("h5ad", "single_cell_candidate", "scrna_h5ad", "low", "download_then_h5ad_counts_layer_review"),
    ("rds", "single_cell_candidate", "scrna_rds", "low", "download_then_rds_conversion_review"),
    ("h5", "single_cell_candidate", "scrna_10x_h5", "low", "download_then_10x_h5_content_validation"),
    ("fastq", "sequencing_candidate", "bulk_fastq", "low", "manual_modality_review_before_fastq_pipeline"),
    ("tpm", "bulk_expression_candidate", "bulk_tpm", "low", "exploratory_only_no_deseq2"),
    ("fpkm", "bulk_expression_candidate", "bulk_fpkm", "low", "exploratory_only_no_deseq2"),
    ("log", "bulk_expression_candidate", "bulk_log_expression", "low", "exploratory_only_no_deseq2"),
    ("count", "bulk_counts_candidate", "bulk_raw_counts", "low", "download_then_raw_integer_count_validation"),
)


def suggest_entry(samples: DataFrame, runs: DataFrame, files: DataFrame) -> DataFrame:
    """How each dataset's data might come in: from run rows, from file names, or unclear.

    Name tests are aggregated per dataset as flags, so no list of names is built.
    """
    fields = ("data_type_suggested", "entry_point_suggested", "confidence", "recommended_pipeline")
    fastq = runs.where(present("srr_accession") & F.lower("library_strategy").contains("rna-seq")).select(
        or_na("gse_accession").alias("dataset_id"), "srr_accession", *[F.lit(x).alias(f) for f, x in zip(fields, ("bulk_RNA-seq_candidate", "bulk_fastq", "medium", "sra_prefetch_then_fasterq"))]).distinct()
    name = F.lower(F.concat_ws(" ", "supplementary_file_name", "supplementary_url", "file_type"))
    has = lambda *words: F.bool_or(name.rlike("|".join(F_escape(w) for w in words)))
    flags = files.groupBy(or_na("gse_accession").alias("dataset_id")).agg(
        ((has("matrix.mtx") & has("barcodes.tsv") & has("features.tsv", "genes.tsv")) | has("filtered_feature_bc_matrix")).alias("ten_x"), has(".h5ad").alias("h5ad"), has(".rds", ".rdata").alias("rds"),
        (has(".h5") & ~has(".h5ad")).alias("h5"), has("fastq", ".fq").alias("fastq"), has("tpm").alias("tpm"), has("fpkm").alias("fpkm"), has("log").alias("log"), (has("count") & ~has("tpm") & ~has("fpkm")).alias("count"))
    hints = F.array_compact(F.array(*[F.when(F.col(h), F.struct(*[F.lit(x).alias(f) for f, x in zip(fields, rest)])) for h, *rest in NAME_HINTS]))
    named = flags.select("dataset_id", F.explode(hints).alias("_h")).select("dataset_id", F.lit("NA").alias("srr_accession"), "_h.*")
    found = fastq.unionByName(named)
    every = samples.select("gse_accession").union(runs.select("gse_accession")).union(files.select("gse_accession")).distinct().where(present("gse_accession")).select(F.col("gse_accession").alias("dataset_id"))
    unclear = every.join(found.select("dataset_id").distinct(), "dataset_id", "left_anti").select(
        "dataset_id", F.lit("NA").alias("srr_accession"), *[F.lit(x).alias(f) for f, x in zip(fields, ("unknown", "ambiguous", "low", "manual_entry_selection_required"))])
    return found.unionByName(unclear).withColumn("requires_manual_review", F.lit("true"))
