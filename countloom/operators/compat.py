"""Can datasets be analysed together?  Technical profile, reasons, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, is_missing, is_true, or_na, present
from countloom.functions.text import is_bulk, joined_or, kept
from countloom.operators.joins import expand_contrasts
from countloom.operators.rules.design import confounded, dominant_dataset, shared_identities
from countloom.operators.rules.manifest import active, entry_branch

# Fields that must agree across datasets, and reasons that only stop a joint model.
SHARED_FIELDS = ("species", "tissue", "data_type", "reference_genome", "annotation_version", "gene_id_type")
JOINT_ONLY = ("count_sources_not_approved_for_joint_model", "dataset_group_complete_confounding", "validation_dataset_excluded_from_joint_model")
UNKNOWN = ("unknown", "na", "n/a", "")


def known(value: Column) -> Column:
    return ~is_missing(value) & ~F.lower(F.trim(value)).isin(*UNKNOWN)


def single_value(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Sorted distinct known values: none is unknown, one is the value, more are joined and need review."""
    text = F.col(name).cast("string")
    one = df.groupBy(*keys).agg(F.array_sort(F.collect_set(F.when(known(text), text))).alias("_v"))
    return one.select(*keys, joined_or(F.col("_v"), "unknown").alias(name), (F.size("_v") != 1).alias(f"{name}_review"))


def technical_profile(
    samples: DataFrame, facts: Mapping[str, Mapping[str, str]] | None = None, references: Mapping[str, str] | None = None,
    geo: DataFrame | None = None, sra: DataFrame | None = None, matrix_ok: DataFrame | None = None, method: str = "salmon_tximport", allow_author_counts: bool = False,
) -> DataFrame:
    """One row per dataset of active bulk samples.

    ``facts`` and ``references`` come from the configuration, ``geo`` and ``sra``
    from raw metadata, ``matrix_ok`` (dataset_id, ok) from the matrix rules.
    """
    facts, references = facts or {}, references or {}
    spark = samples.sparkSession
    rows = active(samples).where(is_bulk("data_type"))
    fields = ("species", "platform", "library_strategy", "reference_genome", "annotation_version", "gene_id_type", "quantification_source", "allow_author_counts_joint_model")
    alias = {"annotation_version": "annotation_release", "gene_id_type": "gene_id_space", "quantification_source": "count_generation_method"}
    listed = [(d, *[str(f.get(k) or f.get(alias.get(k, k)) or "") or None for k in fields]) for d, f in facts.items()]
    config = spark.createDataFrame(listed, "dataset_id string, " + ", ".join(f"c_{k} string" for k in fields))  # a few reviewed rows
    if geo is not None:
        about = geo.where(present("gsm_accession")).groupBy(F.col("gsm_accession").alias("gsm_id")).agg(F.max("organism").alias("organism"), F.max("platform").alias("platform"))
        rows = rows.join(about, "gsm_id", "left")
    else:
        rows = rows.withColumns({"organism": F.lit(None).cast("string"), "platform": F.lit(None).cast("string")})
    if sra is not None:
        runs = sra.where(present("srr_accession")).groupBy(F.col("srr_accession").alias("srr_id")).agg(F.max("library_strategy").alias("library_strategy"))
        rows = rows.join(runs, "srr_id", "left")
    else:
        rows = rows.withColumn("library_strategy", F.lit(None).cast("string"))
    rows = rows.join(F.broadcast(config), "dataset_id", "left")
    # Every source of a field is one more value of it.
    values = F.array(
        *[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value")) for n, c in (
            ("tissue", F.col("tissue")), ("data_type", F.col("data_type")), ("library_layout", F.col("library_layout")),
            ("species", F.col("organism")), ("species", F.col("c_species")), ("species", F.lit(references.get("species"))),
            ("platform", F.col("platform")), ("platform", F.col("c_platform")), ("library_strategy", F.col("library_strategy")), ("library_strategy", F.col("c_library_strategy")))]
    )
    long = rows.select("dataset_id", F.explode(values).alias("_v")).select("dataset_id", "_v.field", "_v.value").groupBy("dataset_id", "field", "value").agg(F.lit(1).alias("_one"))
    named = ("species", "tissue", "data_type", "platform", "library_strategy", "library_layout")
    per = long.groupBy("dataset_id").agg(*[F.array_sort(F.collect_set(F.when((F.col("field") == n) & known(F.col("value")), F.col("value")))).alias(f"_{n}") for n in named])
    branch = entry_branch(rows)
    paths = rows.groupBy("dataset_id").agg(F.count_distinct(F.when(present("matrix_path"), F.col("matrix_path"))).alias("_paths"))
    ok = matrix_ok if matrix_ok is not None else rows.select("dataset_id").distinct().withColumn("ok", F.lit(True))
    joined = per.join(branch, "dataset_id").join(paths, "dataset_id").join(ok.select("dataset_id", "ok"), "dataset_id", "left").join(F.broadcast(config), "dataset_id", "left")
    matrix, reads = F.col("entry_branch") == "matrix", F.col("entry_branch") == "fastq"
    raw = reads | (matrix & (F.col("_paths") == 1) & F.col("ok").isNotNull())
    good = F.coalesce("ok", F.lit(False))
    pick = lambda name, ref: F.coalesce(F.col(f"c_{name}"), F.lit(references.get(ref)), F.lit("unknown"))
    review = None
    for n in named:
        review = (F.size(f"_{n}") != 1) if review is None else review | (F.size(f"_{n}") != 1)
    return joined.select(
        "dataset_id", *[joined_or(F.col(f"_{n}"), "unknown").alias(n) for n in named],
        pick("reference_genome", "genome_build").alias("reference_genome"), pick("annotation_version", "annotation_release").alias("annotation_version"), pick("gene_id_type", "gene_id_space").alias("gene_id_type"),
        F.when(reads, F.lit(f"uniform_fastq_{method}")).when(matrix & ~raw, F.lit("author_matrix_unverified")).when(matrix & good, F.lit("author_raw_integer_counts"))
        .when(matrix, F.lit("normalized_or_invalid_matrix")).otherwise(F.lit("mixed_or_missing")).alias("count_source"),
        F.when(reads, F.lit(method)).when(matrix, F.coalesce("c_quantification_source", F.lit("unknown"))).otherwise(F.lit("unknown")).alias("quantification_source"),
        F.coalesce(raw, F.lit(False)).alias("raw_data_available"), review.alias("profile_requires_review"),
        F.coalesce(~(reads | (matrix & raw & good)), F.lit(True)).alias("count_blocking"),
        F.coalesce(F.lower("c_allow_author_counts_joint_model") == "true", F.lit(allow_author_counts)).alias("allow_author_counts"),
    )


def compatibility(samples: DataFrame, plan: DataFrame, contrasts: DataFrame, profile: DataFrame, dominance: float = 0.8) -> DataFrame:
    """Per (analysis, dataset, contrast): own reasons, cross-dataset reasons, the two flags."""
    grid = expand_contrasts(plan, contrasts)
    rows = active(samples).where(is_bulk("data_type"))
    counts = rows.groupBy("dataset_id", "group").agg(F.count(F.lit(1)).alias("n"))
    side = lambda s: counts.select("dataset_id", F.col("group").alias(s), F.col("n").alias(f"_{s}"))
    grid = grid.join(side("numerator"), ["dataset_id", "numerator"], "left").join(side("denominator"), ["dataset_id", "denominator"], "left").na.fill(0, ["_numerator", "_denominator"])
    grid = grid.join(profile.withColumn("_has", F.lit(True)), "dataset_id", "left")
    words = {n: "unknown" for n in (*SHARED_FIELDS, "platform", "library_strategy", "library_layout", "quantification_source")}
    grid = grid.na.fill({**words, "count_source": "missing", "raw_data_available": False, "profile_requires_review": True, "count_blocking": True, "allow_author_counts": False, "_has": False})
    late = (F.col("role") == "validation") & (F.col("analysis_strategy") != "stratified_validation")
    own = kept(
        (~F.col("_has"), "no_active_reviewed_bulk_samples"), (F.col("count_blocking"), "raw_integer_counts_unavailable"), (~F.lower("data_type").contains("bulk"), "not_bulk_data"),
        ((F.col("_numerator") == 0) | (F.col("_denominator") == 0), "contrast_not_estimable_within_dataset"), (late, "validation_dataset_in_non_stratified_strategy"),
    )
    grid = grid.withColumn("_own", own)
    keys = ["analysis_id", "contrast_id"]
    clear = lambda c: ~F.lower(c).isin("unknown", "na", "")
    sources = F.lower("quantification_source")
    fields = [(F.min(F.when(clear(f), F.col(f))) != F.max(F.when(clear(f), F.col(f)))) | (F.count_if(~clear(f)) > 0) for f in SHARED_FIELDS]
    cross = grid.groupBy(*keys).agg(
        *[F.coalesce(c, F.lit(True)).alias(f"_bad_{f}") for f, c in zip(SHARED_FIELDS, fields)],
        F.bool_or(F.col("role") == "validation").alias("_validation"), (F.min("count_source") == F.max("count_source")).alias("_one_source"), F.min("count_source").alias("_source"),
        F.bool_and("allow_author_counts").alias("_allowed"), F.coalesce((F.min(F.when(~sources.isin("unknown", "na", ""), F.col("quantification_source"))) == F.max(F.when(~sources.isin("unknown", "na", ""), F.col("quantification_source")))) & (F.count_if(sources.isin("unknown", "na", "")) == 0), F.lit(False)).alias("_same_method"),
    )
    members = plan.where(is_true("include")).select("analysis_id", "dataset_id").distinct()
    in_analysis = rows.join(members, "dataset_id")
    overlap = shared_identities(in_analysis, ["analysis_id"]).select("analysis_id").distinct().withColumn("_overlap", F.lit(True))
    sides = grid.select(*keys, "numerator", "denominator").distinct()
    tied = confounded(in_analysis.join(sides, "analysis_id"), keys).withColumn("_tied", F.lit(True))
    big = dominant_dataset(in_analysis, dominance, ["analysis_id"]).select("analysis_id", F.concat_ws(":", F.lit("dataset_sample_size_dominance"), "dataset_id", F.format_string("%.6f", "fraction")).alias("_dominant"))
    strategy = plan.where(is_true("include")).groupBy("analysis_id").agg(F.max("analysis_strategy").alias("_strategy"))
    both = grid.join(cross, keys).join(overlap, "analysis_id", "left").join(tied, keys, "left").join(big, "analysis_id", "left").join(strategy, "analysis_id")
    author = F.col("_one_source") & (F.col("_source") == "author_raw_integer_counts")
    uniform = F.col("_one_source") & F.col("_source").startswith("uniform_fastq_")
    shared = kept(
        *[(F.col(f"_bad_{f}"), f"incompatible_or_unknown_{f}") for f in SHARED_FIELDS],
        (F.coalesce("_overlap", F.lit(False)), "overlapping_sample_identity"), (F.coalesce("_tied", F.lit(False)), "dataset_group_complete_confounding"),
        (F.col("_validation"), "validation_dataset_excluded_from_joint_model"), (~uniform & ~(author & F.col("_allowed") & F.col("_same_method")), "count_sources_not_approved_for_joint_model"),
        (author & ~F.col("_same_method"), "author_count_quantification_source_incompatible_or_unknown"),
    )
    both = both.withColumn("_joint", F.array_sort(F.array_union("_own", shared)))
    meta_reasons = F.array_except("_joint", F.array(*[F.lit(r) for r in JOINT_ONLY]))
    told = F.when(F.col("_dominant").isNotNull(), F.array_sort(F.array_union("_joint", F.array("_dominant")))).otherwise(F.col("_joint"))
    return both.select(
        "analysis_id", "dataset_id", "contrast_id", or_na("analysis_strategy").alias("analysis_strategy"), or_na("role").alias("role"),
        "species", "tissue", "data_type", "platform", "library_strategy", "library_layout", "reference_genome", "annotation_version", "gene_id_type", "count_source",
        F.col("_numerator").alias("case_count"), F.col("_denominator").alias("control_count"), bool_text(F.col("raw_data_available")).alias("raw_data_available"),
        bool_text((F.col("_strategy") == "joint_model") & (F.size("_joint") == 0)).alias("compatible_for_joint_model"), bool_text(F.size(meta_reasons) == 0).alias("compatible_for_meta_analysis"),
        joined_or(told, "none").alias("incompatibility_reason"), bool_text(F.col("profile_requires_review") | (F.size("_own") > 0) | F.col("_dominant").isNotNull()).alias("requires_manual_review"),
    )


def route(plan: DataFrame) -> DataFrame:
    """The one strategy of each analysis, or mixed."""
    used = plan.where(is_true("include"))
    return used.groupBy("analysis_id").agg(F.min("analysis_strategy").alias("_lo"), F.max("analysis_strategy").alias("_hi"), F.count(F.lit(1)).alias("datasets")).select(
        "analysis_id", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.lit("mixed_strategies")).alias("analysis_strategy"), "datasets"
    )


def strategy_of(plan: DataFrame, analysis_id: str) -> str:
    """The strategy of one analysis; more than one is an error."""
    row = route(plan).where(F.col("analysis_id") == analysis_id).first()
    if row is None or row["analysis_strategy"] == "mixed_strategies":
        raise ValueError(f"analysis {analysis_id} must have exactly one strategy")
    return row["analysis_strategy"]
