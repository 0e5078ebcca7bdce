"""Rules on contrasts, the dataset plan, the cell-type ontology and the design."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import is_missing, is_true, present, to_number
from countloom.functions.text import looks_like_barcode
from countloom.operators.designs import fit_designs, formula_terms, variables_of
from countloom.operators.rules.issues import issue, listed, passed, union, when_empty
from countloom.operators.rules.manifest import active
from countloom.session import reuse, spread

CELL_SCOPES = ("scrna_pseudobulk", "scrna_meta", "cell_proportion")
LEVELS = ("harmonized_level1", "harmonized_level2", "harmonized_level3")


def rows_for_analysis(samples: DataFrame, plan: DataFrame) -> DataFrame:
    """Active samples beside every analysis that includes their dataset."""
    used = plan.where(is_true("include")).select("analysis_id", "dataset_id").distinct()
    return active(samples).join(F.broadcast(used), "dataset_id")  # reviewed configuration


def enabled(contrasts: DataFrame, scopes: Sequence[str] | None = None) -> DataFrame:
    out = contrasts.where(is_true("enabled"))
    return out if scopes is None else out.where(F.col("data_scope").isin(*scopes))


def _values(columns: Sequence[str]) -> Column:
    return F.create_map(*[part for c in columns for part in (F.lit(c), F.col(c).cast("string"))])


def contrast_rows(samples: DataFrame, contrasts: DataFrame, plan: DataFrame) -> DataFrame:
    """Analysis samples per enabled contrast, after its optional subset."""
    rows = rows_for_analysis(samples, plan).withColumn("_values", _values(samples.columns))
    about = enabled(contrasts).select("analysis_id", "contrast_id", "numerator", "denominator", "subset_column", "subset_value", "paired", "design_formula",
                                      F.coalesce(F.col("min_replicates_per_group").try_cast("int"), F.lit(1)).alias("minimum"))
    joined = rows.join(F.broadcast(about), "analysis_id")  # reviewed configuration
    whole = is_missing("subset_column")
    return joined.where(whole | F.coalesce(F.try_element_at("_values", "subset_column") == F.col("subset_value"), F.lit(False)))


def _sides(contrasts: DataFrame) -> DataFrame:
    pair = F.array(
        F.struct(F.lit("numerator").alias("side"), F.col("numerator").alias("group")),
        F.struct(F.lit("denominator").alias("side"), F.col("denominator").alias("group")),
    )
    return contrasts.select("analysis_id", "contrast_id", F.coalesce(F.col("min_replicates_per_group").try_cast("int"), F.lit(1)).alias("minimum"), F.explode(pair).alias("_s")).select(
        "analysis_id", "contrast_id", "minimum", "_s.side", "_s.group"
    )


def validate_contrasts(samples: DataFrame, contrasts: DataFrame, plan: DataFrame) -> DataFrame:
    """Groups, subjects, replicates and pairs of every enabled contrast."""
    analyses = contrasts.select("analysis_id").distinct()
    samples = reuse(spread(samples))
    rows = rows_for_analysis(samples, plan).join(analyses, "analysis_id", "left_semi")
    ids = {"analysis_id": "analysis_id", "dataset_id": "dataset_id", "sample_id": "sample_id", "subject_id": "subject_id"}
    on = enabled(contrasts)
    paired = on.groupBy("analysis_id").agg(F.bool_and(is_true("paired")).alias("_paired"))
    held = rows.where(present("subject_id") & present("group"))
    mixed = held.groupBy("analysis_id", "subject_id").agg(F.min("group").alias("_lo"), F.max("group").alias("_hi"), F.array_sort(F.collect_set("dataset_id")).alias("_d"))
    mixed = mixed.where(F.col("_lo") != F.col("_hi")).join(paired, "analysis_id", "left").where(~F.coalesce("_paired", F.lit(False)))
    same = on.where(F.col("numerator") == F.col("denominator"))
    differ = on.where(F.col("numerator") != F.col("denominator"))
    known_column = is_missing("subset_column") | F.col("subset_column").isin(*samples.columns)
    # A contrast of identical groups is reported once and not looked at further.
    chosen = contrast_rows(samples, differ, plan)
    found = chosen.where(present("group")).groupBy("analysis_id", "contrast_id", "group").agg(
        F.count(F.lit(1)).alias("_n"), F.count_distinct(F.when(present("subject_id"), F.col("subject_id"))).alias("_subjects")
    )
    sides = _sides(differ).join(found, ["analysis_id", "contrast_id", "group"], "left").na.fill(0, ["_n", "_subjects"])
    in_pair = chosen.where(is_true("paired") & F.col("group").isin(F.col("numerator"), F.col("denominator")))
    pairs = in_pair.where(present("paired_group")).groupBy("analysis_id", "contrast_id", "paired_group").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("group") == F.col("numerator")).alias("_up"), F.count_if(F.col("group") == F.col("denominator")).alias("_down"),
        F.count_distinct(F.when(present("subject_id"), F.col("subject_id"))).alias("_subjects"),
    )
    contrast = {"analysis_id": "analysis_id", "contrast_id": "contrast_id"}
    found_issues = union([
        issue(rows.where(is_missing("group")), "error", "biological_design", "GROUP_MISSING", F.format_string("sample %s has no group", "sample_id"), "Assign a group or set include to false.", **ids),
        issue(rows.where(is_missing("subject_id")), "error", "biological_design", "SUBJECT_ID_MISSING", F.format_string("sample %s has no subject", "sample_id"),
              "Enter the reviewed subject.", **{k: v for k, v in ids.items() if k != "subject_id"}),
        issue(mixed, "error", "biological_design", "SUBJECT_GROUP_CONFLICT", F.format_string("subject %s is in several groups", "subject_id"),
              "Correct the groups or define a paired contrast.", analysis_id="analysis_id", dataset_id=F.concat_ws(";", "_d"), subject_id="subject_id"),
        issue(same, "error", "contrast", "IDENTICAL_CONTRAST_GROUPS", F.format_string("contrast %s compares a group with itself", "contrast_id"), "Enter two groups.", **contrast),
        issue(differ.where(~known_column), "error", "contrast", "SUBSET_COLUMN_MISSING", F.format_string("subset column %s does not exist", "subset_column"), "Correct the column or use NA.", **contrast),
        issue(sides.where(F.col("_n") == 0), "error", "contrast", "CONTRAST_GROUP_NOT_FOUND", F.format_string("%s group %s has no sample", "side", "group"),
              "Correct the contrast or the groups.", F.struct(F.col("side").alias("direction"), "group"), **contrast),
        issue(sides.where(F.col("_subjects") < F.col("minimum")), "error", "contrast", "INSUFFICIENT_SUBJECT_REPLICATES",
              F.format_string("group %s has %d subjects, %d are needed", "group", "_subjects", "minimum"), "Add replicates, lower the minimum or disable the contrast.",
              F.struct("group", F.col("_subjects").alias("subjects")), **contrast),
        issue(in_pair.where(is_missing("paired_group")), "error", "paired_design", "PAIRED_GROUP_MISSING", F.format_string("sample %s has no pair", "sample_id"), "Assign the pair.", **ids, contrast_id="contrast_id"),
        issue(pairs.where((F.col("_up") != 1) | (F.col("_down") != 1) | (F.col("_n") != 2)), "error", "paired_design", "INCOMPLETE_PAIR",
              F.format_string("pair %s is not one sample of each group", "paired_group"), "Give one sample per group.", F.struct(F.col("paired_group").alias("pair_id")), **contrast),
        issue(pairs.where(F.col("_subjects") > 1), "error", "paired_design", "PAIR_SUBJECT_CONFLICT", F.format_string("pair %s has several subjects", "paired_group"), "Correct subject or pair.", **contrast),
    ])
    found_issues = reuse(found_issues)
    failed = found_issues.where(F.col("contrast_id") != "NA").select("analysis_id", "contrast_id").distinct()
    good = differ.select("analysis_id", "contrast_id").distinct().join(failed, ["analysis_id", "contrast_id"], "left_anti")
    return union([
        found_issues,
        passed(good, "contrast", "CONTRAST_VALID", F.format_string("contrast %s is in order", "contrast_id"), **contrast),
        issue(when_empty(contrasts), "warning", "contrast", "NO_CONTRASTS_DEFINED", "there is no contrast", "Add contrasts before testing."),
    ])


def dataset_shares(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per family: the largest dataset, its share and how many datasets there are."""
    counts = rows.groupBy(*by, "dataset_id").agg(F.count(F.lit(1)).alias("n"))
    # Equal counts: the first name wins, so the result does not depend on row order.
    top = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("n"), "dataset_id")).alias("_top"), F.sum("n").alias("_all"), F.count(F.lit(1)).alias("datasets"))
    return top.select(*by, F.col("_top.dataset_id").alias("dataset_id"), (-F.col("_top.n") / F.col("_all")).alias("fraction"), "datasets")


def dominant_dataset(rows: DataFrame, threshold: float, by: Sequence[str]) -> DataFrame:
    return dataset_shares(rows, by).where((F.col("datasets") >= 2) & (F.col("fraction") >= threshold))


def confounded(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Families whose datasets each hold one group while each group sits in one dataset.

    ``rows`` carries numerator and denominator beside each sample.
    """
    pairs = rows.where(F.col("group").isin(F.col("numerator"), F.col("denominator"))).select(*by, "dataset_id", "group", "numerator", "denominator").distinct()
    per_dataset = pairs.groupBy(*by, "dataset_id").agg(F.count(F.lit(1)).alias("g")).groupBy(*by).agg(F.max("g").alias("g"))
    per_group = pairs.groupBy(*by, "group").agg(F.count(F.lit(1)).alias("d")).groupBy(*by).agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("groups"))
    return per_dataset.join(per_group, list(by)).where((F.col("g") == 1) & (F.col("d") == 1) & (F.col("groups") == 2)).select(*by)


def shared_identities(samples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Identifier values that occur in more than one dataset."""
    by = list(by)
    fields = [f for f in ("sample_id", "subject_id", "gsm_id", "srr_id") if f in samples.columns]
    long = samples.select(*by, "dataset_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("_i")).select(
        *by, "dataset_id", "_i.field", "_i.value"
    ).where(present("value"))
    return long.groupBy(*by, "field", "value").agg(F.min("dataset_id").alias("_lo"), F.max("dataset_id").alias("_hi"), F.approx_count_distinct("dataset_id").alias("datasets")).where(
        F.col("_lo") != F.col("_hi")
    ).select(*by, F.concat_ws(":", "field", "value").alias("identity"))


def design_crosstab(samples: DataFrame, plan: DataFrame) -> DataFrame:
    """Samples, subjects and share of the analysis per (dataset, group)."""
    rows = rows_for_analysis(samples, plan).withColumn("group", F.coalesce("group", F.lit("NA")))
    counts = rows.groupBy("analysis_id", "dataset_id", "group").agg(
        F.count(F.lit(1)).alias("sample_count"), F.count_distinct(F.when(present("subject_id"), F.col("subject_id"))).alias("subject_count")
    )
    total = counts.groupBy("analysis_id").agg(F.sum("sample_count").alias("_t"))
    return counts.join(total, "analysis_id").select("analysis_id", "dataset_id", "group", "sample_count", "subject_count", F.format_string("%.6f", F.col("sample_count") / F.col("_t")).alias("fraction_of_analysis"))


def validate_plan(samples: DataFrame, contrasts: DataFrame, plan: DataFrame, dominance: float = 0.8, compatibility: Mapping[str, Mapping[str, str]] | None = None, allow_mixed_cells: bool = False) -> DataFrame:
    """Roles, strategies, estimability, confounding and merge groups of the plan."""
    compatibility = compatibility or {}
    samples = reuse(spread(samples))
    used = plan.where(is_true("include"))
    ids = {"analysis_id": "analysis_id", "dataset_id": "dataset_id"}
    rows = rows_for_analysis(samples, plan)
    strategies = listed(used, ["analysis_id"], "analysis_strategy")
    discovery = used.where(F.col("role") == "discovery")
    discovering = discovery.select("analysis_id").distinct().withColumn("_any", F.lit(True))
    shared = discovery.where(present("merge_group")).select("analysis_id", "merge_group").distinct().withColumn("_shared", F.lit(True))
    leak = used.where(F.col("role") == "validation").join(discovering, "analysis_id").join(shared, ["analysis_id", "merge_group"], "left")
    leak = leak.where(F.col("analysis_strategy").isin("joint_model", "per_dataset_meta") | F.coalesce("_shared", F.lit(False)))
    on = enabled(contrasts)
    sides = _sides(on).join(used.where(F.col("analysis_strategy").isin("joint_model", "per_dataset_meta")).select("analysis_id", "dataset_id", "analysis_strategy"), "analysis_id")
    subjects = rows.where(present("subject_id")).groupBy("analysis_id", "dataset_id", "group").agg(F.count_distinct("subject_id").alias("_subjects"))
    weak = sides.join(subjects, ["analysis_id", "dataset_id", "group"], "left").where(F.coalesce("_subjects", F.lit(0)) < F.col("minimum"))
    weak = weak.groupBy("analysis_id", "dataset_id", "contrast_id", "analysis_strategy").agg(F.array_sort(F.collect_set("group")).alias("groups"))
    joint = F.col("analysis_strategy") == "joint_model"
    joint_sets = used.where(joint).select("analysis_id", "dataset_id").distinct()
    many = joint_sets.groupBy("analysis_id").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1).select("analysis_id")
    tied = confounded(rows.join(joint_sets, ["analysis_id", "dataset_id"], "left_semi").join(many, "analysis_id", "left_semi").join(on.select("analysis_id", "contrast_id", "numerator", "denominator"), "analysis_id"), ["analysis_id", "contrast_id"])
    integrates = F.col("analysis_strategy") == "single_cell_integration"
    merged = used.where(present("merge_group")).groupBy("analysis_id", "merge_group").agg(
        F.array_sort(F.collect_set("dataset_id")).alias("_sets"), F.bool_or(integrates).alias("_integrates")
    ).withColumn("datasets", F.concat_ws(";", "_sets"))
    large = merged.where(F.size("_sets") >= 2)
    members = large.select("analysis_id", "merge_group", "_integrates", "datasets", F.explode("_sets").alias("dataset_id"))
    types = rows.where(present("data_type")).join(members, ["analysis_id", "dataset_id"]).groupBy("analysis_id", "merge_group", "_integrates", "datasets").agg(F.array_sort(F.collect_set("data_type")).alias("_types"))
    mixed = types.where(F.size("_types") > 1)
    cells = F.forall("_types", lambda t: F.lower(t).rlike("scrna|snrna|single_cell|single-cell"))
    allowed = F.col("_integrates") & cells & F.lit(allow_mixed_cells)
    facts = {f: F.create_map(*[x for d, v in compatibility.items() for x in (F.lit(d), F.lit(v.get(f, "unknown")))]) if compatibility else None for f in ("species", "reference_genome", "gene_id_space")}
    known = F.col("dataset_id").isin(*compatibility) if compatibility else F.lit(False)
    unverified = members.where(~known).groupBy("analysis_id", "merge_group").agg(F.concat_ws(";", F.array_sort(F.collect_set("dataset_id"))).alias("dataset_id"))
    parts = [
        issue(plan.join(samples.select("dataset_id").distinct(), "dataset_id", "left_anti"), "error", "dataset_plan", "PLANNED_DATASET_NOT_FOUND", F.format_string("dataset %s has no manifest row", "dataset_id"), "Correct the plan or the manifest.", **ids),
        issue(plan.select("analysis_id").distinct().join(used, "analysis_id", "left_anti"), "warning", "dataset_plan", "NO_INCLUDED_DATASETS", F.format_string("analysis %s includes nothing", "analysis_id"), "Include the datasets you mean.", analysis_id="analysis_id"),
        issue(strategies.where(F.col("n_items") > 1), "error", "dataset_plan", "MIXED_ANALYSIS_STRATEGIES", F.format_string("analysis %s mixes %d strategies", "analysis_id", "n_items"), "Use one strategy per analysis.", analysis_id="analysis_id"),
        issue(leak, "error", "dataset_plan", "VALIDATION_DATA_IN_DISCOVERY_MODEL", F.format_string("validation dataset %s would enter discovery", "dataset_id"), "Keep validation apart.", **ids),
        issue(dominant_dataset(rows, dominance, ["analysis_id"]), "warning", "dataset_plan", "DATASET_SAMPLE_SIZE_DOMINANCE", F.format_string("dataset %s dominates %s", "dataset_id", "analysis_id"), "Check its influence.", F.struct("fraction"), **ids),
        issue(weak, F.when(joint, F.lit("critical")).otherwise(F.lit("error")), "dataset_plan", F.when(joint, F.lit("JOINT_DATASET_MISSING_COMPARISON")).otherwise(F.lit("META_DATASET_NOT_ESTIMABLE")),
              F.format_string("dataset %s cannot estimate %s alone", "dataset_id", "contrast_id"), "Add subjects or change the plan.", F.struct("groups"), contrast_id="contrast_id", **ids),
        issue(tied, "critical", "dataset_plan", "DATASET_GROUP_COMPLETE_CONFOUNDING", F.format_string("dataset and group cannot be told apart in %s", "contrast_id"), "Do not fit a joint model.", analysis_id="analysis_id", contrast_id="contrast_id"),
        issue(merged.where(F.col("_integrates") & (F.size("_sets") < 2)), "error", "dataset_plan", "INTEGRATION_REQUIRES_MULTIPLE_DATASETS", F.format_string("merge group %s has one dataset", "merge_group"), "Add datasets or drop the integration.", analysis_id="analysis_id", dataset_id="datasets"),
        issue(mixed.where(allowed), "warning", "dataset_plan", "SCRNA_SNRNA_INTEGRATION_REQUIRES_REVIEW", F.format_string("merge group %s joins cells and nuclei", "merge_group"), "Review the comparison.", analysis_id="analysis_id", dataset_id="datasets"),
        issue(mixed.where(~allowed), "critical", "dataset_plan", "INCOMPATIBLE_DATA_TYPES_MERGED", F.format_string("merge group %s joins several data types", "merge_group"), "Separate the data types.", F.struct(F.col("_types").alias("data_types")), analysis_id="analysis_id", dataset_id="datasets"),
        issue(unverified, "error", "dataset_plan", "DATASET_COMPATIBILITY_UNVERIFIABLE", F.format_string("merge group %s lacks reference facts", "merge_group"), "Record species, genome and gene ids.", **ids),
        issue(used.where(integrates & is_missing("merge_group")), "error", "dataset_plan", "INTEGRATION_MERGE_GROUP_REQUIRED", F.format_string("dataset %s asks for integration without a merge group", "dataset_id"), "Set the merge group.", **ids),
        issue(when_empty(plan), "warning", "dataset_plan", "NO_DATASET_PLAN_ROWS", "the plan is empty", "Write the plan."),
    ]
    if compatibility:
        verified = members.join(unverified.select("analysis_id", "merge_group"), ["analysis_id", "merge_group"], "left_anti")
        for field, check, severity in (("species", "INCOMPATIBLE_SPECIES_MERGED", "critical"), ("reference_genome", "INCOMPATIBLE_REFERENCE_GENOMES", "error"), ("gene_id_space", "INCOMPATIBLE_GENE_ID_SPACES", "error")):
            seen = verified.withColumn("_v", F.try_element_at(facts[field], "dataset_id")).groupBy("analysis_id", "merge_group", "datasets").agg(F.array_sort(F.collect_set("_v")).alias("_vs"))
            parts.append(issue(seen.where((F.size("_vs") > 1) | F.array_contains("_vs", "unknown")), severity, "dataset_plan", check, F.format_string(f"merge group %s has no common {field}", "merge_group"), "Confirm the values.", F.struct(F.col("_vs").alias("values")), analysis_id="analysis_id", dataset_id="datasets"))
    found = reuse(union(parts))
    clean = used.select("analysis_id").distinct().join(found.where(F.col("status") == "fail").select("analysis_id").distinct(), "analysis_id", "left_anti")
    return found.unionByName(passed(clean, "dataset_plan", "DATASET_PLAN_VALID", F.format_string("plan of %s is in order", "analysis_id"), analysis_id="analysis_id"))


def validate_ontology(samples: DataFrame, contrasts: DataFrame, plan: DataFrame, ontology: DataFrame, metrics: DataFrame | None = None, min_cells: int = 10, min_donors: int = 2) -> DataFrame:
    """Subjects, label mappings, and enough cells and donors per cell type."""
    samples = reuse(spread(samples))
    kind = F.lower(F.coalesce("data_type", F.lit("")))
    cells = kind.contains("scrna") | kind.contains("snrna") | kind.contains("single_cell")
    included = active(samples).where(cells)
    ids = {"dataset_id": "dataset_id", "sample_id": "sample_id"}
    targets = ontology.where(F.coalesce("review_status", F.lit("")) != "excluded").select("dataset_id", "author_label", *LEVELS).distinct()
    several = targets.groupBy("dataset_id", "author_label").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    scoped = enabled(contrasts, CELL_SCOPES).select("analysis_id").distinct()
    parts = [
        issue(included.where(is_missing("subject_id")), "error", "single_cell", "SINGLE_CELL_SUBJECT_ID_MISSING", F.format_string("sample %s has no donor", "sample_id"), "Enter the donor.", **ids),
        issue(included.where(present("subject_id") & looks_like_barcode("subject_id")), "error", "single_cell", "SUBJECT_ID_LOOKS_LIKE_BARCODE", F.format_string("subject %s looks like a barcode", "subject_id"), "Enter the donor, not a cell.", subject_id="subject_id", **ids),
        issue(several, "error", "celltype_ontology", "CELLTYPE_ONE_TO_MANY_CONFLICT", F.format_string("label %s has %d targets", "author_label", "_n"), "Keep one mapping.", F.struct("author_label"), dataset_id="dataset_id"),
    ]
    if metrics is None:
        any_cells = included.agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 0)
        parts.append(issue(scoped.crossJoin(F.broadcast(any_cells)), "warning", "single_cell", "CELLTYPE_METRICS_MISSING", F.format_string("cells and donors of %s cannot be checked", "analysis_id"), "Compute cell-type metrics.", analysis_id="analysis_id"))  # one row
    elif {"dataset_id", "sample_id", "subject_id", "author_label", "cell_count"} - set(metrics.columns):
        parts.append(issue(metrics.sparkSession.range(1), "critical", "single_cell", "CELLTYPE_METRICS_HEADER_INVALID", "the metrics table lacks columns", "Regenerate it."))
    else:
        about = included.groupBy("sample_id").agg(F.max("subject_id").alias("_subject"), F.max("group").alias("_group"))
        m = metrics.join(about.withColumn("_known", F.lit(True)), "sample_id", "left")
        known = m.where(F.col("_known"))
        donors = known.groupBy("dataset_id", "author_label", "_group").agg(F.count_distinct("subject_id").alias("_donors")).where(F.col("_donors") < min_donors)
        labels = metrics.select("dataset_id", "author_label").distinct().join(ontology.select("dataset_id", "author_label").distinct(), ["dataset_id", "author_label"], "left_anti")
        harmonised = ontology.select("dataset_id", F.explode(F.array(*LEVELS)).alias("author_label")).where(present("author_label")).distinct().withColumn("_target", F.lit(True))
        labels = labels.join(harmonised, ["dataset_id", "author_label"], "left")
        parts += [
            issue(m.where(F.col("_known").isNull()), "error", "single_cell", "CELL_METRIC_SAMPLE_NOT_FOUND", F.format_string("metrics name unknown sample %s", "sample_id"), "Correct the metrics.", **ids),
            issue(known.where(~F.col("_subject").eqNullSafe(F.col("subject_id"))), "error", "single_cell", "CELL_METRIC_SUBJECT_MISMATCH", F.format_string("metrics give sample %s another donor", "sample_id"), "Regenerate the metrics.", subject_id="subject_id", **ids),
            issue(known.where(F.coalesce(F.col("cell_count").try_cast("bigint"), F.lit(-1)) < min_cells), "error", "single_cell", "INSUFFICIENT_CELLS_PER_CELLTYPE_SAMPLE", F.format_string("%s has few cells of %s", "sample_id", "author_label"), "Review the thresholds.", subject_id="subject_id", **ids),
            issue(labels, "error", "celltype_ontology", F.when(F.col("_target"), F.lit("AUTHOR_LABEL_POSSIBLY_OVERWRITTEN")).otherwise(F.lit("AUTHOR_LABEL_UNMAPPED")), F.format_string("label %s has no mapping", "author_label"), "Restore the author's label.", F.struct("author_label"), dataset_id="dataset_id"),
            issue(donors, "error", "single_cell", "INSUFFICIENT_DONORS_PER_CELLTYPE_GROUP", F.format_string("%s has few donors of %s", "_group", "author_label"), "Add donors.", F.struct("author_label", F.col("_group").alias("group")), dataset_id="dataset_id"),
        ]
    on = enabled(contrasts).join(scoped, "analysis_id", "left_semi")
    subjects = rows_for_analysis(samples, plan).where(cells & present("subject_id")).groupBy("analysis_id", "group").agg(F.count_distinct("subject_id").alias("_donors"))
    weak = _sides(on).join(subjects, ["analysis_id", "group"], "left").where(F.coalesce("_donors", F.lit(0)) < F.col("minimum"))
    parts.append(issue(weak, "error", "single_cell", "PSEUDOBULK_INSUFFICIENT_DONORS", F.format_string("group %s has too few donors", "group"), "Add donors.", analysis_id="analysis_id", contrast_id="contrast_id"))
    found = reuse(union(parts))
    return found.unionByName(passed(when_empty(found), "celltype_ontology", "CELLTYPE_DESIGN_VALID", "labels, cells and donors are in order"))


METRIC_COLUMNS = ("design_formula", "n_rows", "n_columns", "rank", "full_rank")


def validate_design(samples: DataFrame, contrasts: DataFrame, plan: DataFrame, max_missing: float = 0.2) -> DataFrame:
    """Missing and constant covariates, and the rank of each contrast's design.

    Formulas may hold products (``:``, ``*``), ``C()`` and ``- 1``; see
    ``operators.designs``, which codes all designs as one sparse long matrix.
    """
    columns = [*samples.columns, *([] if "dataset" in samples.columns else ["dataset"])]
    samples = reuse(spread(samples))
    rows_in = samples if "dataset" in samples.columns else samples.withColumn("dataset", F.col("dataset_id"))
    keys = ["analysis_id", "contrast_id"]
    on = enabled(contrasts)
    formula = F.coalesce("design_formula", F.lit(""))
    pick = F.array_compact(F.array(*[F.when(formula.rlike(rf"(?<![A-Za-z0-9_]){c}(?![A-Za-z0-9_])"), F.lit(c)) for c in columns]))
    about = on.select(*keys, formula.alias("formula"), pick.alias("vars"))
    chosen = contrast_rows(rows_in, on, plan).where(F.col("group").isin(F.col("numerator"), F.col("denominator")))
    rows = reuse(chosen.select(*keys, F.concat_ws("|", "dataset_id", "sample_id").alias("row"), "_values").join(F.broadcast(about), keys))
    sizes = rows.groupBy(*keys, "formula").agg(F.count(F.lit(1)).alias("n"))
    missing = is_missing("value")
    long = rows.select(*keys, "formula", "row", F.explode("vars").alias("variable"), "_values").select(*keys, "formula", "row", "variable", F.try_element_at("_values", "variable").alias("value"))
    per = long.groupBy(*keys, "formula", "variable").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("gone"), F.min(F.when(~missing, F.col("value"))).alias("lo"), F.max(F.when(~missing, F.col("value"))).alias("hi"),
        F.count(F.when(~missing, to_number("value"))).alias("numbers"),
    )
    share = F.col("gone") / F.col("n")
    known = F.array(*[F.lit(c) for c in columns])
    unknown = F.size(F.array_except(variables_of(F.col("terms")), known)) > 0
    termed = about.withColumn("terms", formula_terms("formula"))
    invalid = termed.where(F.col("terms").isNull() | F.coalesce(unknown, F.lit(False))).select(*keys, "formula").distinct()
    valid = termed.join(invalid.select(*keys), keys, "left_anti").select(*keys, "terms")
    fits = fit_designs(rows.select(*keys, "row", F.col("_values").alias("values")).join(F.broadcast(valid), keys), keys)
    fitted = sizes.join(fits, keys).withColumnRenamed("full_rank", "full")
    contrast = {k: k for k in keys}
    wrong_subset = on.where(present("subset_column") & ~F.col("subset_column").isin(*columns)).withColumn("formula", formula)
    nothing = on.withColumn("formula", formula).join(wrong_subset.select(*keys), keys, "left_anti").join(sizes.select(*keys), keys, "left_anti")

    def with_metrics(df: DataFrame, measured: bool, *args, **kw) -> DataFrame:
        numbers = [F.col(c).cast("string").alias(c) if measured else F.lit("0").alias(c) for c in ("n_rows", "n_columns", "rank")]
        full = F.when(F.col("full"), F.lit("true")).otherwise(F.lit("false")) if measured else F.lit("NA")
        made = issue(df, *args, **kw, **contrast)
        extra = df.select(*[k for k in keys], F.col("formula").alias("design_formula"), *numbers, full.alias("full_rank")).distinct()
        return made.join(extra, keys)

    constant = per.where(F.col("lo").isNull() | (F.col("lo") == F.col("hi")))
    paired = on.withColumn("formula", formula).where(is_true("paired") & ~formula.rlike(r"\b(subject_id|paired_group)\b")).join(sizes.select(*keys), keys, "left_semi")
    parts = [
        with_metrics(wrong_subset, False, "error", "design_matrix", "DESIGN_SUBSET_INVALID", "the subset column does not exist", "Correct the subset."),
        with_metrics(nothing, False, "error", "design_matrix", "NO_DESIGN_SAMPLES", "no sample is left for the design", "Check plan, subset and groups."),
        with_metrics(per.where(F.col("gone") > 0), False, F.when(share > max_missing, F.lit("error")).otherwise(F.lit("warning")), "design_matrix",
                     F.when(share > max_missing, F.lit("SEVERE_MISSING_COVARIATE")).otherwise(F.lit("MISSING_COVARIATE")), F.format_string("%s is missing in %d of %d samples", "variable", "gone", "n"), "Complete it or change the formula.", F.struct("variable", share.alias("missing_fraction"))),
        with_metrics(constant, False, "error", "design_matrix", "ZERO_VARIANCE_COVARIATE", F.format_string("%s never varies", "variable"), "Drop it from the formula.", F.struct("variable")),
        with_metrics(paired, False, "warning", "design_matrix", "PAIRED_FACTOR_NOT_IN_FORMULA", "a paired contrast without a pairing term", "Add the pairing term."),
        with_metrics(invalid.join(sizes.select(*keys), keys, "left_semi"), False, "error", "design_matrix", "DESIGN_FORMULA_INVALID", "the formula names an unknown variable", "Correct the formula."),
        with_metrics(fitted.where(F.col("n_rows") < F.col("n")), True, "error", "design_matrix", "DESIGN_ROWS_DROPPED", "samples with missing covariates would be dropped", "Complete the covariates."),
        with_metrics(fitted.where(~F.col("full")), True, "error", "design_matrix", "DESIGN_MATRIX_NOT_FULL_RANK", F.format_string("rank %d of %d columns", "rank", "n_columns"), "Resolve the redundancy."),
        with_metrics(fitted.where(F.col("full") & (F.col("n_rows") == F.col("n"))), True, "info", "design_matrix", "DESIGN_MATRIX_FULL_RANK", "the design is of full rank", "No action required.", status="pass"),
    ]
    return union(parts)


def joint_preflight(samples: DataFrame, plan: DataFrame, contrasts: DataFrame, compatibility: DataFrame, gene_check: DataFrame, dominance: float = 0.8) -> DataFrame:
    """Gates before datasets are modelled together; one set of rows per analysis.

    ``gene_check`` is (dataset_id, identical) from the shared gene-space check.
    """
    used = plan.where(is_true("include"))
    analyses = used.select("analysis_id").distinct()
    on = enabled(contrasts, ("bulk",))
    kind = F.lower(F.coalesce("data_type", F.lit("")))
    rows = rows_for_analysis(samples, plan).where(kind.contains("bulk") & ~kind.contains("pseudobulk"))
    a = {"analysis_id": "analysis_id"}
    d = {"analysis_id": "analysis_id", "dataset_id": "dataset_id"}
    grid = used.select("analysis_id", "dataset_id").distinct().join(on.select("analysis_id", "contrast_id"), "analysis_id")
    ok = compatibility.where(F.col("compatible_for_joint_model") == "true").select("analysis_id", "dataset_id", "contrast_id").distinct()
    overlap = listed(shared_identities(rows, ["analysis_id"]), ["analysis_id"], "identity")
    sizes = used.groupBy("analysis_id").agg(F.count_distinct("dataset_id").alias("_d"), F.bool_and(F.col("analysis_strategy") == "joint_model").alias("_joint"))
    tied = confounded(rows.join(on.select("analysis_id", "contrast_id", "numerator", "denominator"), "analysis_id"), ["analysis_id", "contrast_id"])
    found = union([
        issue(analyses.join(on.select("analysis_id").distinct(), "analysis_id", "left_anti"), "critical", "joint_model", "NO_ENABLED_BULK_CONTRAST", "no enabled bulk contrast", "Define one.", **a),
        issue(sizes.where(~F.col("_joint")), "critical", "joint_model", "JOINT_MODEL_NOT_SELECTED", "the plan does not ask for a joint model", "Set the strategy.", **a),
        issue(sizes.where(F.col("_d") < 2), "critical", "joint_model", "JOINT_MODEL_REQUIRES_MULTIPLE_DATASETS", "a joint model needs two datasets", "Revise the plan.", **a),
        issue(used.where(F.col("role") == "validation").select("analysis_id").distinct(), "critical", "joint_model", "VALIDATION_DATA_IN_DISCOVERY_MODEL", "validation data would be modelled", "Keep it apart.", **a),
        issue(grid.join(ok, ["analysis_id", "dataset_id", "contrast_id"], "left_anti"), "critical", "joint_model", "JOINT_MODEL_COMPATIBILITY_FAILED", F.format_string("%s is not approved for %s", "dataset_id", "contrast_id"), "Correct inputs or plan.", contrast_id="contrast_id", **d),
        issue(overlap, "critical", "joint_model", "OVERLAPPING_SAMPLE_IDENTITIES", F.format_string("%d identities are shared between datasets", "n_items"), "Resolve them.", F.struct(F.col("items").alias("identities")), **a),
        issue(dominant_dataset(rows, dominance, ["analysis_id"]), "warning", "joint_model", "DATASET_SAMPLE_SIZE_DOMINANCE", F.format_string("%s dominates", "dataset_id"), "Check its influence.", F.struct("fraction"), **d),
        issue(used.join(gene_check.where(~F.col("identical")).select("dataset_id"), "dataset_id", "left_semi"), "critical", "joint_model", "JOINT_GENE_ID_ORDER_MISMATCH", F.format_string("%s lists other genes", "dataset_id"), "Quantify against one reference.", **d),
        issue(used.join(rows.select("analysis_id", "dataset_id").distinct(), ["analysis_id", "dataset_id"], "left_anti"), "critical", "joint_model", "JOINT_SAMPLE_METADATA_MISSING", F.format_string("%s has no prepared samples", "dataset_id"), "Prepare it first.", **d),
        issue(tied, "critical", "joint_model", "DATASET_GROUP_COMPLETE_CONFOUNDING", "dataset and group cannot be told apart", "Do not fit a joint model.", analysis_id="analysis_id", contrast_id="contrast_id"),
    ])
    found = reuse(found)
    stopped = found.where((F.col("severity") == "critical")).select("analysis_id").distinct()
    return found.unionByName(passed(analyses.join(stopped, "analysis_id", "left_anti"), "joint_model", "JOINT_MODEL_INPUTS_VALID", "all gates passed", **a))


def pseudobulk_preflight(metadata: DataFrame, plan: DataFrame, contrasts: DataFrame, minimum: int = 2) -> DataFrame:
    """Joint pseudobulk gates: confounding, subjects per dataset, and the design of every contrast and cell type.

    The design is the contrast's own formula (``~ group`` where it has none) over
    the eligible units of the cell type: a formula that makes no sense or names an
    unknown column, units dropped for a missing value and a design of less than
    full rank are problems of their own.  A cell type without a unit on either side is passed over.
    """
    used = plan.where(is_true("include")).select("analysis_id", "dataset_id").distinct()
    formula = F.when(present("design_formula"), F.col("design_formula")).otherwise(F.lit("~ group"))
    on = enabled(contrasts, ("scrna_pseudobulk",)).select("analysis_id", "contrast_id", "numerator", "denominator", formula.alias("formula"))
    rows = metadata.join(used, "dataset_id").join(on, "analysis_id")
    keys = ["analysis_id", "contrast_id"]

    def problem(df: DataFrame, text: str | Column, dataset: str | None = None, cell_type: str | None = None) -> DataFrame:
        name = lambda c: F.col(c) if c else F.lit("NA")
        text = text if isinstance(text, Column) else F.lit(text)
        return df.select(*keys, name(dataset).alias("dataset_id"), name(cell_type).alias("cell_type"), text.alias("problem"))

    tied = problem(confounded(rows, keys), "dataset_group_complete_confounding")
    grid = used.join(on, "analysis_id").select(*keys, "dataset_id", F.explode(F.array("numerator", "denominator")).alias("group"))
    counts = rows.groupBy(*keys, "dataset_id", "group").agg(F.count_distinct("subject_id").alias("_n"))
    weak = grid.join(counts, [*keys, "dataset_id", "group"], "left").withColumn("_n", F.coalesce("_n", F.lit(0))).where(F.col("_n") < minimum)
    weak = problem(weak, F.format_string(f"insufficient_subjects:%s:%d<{minimum}", "group", "_n"), "dataset_id")
    columns = [*metadata.columns, *([] if "dataset" in metadata.columns else ["dataset"])]
    known = metadata if "dataset" in metadata.columns else metadata.withColumn("dataset", F.col("dataset_id"))
    sided = known.withColumn("_values", _values(columns)).join(used, "dataset_id").join(on, "analysis_id")
    sided = sided.where(F.col("group").isin(F.col("numerator"), F.col("denominator")))
    terms = on.select(*keys, formula_terms("formula").alias("terms"))
    unknown = F.size(F.array_except(variables_of(F.col("terms")), F.array(*[F.lit(c) for c in columns]))) > 0
    valid = terms.where(F.col("terms").isNotNull() & ~unknown)
    types = sided.select(*keys, "cell_type").distinct()
    invalid = problem(types.join(valid.select(*keys), keys, "left_anti"), "design_invalid", cell_type="cell_type")
    unit = F.concat_ws("|", "dataset_id", "subject_id", "group", "cell_type")
    fits = fit_designs(sided.select(*keys, "cell_type", unit.alias("row"), F.col("_values").alias("values")).join(valid, keys), [*keys, "cell_type"])
    fits = reuse(fits)
    dropped = problem(fits.where(F.col("n_rows") < F.col("n_samples")), "design_rows_dropped", cell_type="cell_type")
    rank = problem(fits.where(~F.col("full_rank")), "design_matrix_not_full_rank", cell_type="cell_type")
    return union([tied, weak, invalid, dropped, rank])
