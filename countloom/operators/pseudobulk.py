"""Subject-level sums of cells, their eligibility, and tests on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, is_missing, is_true
from countloom.functions.text import joined_or, kept
from countloom.operators.testing import two_group_test
from countloom.session import written

COVARIATES = ("condition", "tissue", "batch", "sex", "age", "timepoint", "treatment", "paired_group")
UNIT = ["dataset_id", "subject_id", "group", "cell_type"]


def with_cell_type(cells: DataFrame) -> DataFrame:
    """Cell type: given, else harmonised level 2, else the author's label."""
    if "cell_type" in cells.columns:
        return cells
    return cells.withColumn("cell_type", F.col("harmonized_level2" if "harmonized_level2" in cells.columns else "author_label"))


def pseudobulk(
    cells: DataFrame, cell_counts: DataFrame, min_cells: int = 1, min_total_counts: int = 0,
    min_detected_genes: int = 0, extra_strata: Sequence[str] = (), keep: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(counts per unit and gene, metadata per unit).

    The unit key is the columns themselves; a rendered id never joins anything,
    so units of different datasets cannot collide.  ``keep`` writes the sums of the
    units, for callers that read both tables: they are then made once.
    """
    rows = with_cell_type(cells)
    rows = rows.where("qc_retained") if "qc_retained" in rows.columns else rows
    unit = [*UNIT, *extra_strata]
    counts = cell_counts.join(rows.select("cell_id", *unit), "cell_id").groupBy(*unit, "gene_id").agg(F.sum("count").alias("count"))
    counts = written(counts, "units") if keep else counts
    sums = counts.groupBy(*unit).agg(F.sum("count").alias("total_UMI"), F.count_if(F.col("count") > 0).alias("detected_genes"))
    known = [c for c in COVARIATES if c in rows.columns and c not in unit]
    # Distinct values per unit are counted after a first collapse, so a hot unit is merged map-side.
    about = rows.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("cell_count"),
        F.array_sort(F.collect_set("sample_id")).alias("_samples"),
        F.min("author_label").alias("_low"), F.max("author_label").alias("_high"),
        *[
            F.when(F.min(c) == F.max(c), F.when(F.count(c) == F.count(F.lit(1)), F.min(c).cast("string"))).alias(f"_{c}")
            for c in known
        ],
    )
    joined = about.join(sums, unit, "left").na.fill(0, ["total_UMI", "detected_genes"])
    reasons = kept(
        (F.col("cell_count") < min_cells, "min_cells_per_pseudobulk"),
        (F.col("total_UMI") < min_total_counts, "min_total_counts"),
        (F.col("detected_genes") < min_detected_genes, "min_detected_genes"),
    )
    joined = joined.withColumn("_reasons", reasons)
    fine = F.size("_reasons") == 0
    metadata = joined.select(
        *unit,
        F.when(F.size("_samples") == 1, F.col("_samples")[0]).otherwise(F.lit("multiple")).alias("sample_id"),
        F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.lit("multiple")).alias("author_label"),
        F.concat_ws(";", "_samples").alias("sample_ids"),
        "cell_count", "total_UMI", "detected_genes",
        F.when(fine, F.lit("eligible")).otherwise(F.lit("ineligible")).alias("eligibility"),
        joined_or(F.col("_reasons"), "pass").alias("exclusion_reason"),
        bool_text(fine).alias("eligible_for_de"),
        *[F.coalesce(F.col(f"_{c}"), F.lit("NA")).alias(c) for c in known],
    )
    return counts, metadata


def eligible(metadata: DataFrame) -> DataFrame:
    return metadata.where((F.col("eligibility") == "eligible") | (F.col("eligible_for_de") == "true"))


def subject_purity(metadata: DataFrame, key: str = "pseudobulk_id") -> DataFrame:
    """Units that merge several subjects (there must be none)."""
    return metadata.groupBy(key).agg(F.count_distinct("subject_id").alias("subjects")).where(F.col("subjects") != 1)


def subjects_per_group(metadata: DataFrame, numerator: str, denominator: str, by: Sequence[str]) -> DataFrame:
    """Distinct subjects on each side, zero when a side is absent."""
    side = lambda g: F.count_distinct(F.when(F.col("group") == g, F.col("subject_id")))
    return metadata.groupBy(*by).agg(side(numerator).alias("numerator_subjects"), side(denominator).alias("denominator_subjects"))


def cell_type_eligibility(metadata: DataFrame, min_cells: int, min_subjects: int) -> DataFrame:
    """Per cell type: skipped when any unit is small or any group has few subjects."""
    groups = metadata.groupBy("cell_type", "group").agg(
        F.count_distinct("subject_id").alias("_subjects"), F.min("cell_count").alias("_cells")
    )
    worst = groups.groupBy("cell_type").agg(F.min("_subjects").alias("_subjects"), F.min("_cells").alias("_cells"))
    reasons = kept(
        (F.col("_cells") < min_cells, "min_cells_per_pseudobulk_not_met"),
        (F.col("_subjects") < min_subjects, "min_subjects_per_group_not_met"),
    )
    out = worst.withColumn("_reasons", reasons)
    return out.select(
        "cell_type",
        F.when(F.size("_reasons") == 0, F.lit("eligible")).otherwise(F.lit("skipped")).alias("eligibility"),
        joined_or(F.col("_reasons"), "pass").alias("exclusion_reason"),
    )


def group_statistics(metadata: DataFrame, by: Sequence[str] = ("cell_type",)) -> DataFrame:
    return metadata.groupBy(*by, "group").agg(
        F.count_distinct("subject_id").alias("subjects"),
        F.sum("cell_count").alias("cells"),
        F.sum("total_UMI").alias("total_UMI"),
        F.max("detected_genes").alias("max_detected_genes"),
    )


def pseudobulk_test(
    counts: DataFrame, metadata: DataFrame, numerator: str, denominator: str, min_subjects: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(effects per dataset, cell type and gene; skipped cell types with the reason)."""
    keys = ["dataset_id", "cell_type"]
    good = written(_sided_units(metadata, numerator, denominator), "eligible")
    sides, enough = _enough(good, numerator, denominator, min_subjects)
    tested = good.join(sides.where(enough).select(*keys), keys, "left_semi")
    # Library scaling: sparse units rarely share a gene without zeros.
    units = tested.join(tested.groupBy(*keys).agg(F.avg("total_UMI").alias("_mean")), keys)
    scaled = _scaled(counts.join(units, UNIT), keys, "group")
    effects = two_group_test(scaled, None, numerator, denominator, keys, normalized=True, factors=_factors(units, keys, "group"))
    return effects, _skipped(sides, enough)


def skipped_types(metadata: DataFrame, numerator: str, denominator: str, min_subjects: int = 2) -> DataFrame:
    """The skipped cell types of ``pseudobulk_test`` alone: from the units, without any test."""
    return _skipped(*_enough(_sided_units(metadata, numerator, denominator), numerator, denominator, min_subjects))


def _sided_units(metadata: DataFrame, numerator: str, denominator: str) -> DataFrame:
    return eligible(metadata).where(F.col("group").isin(numerator, denominator)).select(*UNIT, "total_UMI")


def _enough(good: DataFrame, numerator: str, denominator: str, min_subjects: int) -> tuple[DataFrame, Column]:
    sides = subjects_per_group(good, numerator, denominator, ["dataset_id", "cell_type"])
    return sides, (F.col("numerator_subjects") >= min_subjects) & (F.col("denominator_subjects") >= min_subjects)


def _skipped(sides: DataFrame, enough: Column) -> DataFrame:
    return sides.where(~enough).select(
        "dataset_id", "cell_type", "numerator_subjects", "denominator_subjects", F.lit("insufficient_subjects_per_group").alias("reason")
    )


def preparation_issues(cells: DataFrame, ontology: DataFrame) -> DataFrame:
    """Guards before summing: missing subject or label, label without a confirmed mapping."""
    from countloom.operators.cells import unmapped_labels

    subject = cells.where(is_missing("subject_id")).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("rows")).select(
        "dataset_id", F.lit("subject_id_missing").alias("problem"), F.lit("NA").alias("value"), "rows"
    )
    label = cells.where(is_missing("author_label")).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("rows")).select(
        "dataset_id", F.lit("author_label_missing").alias("problem"), F.lit("NA").alias("value"), "rows"
    )
    free = unmapped_labels(cells, ontology).select(
        "dataset_id", F.lit("author_label_unmapped").alias("problem"), F.col("author_label").alias("value"), F.lit(1).cast("bigint").alias("rows")
    )
    return subject.unionByName(label).unionByName(free)


def contrast_status(metadata: DataFrame, contrasts: DataFrame, min_subjects: int = 2, scope: str = "scrna_pseudobulk") -> DataFrame:
    """The status of ``contrast_tests`` alone: from the units, without any test."""
    return _sides(metadata, contrasts, min_subjects, scope)[1]


def _sides(metadata: DataFrame, contrasts: DataFrame, min_subjects: int, scope: str) -> tuple[DataFrame, DataFrame]:
    """(eligible units once for every contrast that names their group, status per contrast and cell type)."""
    on = contrasts.where(is_true("enabled") & (F.col("data_scope") == scope)).select(
        "contrast_id", "numerator", "denominator",
        F.greatest(F.coalesce(F.col("min_replicates_per_group").try_cast("int"), F.lit(1)), F.lit(min_subjects)).alias("minimum"),
    )
    good = eligible(metadata).select(*UNIT, "total_UMI")
    sided = good.join(on, F.col("group").isin(F.col("numerator"), F.col("denominator"))).withColumn(
        "side", F.when(F.col("group") == F.col("numerator"), F.lit("up")).otherwise(F.lit("down"))
    )
    sided = written(sided, "sided")
    keys = ["contrast_id", "cell_type"]
    of = lambda side: F.count_distinct(F.when(F.col("side") == side, F.concat_ws("|", "dataset_id", "subject_id")))
    sides = sided.groupBy(*keys, "minimum").agg(of("up").alias("numerator_subjects"), of("down").alias("denominator_subjects"))
    types = good.select("cell_type").distinct()
    grid = on.select("contrast_id", "minimum").join(types.withColumn("_all", F.lit(True)), F.col("_all"))  # contrasts x cell types
    seen = ["numerator_subjects", "denominator_subjects"]
    status = grid.drop("_all").join(sides.drop("minimum"), keys, "left").na.fill(0, seen)
    enough = (F.col("numerator_subjects") >= F.col("minimum")) & (F.col("denominator_subjects") >= F.col("minimum"))
    status = status.select(
        *keys, F.when(enough, F.lit("tested")).otherwise(F.lit("skipped_insufficient_subjects")).alias("status"),
        F.col("minimum").alias("minimum_subjects_per_group"), *seen,
    )
    return sided, status


def contrast_tests(
    counts: DataFrame, metadata: DataFrame, contrasts: DataFrame, min_subjects: int = 2, scope: str = "scrna_pseudobulk",
    adjust: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(effects, status) of every enabled contrast and cell type at once.

    A cell type is tested where both sides have the larger of ``min_subjects`` and the
    contrast's own minimum of subjects, in the datasets at hand taken together;
    ``status`` has one row per contrast and cell type with that minimum.  Each unit is
    copied once for every contrast that names its group, and all tests share one pass.
    """
    sided, status = _sides(metadata, contrasts, min_subjects, scope)
    keys = ["contrast_id", "cell_type"]
    tested = sided.join(status.where(F.col("status") == "tested").select(*keys), keys, "left_semi")
    units = tested.join(tested.groupBy(*keys).agg(F.avg("total_UMI").alias("_mean")), keys)
    scaled = _scaled(counts.select(*UNIT, "gene_id", "count").join(units, UNIT), keys, "side")
    return two_group_test(scaled, None, "up", "down", keys, normalized=True, factors=_factors(units, keys, "side"), adjust=adjust), status


def _scaled(rows: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Counts of units scaled to the mean total of their test, and the side they stand on.

    Rows are sent to their genes as whole numbers: sums and squares of scaled counts
    would be three times as wide.
    """
    rows = rows.select(*keys, F.col(side).alias("group"), "gene_id", "count", "total_UMI", "_mean").repartition(*keys, "gene_id")
    return rows.select(*keys, "group", "gene_id", "count", (F.col("count") / F.col("total_UMI") * F.col("_mean")).alias("normalized"))


def _factors(units: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """One factor per unit with counts; a unit without dataset or subject meets no counts."""
    there = (F.col("total_UMI") > 0) & F.col("dataset_id").isNotNull() & F.col("subject_id").isNotNull()
    return units.where(there).select(*keys, F.col(side).alias("group"), (F.col("total_UMI") / F.col("_mean")).alias("f"))
