"""Differential tests on raw counts, built from aggregates only.

The tests are method-of-moments forms of a negative-binomial Wald test: same
output columns as a full model fit, not the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text
from countloom.functions.special import SMALLEST, two_sided_p
from countloom.operators.counts import SAMPLE, size_factors, size_normalize
from countloom.operators.ranking import bh_adjust, head_per_group, quantiles
from countloom.session import reuse

PSEUDO = 0.5
FLOOR = 1e-8


def two_group_test(
    counts: DataFrame, samples: DataFrame | None, numerator: str, denominator: str,
    by: Sequence[str] = ("dataset_id",), min_total: int = 1, normalized: bool = False, factors: DataFrame | None = None, adjust: bool = True,
) -> DataFrame:
    """Wald test per gene: baseMean, log2FoldChange, lfcSE, stat, pvalue, padj.

    Absent counts are zeros: sums come from the rows present, sizes from the
    samples.  ``by`` may hold further keys (a cell type) next to the dataset.
    ``factors`` (by, sample_id, group, f) are the factors of normalized counts, where
    the caller knows them: without it they are a pass over the counts.  Counts that
    carry their ``group`` are not joined with the samples.  ``adjust`` adds padj.
    """
    by = list(by)
    if "group" in counts.columns:
        chosen = counts.where(F.col("group").isin(numerator, denominator))
    else:
        about = samples.where(F.col("group").isin(numerator, denominator)).select(*SAMPLE, "group").distinct()
        chosen = counts.join(about, SAMPLE)
    # Size of each side and its mean inverse factor, from the samples present.
    if normalized or by != ["dataset_id"]:
        scaled = chosen if normalized else size_normalize(chosen)
        factor = F.col("count") / F.col("normalized")
        per_sample = factors if factors is not None else scaled.where(F.col("count") > 0).groupBy(*by, "sample_id", "group").agg(F.max(factor).alias("f"))
    else:
        factors = size_factors(chosen).drop("size_method")
        scaled = chosen.join(factors, SAMPLE).withColumn("normalized", F.col("count") / F.col("size_factor"))
        per_sample = about.join(factors, SAMPLE).withColumnRenamed("size_factor", "f")
    up, down = F.col("group") == numerator, F.col("group") == denominator
    sizes = per_sample.groupBy(*by).agg(
        F.count_if(up).alias("n1"), F.count_if(down).alias("n0"),
        F.avg(F.when(up, 1.0 / F.col("f"))).alias("r1"), F.avg(F.when(down, 1.0 / F.col("f"))).alias("r0"),
    )
    x = F.col("normalized")
    sums = scaled.groupBy(*by, "gene_id").agg(
        F.sum("count").alias("total"),
        F.sum(F.when(up, x).otherwise(0.0)).alias("s1"), F.sum(F.when(up, x * x).otherwise(0.0)).alias("q1"),
        F.sum(F.when(down, x).otherwise(0.0)).alias("s0"), F.sum(F.when(down, x * x).otherwise(0.0)).alias("q0"),
    ).where((F.col("total") >= min_total) & (F.col("total") > 0))
    joined = sums.join(sizes, by).where((F.col("n1") > 0) & (F.col("n0") > 0))
    n1, n0, div = F.col("n1"), F.col("n0"), F.try_divide
    parts = joined.withColumns({"m1": div("s1", "n1"), "m0": div("s0", "n0"), "baseMean": div(F.col("s1") + F.col("s0"), n1 + n0)})
    within = (F.col("q1") - F.col("s1") * F.col("m1")) + (F.col("q0") - F.col("s0") * F.col("m0"))
    pooled = div(within, n1 + n0 - 2)
    noise = F.col("baseMean") * div(n1 * F.col("r1") + n0 * F.col("r0"), n1 + n0)
    alpha = F.greatest(F.lit(FLOOR), div(F.coalesce(pooled, noise) - noise, F.col("baseMean") * F.col("baseMean")))
    parts = parts.withColumn("dispersion", alpha)

    def side(m: str, n: str, r: str):
        var = div(F.col(m) * F.col(r) + F.col("dispersion") * F.col(m) * F.col(m), F.col(n))
        return div(var, (F.col(m) + PSEUDO) * (F.col(m) + PSEUDO))

    effect = F.log2(div(F.col("m1") + PSEUDO, F.col("m0") + PSEUDO))
    error = F.sqrt(side("m1", "n1", "r1") + side("m0", "n0", "r0")) / float(np.log(2.0))
    tested = parts.withColumns({"log2FoldChange": effect, "lfcSE": error}).withColumn("stat", div("log2FoldChange", "lfcSE"))
    tested = tested.withColumn("pvalue", two_sided_p("stat")).select(
        *by, "gene_id", "baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue",
        (F.col("n1") + F.col("n0")).alias("sample_size"),
    )
    return bh_adjust(tested, "pvalue", by) if adjust else tested


def contrast_test(
    counts: DataFrame, samples: DataFrame, numerator: str, denominator: str, formula: str = "~ group", min_total: int = 1
) -> DataFrame:
    """Linear contrast on log2 normalised counts, other terms of the formula held fixed.

    Only the p x p product of the design reaches the driver; genes are fitted by
    one aggregate of p sums each.
    """
    about = samples.where(F.col("group").isin(numerator, denominator))
    # The reference level must be coded 0, so put it last in the indexer's order.
    about = about.withColumn("group", F.when(F.col("group") == denominator, F.lit("z0")).otherwise(F.lit("a1")))
    model = RFormula(formula=formula, featuresCol="_f", labelCol="_l", stringIndexerOrderType="alphabetAsc").fit(about)
    coded = model.transform(about).withColumn("_x", F.concat(F.array(F.lit(1.0)), vector_to_array("_f")))
    names = _design_names(model.transform(about))
    target = next(i for i, name in enumerate(names) if name.startswith("group"))
    p = len(names)
    design = coded.select(*SAMPLE, *[F.col("_x")[i].alias(f"_x{i}") for i in range(p)])
    products = design.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"p{i}_{j}") for i in range(p) for j in range(i, p)],
    ).first()
    matrix = np.array([[products[f"p{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
    if np.linalg.matrix_rank(matrix) < p:
        raise ValueError("the design is not of full rank")
    inverse, free = np.linalg.inv(matrix), products["n"] - p
    if free < 1:
        raise ValueError("no residual degrees of freedom")
    scaled = size_normalize(counts.join(about.select(*SAMPLE), SAMPLE, "left_semi"))
    y = F.log2(F.col("normalized") + 1)
    fits = scaled.join(design, SAMPLE).groupBy("gene_id").agg(
        F.sum("count").alias("total"), F.avg("normalized").alias("mean_present"), F.sum("normalized").alias("norm_sum"),
        F.sum(y * y).alias("yy"), *[F.sum(F.col(f"_x{i}") * y).alias(f"b{i}") for i in range(p)],
    ).where((F.col("total") >= min_total) & (F.col("total") > 0))
    beta = [sum((F.lit(float(inverse[i, j])) * F.col(f"b{j}") for j in range(p)), F.lit(0.0)) for i in range(p)]
    explained = sum((beta[i] * F.col(f"b{i}") for i in range(p)), F.lit(0.0))
    residual = F.greatest(F.lit(FLOOR), (F.col("yy") - explained) / float(free))
    tested = fits.select(
        "gene_id",
        (F.col("norm_sum") / float(products["n"])).alias("baseMean"),
        beta[target].alias("log2FoldChange"),
        F.sqrt(residual * float(inverse[target, target])).alias("lfcSE"),
    ).withColumn("stat", F.col("log2FoldChange") / F.col("lfcSE"))
    return bh_adjust(tested.withColumn("pvalue", two_sided_p("stat")), "pvalue")


def _design_names(coded: DataFrame) -> list[str]:
    """Column names of the coded design, intercept first, from the vector's metadata."""
    attrs = coded.schema["_f"].metadata["ml_attr"]["attrs"]
    found = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return ["Intercept", *[name for _, name in found]]


def significant(effects: DataFrame, alpha: float = 0.05, abs_lfc: float = 1.0) -> DataFrame:
    return effects.where((F.col("padj") < alpha) & (F.abs("log2FoldChange") >= abs_lfc))


def volcano(effects: DataFrame, alpha: float = 0.05, abs_lfc: float = 1.0) -> DataFrame:
    called = F.coalesce((F.col("padj") < alpha) & (F.abs("log2FoldChange") >= abs_lfc), F.lit(False))
    return effects.withColumns(
        {"significant": called, "minus_log10_padj": F.when(F.col("padj").isNotNull(), -F.log10(F.greatest(F.col("padj"), F.lit(SMALLEST))))}
    )


def direction_summary(effects: DataFrame, by: Sequence[str], alpha: float = 0.05, abs_lfc: float = 1.0) -> DataFrame:
    """Tested, significant, up, down and the median significant effect."""
    by = list(by)
    effects = reuse(effects)
    called = F.coalesce((F.col("padj") < alpha) & (F.abs("log2FoldChange") >= abs_lfc), F.lit(False))
    counted = effects.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tested_genes"),
        F.count_if(called).alias("significant_genes"),
        F.count_if(called & (F.col("log2FoldChange") > 0)).alias("up_genes"),
        F.count_if(called & (F.col("log2FoldChange") < 0)).alias("down_genes"),
    )
    middle = quantiles(significant(effects, alpha, abs_lfc), "log2FoldChange", by, {"median_significant_log2fc": 0.5})
    return counted.join(middle, by, "left")


def top_genes(effects: DataFrame, by: Sequence[str], n: int = 50) -> DataFrame:
    """The n smallest adjusted p-values per family (the heat-map table)."""
    return head_per_group(effects.where(F.col("padj").isNotNull()), by, [F.col("padj"), F.col("gene_id")], n)


def contrast_qc(
    counts: DataFrame, samples: DataFrame, effects: DataFrame, numerator: str, denominator: str,
    rank: int, columns: int, alpha: float = 0.05, abs_lfc: float = 1.0,
) -> DataFrame:
    """One row per dataset: design size, samples per side, genes in, kept and called."""
    side = samples.where(F.col("group").isin(numerator, denominator)).groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.count_if(F.col("group") == numerator).alias("numerator_samples"),
        F.count_if(F.col("group") == denominator).alias("denominator_samples"),
    )
    raw = counts.groupBy("dataset_id").agg(F.count_distinct("gene_id").alias("genes_in_raw_matrix"))
    called = F.coalesce((F.col("padj") < alpha) & (F.abs("log2FoldChange") >= abs_lfc), F.lit(False))
    kept = effects.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("genes_analyzed"), F.count_if(called).alias("significant_genes")
    )
    return side.join(raw, "dataset_id").join(kept, "dataset_id").select(
        "dataset_id",
        F.lit(numerator).alias("numerator"),
        F.lit(denominator).alias("denominator"),
        F.lit(rank).alias("design_rank"),
        F.lit(columns).alias("design_columns"),
        bool_text(F.lit(rank == columns)).alias("design_full_rank"),
        "sample_count", "numerator_samples", "denominator_samples", "genes_in_raw_matrix", "genes_analyzed",
        (F.col("genes_in_raw_matrix") - F.col("genes_analyzed")).alias("genes_filtered"),
        "significant_genes",
        F.lit(0).alias("samples_removed"),
    )


def adjust_batch(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Counts rescaled so each gene has the same mean in every batch.

    Labelled ``adjusted``; raw counts stay the input of the tests.
    """
    about = samples.select(*SAMPLE, "batch")
    sizes = about.groupBy("batch").agg(F.count(F.lit(1)).alias("_nb"))
    total = about.agg(F.count(F.lit(1)).alias("_n"))
    joined = counts.join(about, SAMPLE)
    batch = joined.groupBy("gene_id", "batch").agg(F.sum("count").alias("_sb"))
    whole = batch.groupBy("gene_id").agg(F.sum("_sb").alias("_s"))
    scale = batch.join(whole, "gene_id").join(sizes, "batch").crossJoin(F.broadcast(total)).select(  # one row
        "gene_id", "batch",
        F.try_divide(F.col("_s") / F.col("_n"), F.col("_sb") / F.col("_nb")).alias("_scale"),
    )
    return joined.join(scale, ["gene_id", "batch"]).select(
        *counts.columns, "batch", (F.col("count") * F.coalesce("_scale", F.lit(1.0))).alias("adjusted"), F.lit("adjusted").alias("count_label")
    )
