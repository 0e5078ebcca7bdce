"""Long-format bulk counts: metrics, normalisation, sample QC, PCA, distances.

Counts are triplets ``(dataset_id, gene_id, sample_id, count)``; an absent
triplet is a zero, so nothing is densified.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, is_integral, to_number
from countloom.functions.text import joined_or, kept
from countloom.operators.pairwise import gram, mirrored
from countloom.operators.ranking import quantiles
from countloom.session import reuse

SAMPLE = ["dataset_id", "sample_id"]
# Fixed value: scales a median absolute deviation to a standard deviation.
NORMAL_MAD = 0.6744897501960817


def library_metrics(counts: DataFrame, min_count: int = 1) -> DataFrame:
    """Library size and detected genes per sample."""
    return counts.groupBy(*SAMPLE).agg(
        F.sum("count").alias("library_size"),
        F.sum((F.col("count") >= min_count).cast("bigint")).alias("detected_genes"),
    )


def filter_low_counts(counts: DataFrame, min_total: int = 1, by: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Keep genes whose row sum is above zero and at least ``min_total``."""
    keys = [*by, "gene_id"]
    total = counts.groupBy(*keys).agg(F.sum("count").alias("_total"))
    keep = total.where((F.col("_total") >= min_total) & (F.col("_total") > 0)).select(*keys)
    return counts.join(keep, keys, "left_semi")


def robust_z(df: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Adds ``<value>_robust_z``: MAD-scaled, else plain z, else 0."""
    by = list(by)
    long = df.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("x")) for v in values])
        ).alias("_m"),
    ).select(*by, "_m.metric", "_m.x")
    keys = [*by, "metric"]
    center = quantiles(long, "x", keys, {"median": 0.5})
    spread = long.join(center, keys).select(*keys, F.abs(F.col("x") - F.col("median")).alias("dev"))
    mad = quantiles(spread, "dev", keys, {"mad": 0.5})
    plain = long.groupBy(*keys).agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))
    stats = center.join(mad, keys).join(plain, keys)
    wide = stats.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("metric") == v, F.col(s))).alias(f"_{v}_{s}")
            for v in values
            for s in ("median", "mad", "mean", "sd")
        ]
    )
    out = df.join(wide, by)
    for v in values:
        x = F.col(v).cast("double")
        med, mad_, mean, sd = (F.col(f"_{v}_{s}") for s in ("median", "mad", "mean", "sd"))
        out = out.withColumn(
            f"{v}_robust_z",
            F.when(mad_ > 0, F.lit(NORMAL_MAD) * (x - med) / mad_)
            .when(sd > 0, (x - mean) / sd)
            .otherwise(F.lit(0.0)),
        )
    return out.drop(*[c for c in wide.columns if c not in by])


def flag_outliers(metrics: DataFrame, threshold: float, names: Sequence[str]) -> DataFrame:
    """Flags, never drops: ``retained_for_analysis`` is always true."""
    flagged = kept(*[(F.abs(F.col(f"{n}_robust_z")) >= threshold, n) for n in names])
    out = metrics.withColumn("_flags", flagged)
    return out.select(
        *metrics.columns,
        bool_text(F.size("_flags") > 0).alias("outlier_flag"),
        joined_or(F.col("_flags"), "none").alias("flagged_metrics"),
        F.lit("true").alias("retained_for_analysis"),
        F.when(F.size("_flags") > 0, F.lit("user_review_manifest")).otherwise(F.lit("none")).alias("required_action"),
    )


def sample_metrics_qc(counts: DataFrame, z: float = 3.0, min_count: int = 1) -> DataFrame:
    """Library-size and detected-gene flags only: pure aggregates, any number of samples."""
    metrics = reuse(library_metrics(counts, min_count).withColumn("_log", F.log10(F.col("library_size") + 1)))
    scored = robust_z(metrics, ["_log", "detected_genes"], ["dataset_id"])
    scored = scored.withColumnRenamed("_log_robust_z", "library_size_robust_z").drop("_log")
    return flag_outliers(scored, z, ["library_size", "detected_genes"])


def sample_qc(counts: DataFrame, samples: DataFrame, z: float = 3.0, min_count: int = 1, tiles: int = 1) -> DataFrame:
    """Sample metrics with robust z of size, detected genes and PCA distance."""
    metrics = library_metrics(counts, min_count).withColumn("_log", F.log10(F.col("library_size") + 1))
    pca = reuse(sample_pca(counts, k=5, tiles=tiles))
    axes = [f"PC{i}" for i in range(1, 6)]
    scores = pca.unpivot(SAMPLE, axes, "axis", "score")
    middle = quantiles(scores, "score", ["dataset_id", "axis"], {"middle": 0.5})
    gap = F.col("score") - F.col("middle")
    far = scores.join(middle, ["dataset_id", "axis"]).groupBy(*SAMPLE).agg(F.sqrt(F.sum(gap * gap)).alias("pca_distance"))
    scored = robust_z(reuse(metrics.join(far, SAMPLE)), ["_log", "detected_genes", "pca_distance"], ["dataset_id"])
    scored = scored.withColumnRenamed("_log_robust_z", "library_size_robust_z").drop("_log")
    flagged = flag_outliers(scored, z, ["library_size", "detected_genes", "pca_distance"])
    about = [c for c in ("group", "batch", "subject_id") if c in samples.columns]
    return flagged.join(samples.select(*SAMPLE, *about), SAMPLE, "left")


def sample_pca(counts: DataFrame, k: int = 5, tiles: int = 1, transform: str = "log2") -> DataFrame:
    """First k scores of the gene-centred samples of each dataset.

    The samples x samples product is summed in the cluster; only that matrix
    (samples squared, whatever the number of genes) is decomposed per dataset.
    """
    x = F.log2(F.col("count") + 1) if transform == "log2" else F.col("count").cast("double")
    values = counts.select(*SAMPLE, "gene_id", x.alias("x"))
    sizes = values.select(*SAMPLE).distinct().groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    gene = (
        values.groupBy("dataset_id", "gene_id")
        .agg(F.sum("x").alias("_s"))
        .join(sizes, "dataset_id")
        .select("dataset_id", "gene_id", (F.col("_s") / F.col("n")).alias("mean"))
    )
    grand = gene.groupBy("dataset_id").agg(F.sum(F.col("mean") * F.col("mean")).alias("grand"))
    edge = (
        values.join(gene, ["dataset_id", "gene_id"])
        .groupBy(*SAMPLE)
        .agg(F.sum(F.col("x") * F.col("mean")).alias("edge"))
    )
    raw = gram(values, ["dataset_id"], "gene_id", "sample_id", "x", tiles)
    centred = (
        raw.join(edge.withColumnsRenamed({"sample_id": "col_i", "edge": "edge_i"}), ["dataset_id", "col_i"])
        .join(edge.withColumnsRenamed({"sample_id": "col_j", "edge": "edge_j"}), ["dataset_id", "col_j"])
        .join(grand, "dataset_id")
        .select(
            "dataset_id", "col_i", "col_j", (F.col("dot") - F.col("edge_i") - F.col("edge_j") + F.col("grand")).alias("dot")
        )
    )
    names = [f"PC{i}" for i in range(1, k + 1)]
    schema = "dataset_id string, sample_id string, " + ", ".join(f"{n} double" for n in names)
    return centred.groupBy("dataset_id").applyInPandas(_scores(k), schema)


def _scores(k: int):
    def run(key: tuple, pairs: pd.DataFrame) -> pd.DataFrame:
        names = np.array(sorted(set(pairs["col_i"]) | set(pairs["col_j"])), dtype=object)
        at = {name: i for i, name in enumerate(names)}
        i, j = pairs["col_i"].map(at).to_numpy(), pairs["col_j"].map(at).to_numpy()
        matrix = np.zeros((len(names), len(names)))
        matrix[i, j] = matrix[j, i] = pairs["dot"].to_numpy()
        size, axes = np.linalg.eigh(matrix)
        order = np.argsort(size)[::-1][:k]
        scores = axes[:, order] * np.sqrt(np.clip(size[order], 0.0, None))
        # A component has no natural sign: make its largest entry positive.
        lead = scores[np.abs(scores).argmax(axis=0), np.arange(scores.shape[1])]
        scores = scores * np.where(lead < 0, -1.0, 1.0)
        out = pd.DataFrame({"dataset_id": key[0], "sample_id": names})
        for c in range(k):
            out[f"PC{c + 1}"] = scores[:, c] if c < scores.shape[1] else 0.0
        return out

    return run


def sample_pairs(expression: DataFrame, value: str, metric: str = "distance", by: Sequence[str] = ("dataset_id",), tiles: int = 1) -> DataFrame:
    """Euclidean distance or Pearson correlation between samples, zeros included."""
    by = list(by)
    dots = gram(expression, by, "gene_id", "sample_id", value, tiles)
    own = dots.where(F.col("col_i") == F.col("col_j")).select(*by, F.col("col_i").alias("s"), F.col("dot").alias("sq"))
    if metric == "correlation":
        totals = expression.groupBy(*by, F.col("sample_id").alias("s")).agg(F.sum(value).alias("sum"))
        genes = expression.select(*by, "gene_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("m"))
        own = own.join(totals, [*by, "s"]).join(genes, by)
    left = own.select(*by, *[F.col(c).alias(f"{c}_i") for c in own.columns if c not in by])
    right = own.select(*by, *[F.col(c).alias(f"{c}_j") for c in own.columns if c not in by])
    both = (
        mirrored(dots, by)
        .withColumnsRenamed({"col_i": "s_i", "col_j": "s_j"})
        .join(left, [*by, "s_i"])
        .join(right, [*by, "s_j"])
    )
    if metric == "distance":
        result = F.sqrt(F.greatest(F.lit(0.0), F.col("sq_i") + F.col("sq_j") - 2 * F.col("dot")))
    else:
        m = F.col("m_i")
        spread = F.sqrt(m * F.col("sq_i") - F.col("sum_i") ** 2) * F.sqrt(m * F.col("sq_j") - F.col("sum_j") ** 2)
        result = F.when(spread > 0, (m * F.col("dot") - F.col("sum_i") * F.col("sum_j")) / spread).otherwise(F.lit(0.0))
    same = F.lit(0.0 if metric == "distance" else 1.0)
    return both.select(
        *by,
        F.col("s_i").alias("sample_a"),
        F.col("s_j").alias("sample_b"),
        F.when(F.col("s_i") == F.col("s_j"), same).otherwise(result).alias(metric),
    )


def median_normalize(counts: DataFrame) -> DataFrame:
    """count / max(total, 1) x median total of the dataset."""
    totals = reuse(library_metrics(counts).select(*SAMPLE, "library_size"))
    middle = quantiles(totals, "library_size", ["dataset_id"], {"median_total": 0.5})
    return (
        counts.join(totals.join(middle, "dataset_id"), SAMPLE)
        .withColumn(
            "normalized",
            F.col("count") / F.greatest(F.col("library_size").cast("double"), F.lit(1.0)) * F.col("median_total"),
        )
        .select(*counts.columns, "normalized")
    )


def size_factors(counts: DataFrame) -> DataFrame:
    """Median over genes of count / geometric mean, with the way each factor was found.

    ``complete``: genes with any zero are skipped.  A dataset in which no gene is
    free of zeros takes ``positive`` instead: zeros count nothing in a gene's mean
    log, only positive counts enter the median, and the factors of the dataset
    are scaled to a geometric mean of one.  A sample without a positive count has
    the factor null and ``not_estimable``, so no sample is lost.
    """
    positive = counts.where(F.col("count") > 0)
    listed = counts.select(*SAMPLE).distinct()
    samples = listed.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("_n"))
    gene = (
        positive.groupBy("dataset_id", "gene_id")
        .agg(F.sum(F.log("count")).alias("_logs"), F.count(F.lit(1)).alias("_present"))
        .join(samples, "dataset_id")
        .withColumn("_whole", F.col("_present") == F.col("_n"))
    )
    gene = reuse(gene)
    kind = gene.groupBy("dataset_id").agg(F.max("_whole").alias("_complete"))
    used = gene.join(kind, "dataset_id").where(F.col("_whole") | ~F.col("_complete"))
    used = used.select("dataset_id", "gene_id", "_complete", (F.col("_logs") / F.col("_n")).alias("_mean_log"))
    # Small beside the counts where genes are complete; else one number for each positive count.
    ratios = reuse(
        positive.join(used, ["dataset_id", "gene_id"]).select(*SAMPLE, (F.log("count") - F.col("_mean_log")).alias("_ratio"))
    )
    middle = reuse(quantiles(ratios, "_ratio", SAMPLE, {"_m": 0.5}).select(*SAMPLE, "_m"))
    centre = middle.join(kind, "dataset_id").groupBy("dataset_id", "_complete").agg(F.avg("_m").alias("_centre"))
    log = F.col("_m") - F.when(F.col("_complete"), F.lit(0.0)).otherwise(F.col("_centre"))
    way = F.when(F.col("_m").isNull(), F.lit("not_estimable")).when(F.col("_complete"), F.lit("complete")).otherwise(F.lit("positive"))
    out = listed.join(middle, SAMPLE, "left").join(centre, "dataset_id", "left")
    return reuse(out.select(*SAMPLE, F.exp(log).alias("size_factor"), way.alias("size_method")))


def size_normalize(counts: DataFrame) -> DataFrame:
    """Counts by size factor; a sample without one keeps its rows, with null ``normalized``."""
    factors = size_factors(counts).drop("size_method")
    return counts.join(factors, SAMPLE).withColumn("normalized", F.col("count") / F.col("size_factor"))


def top_variance_genes(expression: DataFrame, value: str, n: int, by: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """The n genes of largest sample variance, absent entries counted as zero."""
    from countloom.operators.ranking import head_per_group

    by = list(by)
    samples = expression.select(*by, "sample_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    sums = expression.groupBy(*by, "gene_id").agg(F.sum(value).alias("_s"), F.sum(F.col(value) * F.col(value)).alias("_q"))
    var = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    ranked = sums.join(samples, by).select(*by, "gene_id", var.alias("variance"))
    return head_per_group(ranked, by, [F.col("variance").desc(), F.col("gene_id")], n)


def profile_matrix(entries: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per matrix from long text entries ``(gene_id, sample_id, value_text)``."""
    by = list(by)
    number = to_number("value_text")
    typed = entries.select(*by, "gene_id", "sample_id", number.alias("x"))
    per_entry = typed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("x").isNull()).alias("non_numeric"),
        F.count_if(F.col("x") < 0).alias("negative"),
        F.count_if(F.col("x").isNotNull() & ~is_integral("x")).alias("fractional"),
        F.count_if(F.col("x") != F.rint("x")).alias("inexact"),
        F.min("x").alias("minimum"),
        F.max("x").alias("maximum"),
        F.sum("x").alias("total"),
    )
    columns = typed.groupBy(*by, "sample_id").agg(F.sum("x").alias("s"), F.count("x").alias("n"))
    per_column = columns.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sample_columns"),
        F.min("s").alias("min_column_sum"),
        F.max("s").alias("max_column_sum"),
        F.min(F.when(F.col("s") != 0, F.col("s"))).alias("min_nonzero_sum"),
        F.max(F.when(F.col("s") != 0, F.col("s"))).alias("max_nonzero_sum"),
    )
    cells = typed.groupBy(*by, "gene_id", "sample_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x")).alias("s")
    )
    rows = cells.groupBy(*by, "gene_id").agg(F.max("n").alias("copies"), F.sum("s").alias("s"))
    per_row = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("genes"),
        F.count_if(F.col("copies") > 1).alias("duplicate_genes"),
        F.count_if(F.trim("gene_id") == "").alias("blank_genes"),
        F.count_if(F.col("s") == 0).alias("all_zero_genes"),
    )
    return per_entry.join(per_column, by).join(per_row, by)


def count_type(profile: DataFrame, label: str = "label") -> DataFrame:
    """What the values look like; the first matching rung of the ladder names it."""
    text = F.lower(F.coalesce(F.col(label), F.lit("")))
    hint = (
        F.when(text.contains("log2") | text.contains("log expression"), F.lit("log_transformed"))
        .when(text.contains("tpm"), F.lit("tpm"))
        .when(text.contains("fpkm"), F.lit("fpkm"))
        .when(text.contains("cpm"), F.lit("cpm"))
    )
    numeric = F.col("non_numeric") == 0
    whole = F.col("inexact") == 0
    negative = F.col("negative") > 0
    million = F.coalesce(
        (F.col("min_nonzero_sum") >= 900000.0) & (F.col("max_nonzero_sum") <= 1100000.0), F.lit(False)
    )
    log_like = numeric & ~whole & ~negative & (F.col("maximum") <= 100)
    kind = (
        F.when(hint.isNotNull(), hint)
        .when(million & ~whole, F.lit("tpm_or_cpm_likely"))
        .when(numeric & whole & ~negative, F.lit("raw_integer_counts"))
        .when(log_like, F.lit("log_transformed_likely"))
        .when(numeric, F.lit("non_integer_expression"))
        .otherwise(F.lit("unknown"))
    )
    return (
        profile.withColumn("count_type", kind)
        .withColumn("is_integer", bool_text(numeric & whole))
        .withColumn("has_negative", bool_text(negative))
        .withColumn("likely_log_transformed", bool_text(log_like))
        .withColumn("likely_normalized", bool_text(hint.isNotNull() | million | log_like))
    )


def looks_normalized(profile: DataFrame, policy: str) -> DataFrame:
    """Three different rules of thumb, kept apart by name.

    ``bulk``: label hint, every library near one million, or fractional values up
    to 100.  ``adapter``: fractional, or small values with a small total.
    ``small``: small values and small column sums.
    """
    fractional, negative = F.col("fractional") > 0, F.col("negative") > 0
    if policy == "bulk":
        text = F.lower(F.coalesce(F.col("label"), F.lit("")))
        hint = text.rlike("tpm|fpkm|cpm|log2|log_expression")
        million = (F.col("min_column_sum") >= 950000.0) & (F.col("max_column_sum") <= 1050000.0)
        rule = hint | (million & (F.col("non_numeric") == 0)) | (fractional & ~negative & (F.col("maximum") <= 100))
    elif policy == "adapter":
        rule = fractional | ((F.col("maximum") <= 50) & (F.col("total") <= 10000))
    elif policy == "small":
        rule = (F.col("maximum") <= 50) & (F.col("max_column_sum") <= 1000)
    else:
        raise ValueError(f"unknown policy: {policy}")
    return profile.withColumn("likely_normalized", F.coalesce(rule, F.lit(False)))
