"""Multi-study evidence: pooling, heterogeneity, leave-one-out, validation.

Evidence has one row per (keys, gene, dataset); a gene's group is therefore
never larger than the number of studies, and one shuffle on the gene serves
every pass (pooled effect, heterogeneity, random weights, final row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, finite, or_na, to_number
from countloom.functions.scores import interval_text
from countloom.functions.special import SMALLEST, beta_cdf_int, chi2_sf, norm_isf, two_sided_p
from countloom.operators.ranking import bh_adjust, normalized_rank
from countloom.session import reuse

METHODS = ("fixed_effect", "random_effects", "fisher", "weighted_stouffer", "robust_rank_aggregation")


def read_evidence(results: DataFrame, sizes: DataFrame | None = None, positive_se: bool = False) -> DataFrame:
    """Numeric, finite effect rows; the study size comes from the contrast QC table."""
    effect, se, p = (to_number(c) for c in ("log2FoldChange", "lfcSE", "pvalue"))
    out = results.withColumns({"log2FoldChange": effect, "lfcSE": se, "pvalue": p})
    out = out.where(F.col("log2FoldChange").isNotNull() & F.col("lfcSE").isNotNull() & F.col("pvalue").isNotNull())
    if positive_se:
        out = out.where(F.col("lfcSE") > 0)
    if sizes is not None:
        keys = [c for c in ("dataset_id", "contrast_id") if c in sizes.columns and c in out.columns]
        first = sizes.groupBy(*keys).agg(F.max(to_number("sample_count")).alias("sample_size"))
        out = out.drop("sample_size").join(first, keys)
    return out


def _valid(evidence: DataFrame) -> DataFrame:
    numbers = {c: finite(c) for c in ("log2FoldChange", "lfcSE", "pvalue")}
    size = F.greatest(F.lit(1.0), F.coalesce(finite("sample_size"), F.lit(1.0)))
    rows = evidence.withColumns({**numbers, "_weight_n": size})
    return rows.where((F.col("lfcSE") > 0) & F.col("log2FoldChange").isNotNull() & F.col("pvalue").isNotNull())


def pool(evidence: DataFrame, method: str, by: Sequence[str] = ("gene_id",), alpha: float = 0.05) -> DataFrame:
    """One row per gene (and extra keys) with the pooled effect and its p-value."""
    if method not in METHODS:
        raise ValueError(f"unsupported method: {method}")
    by = list(by)
    w = W.partitionBy(*by)
    rows = _valid(evidence)
    variance = F.col("lfcSE") * F.col("lfcSE")
    # Pass 1: fixed weights and the fixed effect, beside every study.
    rows = rows.withColumn("_wf", F.try_divide(F.lit(1.0), variance)).withColumns(
        {"_sw": F.sum("_wf").over(w), "_swe": F.sum(F.col("_wf") * F.col("log2FoldChange")).over(w),
         "_sww": F.sum(F.col("_wf") * F.col("_wf")).over(w), "_k": F.count(F.lit(1)).over(w)}
    )
    gap = F.col("log2FoldChange") - F.col("_swe") / F.col("_sw")
    # Pass 2: heterogeneity around it.
    rows = rows.withColumn("_q", F.sum(F.col("_wf") * gap * gap).over(w))
    df, room = F.col("_k") - 1, F.col("_sw") - F.col("_sww") / F.col("_sw")
    tau2 = F.when(room > 0, F.greatest(F.lit(0.0), (F.col("_q") - df) / room)).otherwise(F.lit(0.0))
    # Pass 3: random weights.
    rows = rows.withColumn("_tau2", tau2).withColumn("_wr", 1.0 / (variance + F.col("_tau2")))
    p = F.least(F.lit(1.0), F.greatest(F.lit(SMALLEST), F.col("pvalue")))
    extra: list[Column] = [F.lit(None).cast("double").alias("_x")]
    if method == "fisher":
        extra = [F.sum(F.log(p)).alias("_x")]
    elif method == "weighted_stouffer":
        z = norm_isf(F.greatest(p / 2.0, F.lit(SMALLEST))) * F.signum("log2FoldChange")
        extra = [(F.sum(F.sqrt("_weight_n") * z) / F.sqrt(F.sum("_weight_n"))).alias("_x")]
    elif method == "robust_rank_aggregation":
        place = F.row_number().over(w.orderBy("normalized_rank", "dataset_id"))
        rows = rows.withColumn("_cdf", beta_cdf_int("normalized_rank", place, F.col("_k")))
        extra = [F.least(F.lit(1.0), F.min("_cdf") * F.max("_k")).alias("_x")]
    detail = F.to_json(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("dataset_id"),
                        F.struct(
                            "lfcSE", "log2FoldChange", "pvalue",
                            F.coalesce(F.col("sample_size").cast("double"), F.lit(1.0)).alias("sample_size"),
                        ),
                    )
                )
            )
        )
    )
    up, down = F.min(F.signum("log2FoldChange")), F.max(F.signum("log2FoldChange"))
    symbol = F.col("gene_symbol") if "gene_symbol" in evidence.columns else F.lit("NA")
    table = rows.groupBy(*by).agg(
        F.min_by(or_na(symbol), "dataset_id").alias("gene_symbol"),
        F.max("_k").alias("n_studies"),
        (F.max("_swe") / F.max("_sw")).alias("_fixed"),
        F.sqrt(1.0 / F.max("_sw")).alias("_fixed_se"),
        (F.sum(F.col("_wr") * F.col("log2FoldChange")) / F.sum("_wr")).alias("_random"),
        F.sqrt(1.0 / F.sum("_wr")).alias("_random_se"),
        F.max("_q").alias("Q"),
        F.max("_tau2").alias("tau2"),
        F.when(up == 1.0, F.lit("consistent_up")).when(down == -1.0, F.lit("consistent_down")).otherwise(F.lit("mixed")).alias("direction_consistency"),
        F.count_if(F.col("pvalue") < alpha).alias("significant_study_count"),
        F.sum(F.coalesce(F.col("sample_size").cast("double"), F.lit(1.0)).cast("bigint")).alias("_subjects"),
        detail.alias("dataset_specific_effects"),
        *extra,
    )
    fixed = method == "fixed_effect"
    table = table.withColumns(
        {"pooled_log2fc": F.col("_fixed" if fixed else "_random"), "pooled_se": F.col("_fixed_se" if fixed else "_random_se")}
    )
    if method in ("fixed_effect", "random_effects"):
        meta_p = two_sided_p(F.col("pooled_log2fc") / F.col("pooled_se"))
    elif method == "fisher":
        meta_p = chi2_sf(-2.0 * F.col("_x"), 2 * F.col("n_studies"))
    elif method == "weighted_stouffer":
        meta_p = two_sided_p("_x")
    else:
        meta_p = F.col("_x")
    df = F.col("n_studies") - 1
    low, high = (F.col("pooled_log2fc") + sign * 1.96 * F.col("pooled_se") for sign in (-1, 1))
    return table.select(
        *by,
        "gene_symbol",
        "n_studies",
        "pooled_log2fc",
        "pooled_se",
        interval_text(low, high).alias("confidence_interval"),
        low.alias("ci_lower"),
        high.alias("ci_upper"),
        meta_p.alias("meta_pvalue"),
        "Q",
        F.when(df > 0, chi2_sf("Q", F.greatest(df, F.lit(1)))).otherwise(F.lit(1.0)).alias("Q_pvalue"),
        F.when((F.col("Q") > 0) & (df > 0), F.greatest(F.lit(0.0), (F.col("Q") - df) / F.col("Q")) * 100)
        .otherwise(F.lit(0.0))
        .alias("I2"),
        "tau2",
        "direction_consistency",
        "significant_study_count",
        "dataset_specific_effects",
        F.lit(method).alias("meta_model"),
        F.col("_subjects").alias("n_subjects"),
    )


def meta(
    evidence: DataFrame, method: str, alpha: float = 0.05, min_studies: int = 2, by: Sequence[str] = ()
) -> DataFrame:
    """Pooled table per family ``by``: rank, pool, keep enough studies, adjust what is kept."""
    by = list(by)
    rows = evidence
    if method == "robust_rank_aggregation":
        ranked = evidence.withColumn("_rank_p", F.coalesce(finite("pvalue"), F.lit(1.0)))
        rows = normalized_rank(ranked, [*by, "dataset_id"], "_rank_p", "gene_id").drop("_rank_p")
    pooled = pool(rows, method, [*by, "gene_id"], alpha).where(F.col("n_studies") >= min_studies)
    return bh_adjust(pooled, "meta_pvalue", by, out="meta_padj")


def sort_results(df: DataFrame, padj: str = "meta_padj") -> DataFrame:
    return df.orderBy(F.col(padj).asc_nulls_last(), "gene_id")


def leave_one_out(
    evidence: DataFrame, method: str, alpha: float = 0.05, min_studies: int = 2, change: float = 0.5, by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(stability per gene, detail per gene and left-out dataset) as one job, no loop.

    The row count grows by the number of datasets; adjustment and ranks are
    redone inside every subset because the left-out dataset joins the keys.
    """
    by = list(by)
    evidence = reuse(evidence)
    names = evidence.groupBy(*by).agg(F.array_sort(F.collect_set("dataset_id")).alias("_all"))
    # One row per family: a shuffle by family would put all its genes in one task, and the pooling after it.
    keyed = evidence.join(F.broadcast(names), by) if by else evidence.crossJoin(F.broadcast(names))
    subsets = keyed.withColumn("excluded_dataset", F.explode(F.array_except("_all", F.array("dataset_id")))).drop("_all")
    detail = meta(subsets, method, alpha, max(1, min_studies - 1), [*by, "excluded_dataset"]).select(
        *by,
        "gene_id",
        "excluded_dataset",
        "pooled_log2fc",
        "meta_pvalue",
        "meta_padj",
        bool_text(F.col("meta_padj") < alpha).alias("significant"),
    )
    full = meta(evidence, method, alpha, min_studies, by).select(
        *by, "gene_id", F.col("pooled_log2fc").alias("full_pooled_log2fc"), F.col("meta_padj").alias("full_meta_padj")
    )
    each = full.join(detail, [*by, "gene_id"], "left")
    seen = F.col("excluded_dataset").isNotNull()
    same_sign = F.signum("pooled_log2fc") == F.signum("full_pooled_log2fc")
    same_call = F.coalesce(F.col("meta_padj") < alpha, F.lit(False)) == F.coalesce(F.col("full_meta_padj") < alpha, F.lit(False))
    table = each.groupBy(*by, "gene_id", "full_pooled_log2fc", "full_meta_padj").agg(
        F.coalesce(F.bool_and(F.when(seen, same_sign)), F.lit(False)).alias("_sign"),
        F.coalesce(F.bool_and(F.when(seen, same_call)), F.lit(False)).alias("_call"),
        F.max(F.abs(F.col("pooled_log2fc") - F.col("full_pooled_log2fc"))).alias("max_effect_change"),
        F.count("excluded_dataset").alias("excluded_dataset_count"),
    )
    driven = ~F.col("_sign") | ~F.col("_call") | F.coalesce(F.col("max_effect_change") > change, F.lit(False))
    summary = table.select(
        *by,
        "gene_id",
        bool_text(driven).alias("dataset_driven"),
        bool_text(F.col("_sign")).alias("sign_stable"),
        bool_text(F.col("_call")).alias("significance_stable"),
        "max_effect_change",
        "full_pooled_log2fc",
        "full_meta_padj",
        "excluded_dataset_count",
    )
    return summary, detail


def significant_meta(results: DataFrame, alpha: float, abs_effect: float) -> DataFrame:
    return results.where((F.col("meta_padj") < alpha) & (F.abs("pooled_log2fc") >= abs_effect))


def _upward(effect: str) -> Column:
    # Zero counts as up here, unlike in the direction column of the pooled table.
    return F.col(effect) >= 0


def _paired(discovery: DataFrame, validation: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = ["pooled_log2fc", "pooled_se", "meta_pvalue", "meta_padj", "n_studies", "dataset_specific_effects"]
    first = discovery.select(*keys, "gene_symbol", *[F.col(n).alias(f"d_{n}") for n in names])
    second = validation.select(*keys, *[F.col(n).alias(f"v_{n}") for n in names])
    return first.join(second, list(keys), "left")


def stratified_validation(
    discovery: DataFrame, validation: DataFrame, method: str, alpha: float, replication_alpha: float,
    abs_effect: float, same_direction: bool = True, by: Sequence[str] = (),
) -> DataFrame:
    """Discovery candidates checked in held-out datasets; discovery never sees them."""
    keys = [*by, "gene_id"]
    both = _paired(meta(discovery, method, alpha, 1, by), meta(validation, method, replication_alpha, 1, by), keys)
    tested = F.col("v_n_studies").isNotNull()
    selected = F.coalesce((F.col("d_meta_padj") < alpha) & (F.abs("d_pooled_log2fc") >= abs_effect), F.lit(False))
    concordant = _upward("d_pooled_log2fc") == _upward("v_pooled_log2fc")
    confirmed = F.coalesce(F.col("v_meta_pvalue") < replication_alpha, F.lit(False))
    status = (
        F.when(~selected, F.lit("not_discovery_candidate"))
        .when(~tested, F.lit("not_tested_in_validation"))
        .when(F.lit(same_direction) & ~concordant, F.lit("direction_mismatch"))
        .when(~confirmed, F.lit("not_significant_in_validation"))
        .otherwise(F.lit("replicated"))
    )
    return both.select(
        *keys,
        "gene_symbol",
        F.col("d_pooled_log2fc").alias("discovery_effect"),
        F.col("d_pooled_se").alias("discovery_se"),
        F.col("d_meta_pvalue").alias("discovery_pvalue"),
        F.col("d_meta_padj").alias("discovery_padj"),
        F.col("d_n_studies").alias("discovery_n_studies"),
        bool_text(selected).alias("candidate_selected"),
        F.col("v_pooled_log2fc").alias("validation_effect"),
        F.col("v_pooled_se").alias("validation_se"),
        F.col("v_meta_pvalue").alias("validation_pvalue"),
        F.col("v_meta_padj").alias("validation_padj"),
        F.coalesce("v_n_studies", F.lit(0)).alias("validation_n_studies"),
        F.when(tested, bool_text(concordant)).otherwise(F.lit("NA")).alias("direction_concordance"),
        status.alias("replication_status"),
        F.col("d_dataset_specific_effects").alias("discovery_dataset_effects"),
        F.coalesce("v_dataset_specific_effects", F.lit("{}")).alias("validation_dataset_effects"),
    )


def pseudobulk_meta(evidence: DataFrame, method: str, alpha: float, min_studies: int) -> DataFrame:
    """Meta table per cell type, with datasets and subjects counted."""
    table = meta(evidence, method, alpha, min_studies, ["cell_type"])
    return table.select(
        "cell_type", "gene_id", "gene_symbol", "pooled_log2fc", "pooled_se", "meta_pvalue", "meta_padj", "I2",
        "direction_consistency", F.col("n_studies").alias("n_datasets"), "n_subjects", "dataset_specific_effects",
    )


def pseudobulk_validation(
    discovery: DataFrame, validation: DataFrame, method: str, alpha: float, min_studies: int, replication_alpha: float
) -> DataFrame:
    """Per cell type: replicated when concordant and p < alpha, candidate or not."""
    keys = ["cell_type", "gene_id"]
    both = _paired(
        meta(discovery, method, alpha, min_studies, ["cell_type"]),
        meta(validation, method, alpha, min_studies, ["cell_type"]),
        keys,
    )
    tested = F.col("v_n_studies").isNotNull()
    concordant = _upward("d_pooled_log2fc") == _upward("v_pooled_log2fc")
    replicated = tested & concordant & (F.col("v_meta_pvalue") < replication_alpha)
    return both.select(
        *keys,
        F.col("d_pooled_log2fc").alias("discovery_log2fc"),
        F.col("d_meta_padj").alias("discovery_padj"),
        F.col("v_pooled_log2fc").alias("validation_log2fc"),
        F.col("v_meta_pvalue").alias("validation_pvalue"),
        F.when(tested, bool_text(concordant)).otherwise(F.lit("NA")).alias("direction_consistency"),
        F.when(F.coalesce(replicated, F.lit(False)), F.lit("replicated")).otherwise(F.lit("not_replicated")).alias("replication_status"),
        F.col("d_dataset_specific_effects").alias("discovery_dataset_effects"),
        F.coalesce("v_dataset_specific_effects", F.lit("{}")).alias("validation_dataset_effects"),
    )


def results_manifest(results: DataFrame, significant: DataFrame, analysis_id: str, contrast_id: str, strategy: str, method: str, evidence: DataFrame) -> DataFrame:
    """One row saying what was pooled, from which datasets, with how many genes."""
    genes = results.agg(F.count(F.lit(1)).alias("gene_count"))
    hits = significant.agg(F.count(F.lit(1)).alias("significant_gene_count"))
    datasets = evidence.agg(F.concat_ws(";", F.array_sort(F.collect_set("dataset_id"))).alias("dataset_ids"))
    one = genes.crossJoin(hits).crossJoin(datasets)  # single rows
    return one.select(
        F.lit(analysis_id).alias("analysis_id"), F.lit(contrast_id).alias("contrast_id"),
        F.lit(strategy).alias("analysis_strategy"), F.lit(method).alias("meta_model"),
        "dataset_ids", "gene_count", "significant_gene_count",
    )
