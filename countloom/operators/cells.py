"""Cell-level quality control on triplets ``(cell_id, gene_id, count)``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, or_na
from countloom.functions.scores import complexity, percent
from countloom.functions.text import gene_mask, joined_or, kept
from countloom.operators.counts import NORMAL_MAD
from countloom.operators.ranking import quantiles
from countloom.session import reuse

METRICS = ("total_counts", "n_genes_by_counts", "pct_counts_mt", "pct_counts_ribo", "pct_counts_hb", "complexity")
# Which bounds a metric has (hard setting names; robust lower, robust upper).
BOUNDS = {
    "total_counts": ("min_counts", "max_counts", True, True),
    "n_genes_by_counts": ("min_genes", "max_genes", True, True),
    "pct_counts_mt": (None, "max_pct_mt", False, True),
    "pct_counts_ribo": (None, "max_pct_ribo", False, True),
    "pct_counts_hb": (None, "max_pct_hb", False, True),
    "complexity": ("min_complexity", None, True, False),
}


def cell_totals(cells: DataFrame, cell_counts: DataFrame) -> DataFrame:
    """Per cell: its identity, total count and number of genes above zero."""
    sums = cell_counts.groupBy("cell_id").agg(
        F.sum("count").alias("total_counts"), F.count_if(F.col("count") > 0).alias("detected_genes")
    )
    return cells.join(sums, "cell_id")


def sample_cell_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("dataset_id", "sample_id", "subject_id", "group").agg(F.count(F.lit(1)).alias("cell_count"))


def normalize_genes(genes: DataFrame, genome_build: str | None = None) -> DataFrame:
    """Original and canonical id, symbol, build and mapping status, with fallbacks."""
    have = set(genes.columns)
    original = F.col("gene_id_original") if "gene_id_original" in have else F.col("gene_id")
    if "gene_id_canonical" in have:
        canonical = F.col("gene_id_canonical")
        status = F.col("mapping_status") if "mapping_status" in have else F.lit("provided")
    else:
        canonical, status = original, F.lit("identity")
    symbol = next((F.col(c) for c in ("gene_symbol", "gene_symbols", "symbol") if c in have), original)
    return genes.select(
        original.cast("string").alias("gene_id_original"),
        canonical.cast("string").alias("gene_id_canonical"),
        symbol.cast("string").alias("gene_symbol"),
        F.lit(genome_build or "unknown").alias("reference_build"),
        status.cast("string").alias("mapping_status"),
    )


def cell_qc(cells: DataFrame, cell_counts: DataFrame, genes: DataFrame, prefixes: dict[str, Sequence[str]]) -> DataFrame:
    """Totals, genes, marker-gene shares and complexity; empty cells are kept with zeros."""
    names = {"mt": "mitochondrial", "ribo": "ribosomal", "hb": "hemoglobin"}
    masks = genes.select(
        F.col("gene_id"),
        *[gene_mask("gene_symbol", "gene_id", prefixes.get(long, ())).alias(f"_{short}") for short, long in names.items()],
    ).where(" OR ".join(f"_{short}" for short in names))
    marked = cell_counts.join(masks, "gene_id", "left")
    sums = marked.groupBy("cell_id").agg(
        F.sum("count").alias("total_counts"),
        F.count_if(F.col("count") > 0).alias("n_genes_by_counts"),
        *[F.sum(F.when(F.col(f"_{short}"), F.col("count")).otherwise(0)).alias(f"_{short}_sum") for short in names],
    )
    out = cells.join(sums, "cell_id", "left").na.fill(0, [c for c in sums.columns if c != "cell_id"])
    shares = [percent(f"_{short}_sum", "total_counts").alias(f"pct_counts_{short}") for short in names]
    return out.select(
        *cells.columns, "total_counts", "n_genes_by_counts", *shares,
        complexity("n_genes_by_counts", "total_counts").alias("complexity"),
    )


def qc_thresholds(qc: DataFrame, cfg: dict) -> DataFrame:
    """One row per (sample, metric): hard, robust and effective bounds.

    ``cfg``: ``strategy`` hard | mad | combined, ``hard`` {setting: value},
    ``mad`` {enabled, min_cells, lower_n_mads, upper_n_mads, metrics}.
    """
    strategy, hard, mad = cfg["strategy"], cfg["hard"], cfg["mad"]
    qc = reuse(qc.select("sample_id", *METRICS))
    long = qc.select(
        "sample_id", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in METRICS])).alias("_m")
    ).select("sample_id", "_m.metric", "_m.x")
    keys = ["sample_id", "metric"]
    sizes = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    use_mad = mad["enabled"] and strategy in ("mad", "combined")
    if mad["enabled"]:
        listed = long.where(F.col("metric").isin(*mad["metrics"]))
        center = quantiles(listed, "x", keys, {"_median": 0.5})
        spread = listed.join(center, keys).select(*keys, F.abs(F.col("x") - F.col("_median")).alias("_dev"))
        width = quantiles(spread, "_dev", keys, {"_mad": 0.5})
        sizes = sizes.join(center, keys, "left").join(width, keys, "left")
    else:
        sizes = sizes.withColumns({"_median": F.lit(None).cast("double"), "_mad": F.lit(None).cast("double")})
    applied = F.lit(bool(mad["enabled"])) & (F.col("_n") >= int(mad["min_cells"])) & F.col("_mad").isNotNull()
    scale = F.col("_mad") / NORMAL_MAD
    bounded = applied & (F.col("_mad") > 0)
    low = F.when(bounded, F.col("_median") - float(mad["lower_n_mads"]) * scale).when(applied, F.lit(float("-inf")))
    high = F.when(bounded, F.col("_median") + float(mad["upper_n_mads"]) * scale).when(applied, F.lit(float("inf")))

    def setting(place: int) -> Column:
        value = F.lit(None).cast("double")
        for metric, bounds in BOUNDS.items():
            name = bounds[place]
            if name is not None and hard.get(name) is not None:
                value = F.when(F.col("metric") == metric, F.lit(float(hard[name]))).otherwise(value)
        return value

    def robust(place: int) -> Column:
        return F.col("metric").isin(*[m for m, b in BOUNDS.items() if b[place]])

    def nothing() -> Column:
        return F.lit(None).cast("double")

    use_hard = strategy in ("hard", "combined")
    out = sizes.withColumns(
        {"hard_lower": setting(0), "hard_upper": setting(1), "mad_lower": low, "mad_upper": high, "mad_applied": applied}
    )
    lower = F.greatest(F.col("hard_lower") if use_hard else nothing(), F.when(robust(2), F.col("mad_lower")) if use_mad else nothing())
    upper = F.least(F.col("hard_upper") if use_hard else nothing(), F.when(robust(3), F.col("mad_upper")) if use_mad else nothing())
    return out.select(
        *keys, F.lit(strategy).alias("strategy"), "hard_lower", "hard_upper", "mad_lower", "mad_upper",
        F.coalesce(lower, F.lit(float("-inf"))).alias("effective_lower"),
        F.coalesce(upper, F.lit(float("inf"))).alias("effective_upper"),
        "mad_applied",
    )


def apply_qc(qc: DataFrame, thresholds: DataFrame, exclude_doublets: bool = False) -> DataFrame:
    """Adds ``qc_retained`` and ``filter_reason`` (failed metrics in fixed order)."""
    limits = thresholds.groupBy("sample_id").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(f"effective_{side}"))).alias(f"_{m}_{side}") for m in METRICS for side in ("lower", "upper")]
    )
    failed = [((F.col(m) < F.col(f"_{m}_lower")) | (F.col(m) > F.col(f"_{m}_upper")), m) for m in METRICS]
    if exclude_doublets:
        failed.append((F.coalesce(F.col("predicted_doublet"), F.lit(False)), "predicted_doublet"))
    out = qc.join(limits, "sample_id").withColumn("_reasons", kept(*failed))
    return out.select(
        *qc.columns,
        (F.size("_reasons") == 0).alias("qc_retained"),
        joined_or(F.col("_reasons"), "pass").alias("filter_reason"),
    )


def ambient_score(cells: DataFrame, cell_counts: DataFrame, q: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """(score per cell, status per sample): overlap with the profile of the emptiest cells."""
    totals = cell_counts.groupBy("cell_id").agg(F.sum("count").alias("_total"))
    placed = reuse(cells.select("cell_id", "sample_id").join(totals, "cell_id", "left").na.fill(0, ["_total"]))
    cutoff = quantiles(placed, "_total", ["sample_id"], {"_cut": q})
    low = placed.join(cutoff, "sample_id").where(F.col("_total") <= F.col("_cut")).select("cell_id", "sample_id")
    background = cell_counts.join(low, "cell_id").groupBy("sample_id", "gene_id").agg(F.sum("count").alias("_b"))
    mass = background.groupBy("sample_id").agg(F.sum("_b").alias("_mass"))
    profile = background.join(mass, "sample_id").where(F.col("_mass") > 0).select(
        "sample_id", "gene_id", (F.col("_b") / F.col("_mass")).alias("_share")
    )
    overlap = (
        cell_counts.join(placed, "cell_id")
        .join(profile, ["sample_id", "gene_id"])
        .groupBy("cell_id")
        .agg(F.sum(F.col("count") / F.greatest(F.col("_total"), F.lit(1)) * F.col("_share")).alias("_overlap"))
    )
    ready = F.coalesce(F.col("_mass"), F.lit(0)) > 0
    status = placed.groupBy("sample_id").agg(F.count(F.lit(1)).alias("cell_count")).join(mass, "sample_id", "left").select(
        "sample_id", F.lit("low_count_profile").alias("method"), "cell_count",
        F.when(ready, F.lit("completed")).otherwise(F.lit("not_estimable_zero_background")).alias("status"),
    )
    scores = placed.join(overlap, "cell_id", "left").join(mass, "sample_id", "left").select(
        "cell_id", F.when(ready, F.coalesce("_overlap", F.lit(0.0))).alias("ambient_rna_score")
    )
    return scores, status


def run_detector(cells: DataFrame, cell_counts: DataFrame, detector: Callable[[pd.DataFrame, str], pd.DataFrame]) -> DataFrame:
    """User hook: one call per sample with its triplets, returning scores per cell.

    The caller's function sees one sample at a time, so it is only for samples
    that fit a task; ``doublet_score`` is the distributed default.
    """
    rows = cells.select("cell_id", "sample_id").join(cell_counts, "cell_id")
    kind = cells.schema["cell_id"].dataType.simpleString()
    schema = f"cell_id {kind}, doublet_score double, predicted_doublet boolean"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return detector(pdf, str(key[0]))

    return rows.groupBy("sample_id").applyInPandas(run, schema)


def preprocess_summary(qc: DataFrame) -> DataFrame:
    """Per sample: input, retained and doublet cells; failed when nothing is retained."""
    doublet = F.col("predicted_doublet") if "predicted_doublet" in qc.columns else F.lit(False)
    return qc.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("input_cells"),
        F.count_if(F.col("qc_retained")).alias("retained_cells"),
        F.count_if(doublet).alias("predicted_doublets"),
    ).withColumn("failed", F.col("retained_cells") == 0)


def preprocess_qc(
    cells: DataFrame, cell_counts: DataFrame, genes: DataFrame, cfg: dict, doublets: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Metrics, doublets, ambient score, thresholds, reasons and the sample summary."""
    qc = cell_qc(cells, cell_counts, genes, cfg["gene_prefixes"])
    scores, status = ambient_score(cells, cell_counts, cfg.get("low_count_quantile", 0.1))
    qc = qc.join(scores, "cell_id", "left")
    if doublets is not None:
        qc = qc.join(doublets, "cell_id", "left")
    qc = reuse(qc)
    thresholds = reuse(qc_thresholds(qc, cfg))
    judged = apply_qc(qc, thresholds, cfg.get("exclude_predicted", False) and doublets is not None)
    return {"cell_qc": judged, "thresholds": thresholds, "sample_summary": preprocess_summary(judged), "ambient_status": status}


def cell_type_metrics(cells: DataFrame) -> DataFrame:
    """Retained cells per (dataset, sample, subject, label)."""
    rows = cells.where("qc_retained") if "qc_retained" in cells.columns else cells
    return rows.groupBy("dataset_id", "sample_id", "subject_id", "author_label").agg(F.count(F.lit(1)).alias("cell_count"))


def composition(cells: DataFrame, cluster: str = "cluster") -> tuple[DataFrame, DataFrame]:
    """(cells and share per cluster and sample, cells per cluster and label)."""
    by_sample = cells.groupBy(cluster, "sample_id").agg(F.count(F.lit(1)).alias("cell_count"))
    totals = by_sample.groupBy(cluster).agg(F.sum("cell_count").alias("_total"))
    shares = by_sample.join(totals, cluster).select(
        cluster, "sample_id", "cell_count", (F.col("cell_count") / F.col("_total")).alias("cluster_fraction")
    )
    labels = cells.groupBy(cluster, "author_label").agg(F.count(F.lit(1)).alias("author_label_cells"))
    return shares, labels


def log_normalize(cell_counts: DataFrame, target: float = 10000.0) -> DataFrame:
    """log1p of counts scaled to the same total per cell; zeros stay absent."""
    totals = cell_counts.groupBy("cell_id").agg(F.sum("count").alias("_total"))
    return cell_counts.join(totals, "cell_id").where(F.col("_total") > 0).select(
        "cell_id", "gene_id", F.log1p(F.col("count") / F.col("_total") * target).alias("value")
    )


def refuse(bad: DataFrame, what: str) -> None:
    """Raise when ``bad`` has a row, naming the first of them."""
    first = bad.limit(1).collect()
    if first:
        raise ValueError(f"{what}, for example {first[0].asDict()}")


def map_ontology(cells: DataFrame, ontology: DataFrame) -> DataFrame:
    """Confirmed (dataset, label) mapping; three harmonised levels, null when unmapped.

    A label confirmed more than once is refused: it would multiply its cells.
    """
    keys = ["dataset_id", "author_label"]
    levels = ["harmonized_level1", "harmonized_level2", "harmonized_level3"]
    confirmed = ontology.where(F.col("review_status") == "confirmed").select(*keys, *levels)
    refuse(confirmed.groupBy(*keys).count().where("count > 1"), "labels confirmed more than once")
    return cells.join(confirmed, keys, "left")


def unmapped_labels(cells: DataFrame, ontology: DataFrame) -> DataFrame:
    keys = ["dataset_id", "author_label"]
    confirmed = ontology.where(F.col("review_status") == "confirmed").select(*keys)
    return cells.select(*keys).distinct().join(confirmed, keys, "left_anti")


def attach_samples(cells: DataFrame, samples: DataFrame) -> DataFrame:
    """Reviewed sample fields copied to cells; the id becomes dataset:sample:barcode.

    Cells of unknown samples, and sample ids that are reviewed twice, are refused.
    """
    refuse(samples.groupBy("sample_id").count().where("count > 1"), "sample ids that are not unique")
    refuse(cells.select("sample_id").distinct().join(samples, "sample_id", "left_anti"), "cells of unknown samples")
    extra = [c for c in samples.columns if c not in cells.columns]
    joined = cells.join(samples.select("sample_id", *extra), "sample_id")
    return joined.withColumn("cell_id", F.concat_ws(":", "dataset_id", "sample_id", or_na("barcode")))


def lookup_once(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows with the one matching right row; ``match_count`` other than 1 is an error."""
    keys = list(keys)
    rest = [c for c in right.columns if c not in keys]
    one = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("match_count"), *[F.min(c).alias(c) for c in rest])
    joined = left.join(one, keys, "left").withColumn("match_count", F.coalesce("match_count", F.lit(0)))
    single = F.col("match_count") == 1
    return joined.select(*left.columns, *[F.when(single, F.col(c)).alias(c) for c in rest], "match_count", single.alias("matched"))


def identity_conflicts(cells_long: DataFrame) -> DataFrame:
    """Cell ids that carry more than one identity in a long single-cell table."""
    identity = ["dataset_id", "sample_id", "subject_id", "group", "cell_type"]
    known = [c for c in identity if c in cells_long.columns]
    return (
        cells_long.groupBy("cell_id", *known).agg(F.lit(1).alias("_one"))
        .groupBy("cell_id").agg(F.count(F.lit(1)).alias("identities")).where(F.col("identities") > 1)
    )


def pass_text(flag: str | Column) -> Column:
    return bool_text(F.col(flag) if isinstance(flag, str) else flag)
