"""Cell-type proportions per subject and their rank-sum test."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from countloom.functions.special import erfc_nonneg
from countloom.operators.ranking import bh_adjust, cumulative

EXACT_LIMIT = 8


def proportions(counts: DataFrame) -> DataFrame:
    """Share of each label among a subject's cells in a group."""
    keys = ["dataset_id", "subject_id", "group"]
    total = counts.groupBy(*keys).agg(F.sum("cell_count").alias("_t"))
    return counts.join(total, keys).withColumn("proportion", F.col("cell_count") / F.col("_t")).drop("_t")


def exact_rank_sum_p(n1: pd.Series, n2: pd.Series, u: pd.Series) -> pd.Series:
    """Two-sided exact p of U without ties; one sample has at most eight values."""

    def one(a: int, b: int, stat: float) -> float:
        a, b = min(a, b), max(a, b)
        counts = _rank_sum_counts(a, b)
        high = max(stat, a * b - stat)
        return min(1.0, 2.0 * counts[int(np.ceil(high)):].sum() / counts.sum())

    return pd.Series([one(int(a), int(b), float(s)) if a and b else np.nan for a, b, s in zip(n1, n2, u)])


def _rank_sum_counts(a: int, b: int) -> np.ndarray:
    """Ways to reach each U: coefficients of the Gaussian binomial (a+b choose a)."""
    poly = np.zeros(a * b + 1)
    poly[0] = 1.0
    for i in range(1, a + 1):
        up = poly.copy()
        up[b + i:] -= poly[: max(0, len(poly) - (b + i))]
        for j in range(i, len(up)):
            up[j] += up[j - i]
        poly = up
    return poly


def proportion_test(props: DataFrame, contrasts: DataFrame, plan: DataFrame) -> DataFrame:
    """Subject-level Mann-Whitney test per label, adjusted over the whole run."""
    used = plan.where(F.col("include") == "true").select("analysis_id", "dataset_id").distinct()
    on = contrasts.where((F.col("enabled") == "true") & (F.col("data_scope") == "cell_proportion")).select("analysis_id", "contrast_id", "numerator", "denominator")
    rows = props.join(used, "dataset_id").join(on, "analysis_id").where(F.col("group").isin(F.col("numerator"), F.col("denominator")))
    keys = ["dataset_id", "analysis_id", "contrast_id", "author_label", "numerator", "denominator"]
    up = F.col("group") == F.col("numerator")
    # Each distinct value with its size on either side: ranks, ties and U come from these.
    ranks = cumulative(rows, "proportion", keys, {"n": F.lit(1), "m": F.when(up, F.lit(1)).otherwise(F.lit(0)), "s": F.when(up, F.col("proportion")).otherwise(F.lit(0.0)), "a": F.col("proportion")})
    average = F.col("n_below") + (F.col("n") + 1) / 2.0
    n = F.col("n").cast("double")
    per = ranks.groupBy(*keys).agg(
        F.sum(F.col("m") * average).alias("_r1"), F.sum(n * n * n - n).alias("_ties"), F.max("m_total").alias("n1"), F.max("n_total").alias("_n"), F.max("n").alias("_copies"),
        F.sum("s").alias("_s1"), F.sum("a").alias("_sa"),
    ).withColumn("n0", F.col("_n") - F.col("n1")).where((F.col("n1") > 0) & (F.col("n0") > 0))
    n1, n0, total = F.col("n1").cast("double"), F.col("n0").cast("double"), F.col("_n").cast("double")
    u = F.col("_r1") - n1 * (n1 + 1) / 2.0
    per = per.withColumn("u", u)
    sd = F.sqrt(n1 * n0 / 12.0 * (total + 1 - F.try_divide(F.col("_ties"), total * (total - 1))))
    z = F.try_divide(F.greatest(F.col("u"), n1 * n0 - F.col("u")) - n1 * n0 / 2.0 - 0.5, sd)
    normal = F.when(z > 0, erfc_nonneg(z / float(np.sqrt(2.0)))).otherwise(F.lit(1.0))
    exact = (F.least("n1", "n0") <= EXACT_LIMIT) & (F.col("_copies") == 1)
    small = per.where(exact).withColumn("pvalue", pandas_udf(exact_rank_sum_p, "double")("n1", "n0", "u"))
    large = per.where(~exact).withColumn("pvalue", F.least(F.lit(1.0), normal))
    scored = small.unionByName(large)
    return bh_adjust(scored, "pvalue", small=True).select(  # one row per label and contrast
        *keys, F.col("n1").alias("numerator_subjects"), F.col("n0").alias("denominator_subjects"), (F.col("_s1") / n1).alias("numerator_mean_proportion"), ((F.col("_sa") - F.col("_s1")) / n0).alias("denominator_mean_proportion"),
        (F.col("_s1") / n1 - (F.col("_sa") - F.col("_s1")) / n0).alias("proportion_difference"), "pvalue", "padj", F.lit("subject_level_mann_whitney_u").alias("test"))
