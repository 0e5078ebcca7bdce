"""Registered queries: bulk count matrices in long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions.missing import is_integral
from countloom.operators import counts as C
from countloom.operators import joins as J
from countloom.operators import testing as T
from countloom.plans.meta_queries import bh_sql
from countloom.plans.registry import Registry, rounded
from countloom.plans.views import Views, sql, two_sided_sql

queries = Registry()

# --- metrics and sample QC -------------------------------------------------

LIBRARY = "SELECT dataset_id, sample_id, sum(count)::bigint AS library_size, sum((count >= 1)::int)::bigint AS detected_genes FROM counts GROUP BY ALL"
queries.add("library_metrics", lambda v: C.library_metrics(v.counts()), sql("counts", LIBRARY))


def z_sql(value: str, by: str, source: str) -> str:
    """MAD-scaled z with the plain z and then zero as fallbacks."""
    return f"""SELECT s.*, CASE WHEN mad > 0 THEN 0.6744897501960817::double * ({value} - med) / mad WHEN sd > 0 THEN ({value} - mean) / sd ELSE 0.0::double END AS z_{value}
      FROM {source} s JOIN (SELECT {by}, median(abs({value} - med)) AS mad, any_value(med) AS med, avg({value}) AS mean, stddev_pop({value}) AS sd
        FROM (SELECT *, median({value}) OVER (PARTITION BY {by}) AS med FROM {source}) GROUP BY {by}) m USING ({by})"""


QC = ["dataset_id", "sample_id", "library_size", "detected_genes", "library_size_robust_z", "detected_genes_robust_z",
      "outlier_flag", "flagged_metrics", "retained_for_analysis", "required_action"]
QC_SQL = """SELECT dataset_id, sample_id, library_size, detected_genes, round(z_loglib, 6) AS library_size_robust_z, round(z_dg, 6) AS detected_genes_robust_z,
  CASE WHEN abs(z_loglib) >= {z} OR abs(z_dg) >= {z} THEN 'true' ELSE 'false' END AS outlier_flag,
  CASE WHEN abs(z_loglib) >= {z} AND abs(z_dg) >= {z} THEN 'library_size;detected_genes' WHEN abs(z_loglib) >= {z} THEN 'library_size'
       WHEN abs(z_dg) >= {z} THEN 'detected_genes' ELSE 'none' END AS flagged_metrics, 'true' AS retained_for_analysis,
  CASE WHEN abs(z_loglib) >= {z} OR abs(z_dg) >= {z} THEN 'user_review_manifest' ELSE 'none' END AS required_action FROM zz"""
queries.add(
    "sample_metrics_qc",
    lambda v: rounded(C.sample_metrics_qc(v.counts(), z=1.5).select(*QC), "library_size_robust_z", "detected_genes_robust_z"),
    sql("counts", QC_SQL.format(z=1.5), lib=LIBRARY, l2="SELECT *, log10(library_size + 1) AS loglib, detected_genes::double AS dg FROM lib",
        z1=z_sql("loglib", "dataset_id", "l2"), zz=z_sql("dg", "dataset_id", "z1")),
)
queries.add(
    "robust_z_library_size",
    lambda v: rounded(C.robust_z(C.library_metrics(v.counts()), ["library_size"], ["dataset_id"]).select("sample_id", "library_size_robust_z"), "library_size_robust_z"),
    sql("counts", "SELECT sample_id, round(z_ls, 6) AS library_size_robust_z FROM zz", lib=LIBRARY,
        l2="SELECT *, library_size::double AS ls FROM lib", zz=z_sql("ls", "dataset_id", "l2")),
)
queries.add(
    "sample_qc",
    lambda v: rounded(C.sample_qc(v.counts("year"), v.samples("year"), z=2.0), "library_size_robust_z", "detected_genes_robust_z", "pca_distance_robust_z", "pca_distance"),
)
queries.add("sample_pca", lambda v: rounded(C.sample_pca(v.counts("year"), 5), *[f"PC{i}" for i in range(1, 6)], digits=4))

LOGX = "SELECT dataset_id, gene_id, sample_id, log2(count + 1) AS x FROM counts_year"
SQ = "SELECT dataset_id, sample_id, sum(x) AS s, sum(x * x) AS q FROM lx GROUP BY ALL"
DOT = "SELECT a.dataset_id, a.sample_id AS i, b.sample_id AS j, sum(a.x * b.x) AS d FROM lx a JOIN lx b ON a.dataset_id = b.dataset_id AND a.gene_id = b.gene_id GROUP BY ALL"


def _logx(v: Views):
    return v.counts("year").select("dataset_id", "gene_id", "sample_id", F.log2(F.col("count") + 1).alias("x"))


queries.add(
    "sample_distance",
    lambda v: rounded(C.sample_pairs(_logx(v), "x", "distance"), "distance", digits=5),
    sql("counts_year", """SELECT a.dataset_id, a.sample_id AS sample_a, b.sample_id AS sample_b,
        round(CASE WHEN a.sample_id = b.sample_id THEN 0.0 ELSE sqrt(greatest(0.0, a.q + b.q - 2 * coalesce(d, 0))) END, 5) AS distance
        FROM sq a JOIN sq b ON a.dataset_id = b.dataset_id LEFT JOIN dots ON dots.i = a.sample_id AND dots.j = b.sample_id""", lx=LOGX, sq=SQ, dots=DOT),
)
queries.add(
    "sample_correlation",
    lambda v: rounded(C.sample_pairs(_logx(v), "x", "correlation"), "correlation"),
    sql("counts_year", """SELECT a.dataset_id, a.sample_id AS sample_a, b.sample_id AS sample_b, round(CASE WHEN a.sample_id = b.sample_id THEN 1.0
        ELSE (m * coalesce(d, 0) - a.s * b.s) / (sqrt(m * a.q - a.s * a.s) * sqrt(m * b.q - b.s * b.s)) END, 6) AS correlation
        FROM sq a JOIN sq b ON a.dataset_id = b.dataset_id JOIN (SELECT dataset_id, count(DISTINCT gene_id) AS m FROM lx GROUP BY ALL) g ON g.dataset_id = a.dataset_id
        LEFT JOIN dots ON dots.i = a.sample_id AND dots.j = b.sample_id""", lx=LOGX, sq=SQ, dots=DOT),
)

# --- normalisation ---------------------------------------------------------

queries.add(
    "median_total_normalize",
    lambda v: rounded(C.median_normalize(v.counts()), "normalized"),
    sql("counts", """SELECT c.*, round(count / greatest(library_size::double, 1.0) * mt, 6) AS normalized FROM counts c JOIN lib USING (dataset_id, sample_id)
        JOIN (SELECT dataset_id, median(library_size) AS mt FROM lib GROUP BY ALL) USING (dataset_id)""".replace("SELECT c.*", "SELECT dataset_id, gene_id, sample_id, count"), lib=LIBRARY),
)
SIZE = {
    "ns": "SELECT dataset_id, count(DISTINCT sample_id) AS ns FROM counts_nation GROUP BY ALL",
    "fullgenes": "SELECT dataset_id, gene_id, avg(ln(count)) AS ml, count(*) AS k FROM counts_nation GROUP BY ALL",
    "sf": """SELECT dataset_id, sample_id, exp(median(ln(count) - ml)) AS size_factor FROM counts_nation JOIN fullgenes USING (dataset_id, gene_id)
        JOIN ns USING (dataset_id) WHERE k = ns GROUP BY ALL""",
}
queries.add(
    "size_factors",
    lambda v: rounded(C.size_factors(v.counts("nation")), "size_factor").drop("size_method"),
    sql("counts_nation", "SELECT dataset_id, sample_id, round(size_factor, 6) AS size_factor FROM sf", **SIZE),
)
# No part is shipped from every nation of a region in every year, so the factors come from positive counts.
queries.add(
    "size_factors_sparse",
    lambda v: rounded(C.size_factors(v.counts("year")), "size_factor"),
    sql("counts_year", """SELECT dataset_id, sample_id, round(exp(m - avg(m) OVER (PARTITION BY dataset_id)), 6) AS size_factor, 'positive' AS size_method FROM (SELECT dataset_id, sample_id, median(ln(count) - ml) AS m FROM counts_year
        JOIN (SELECT dataset_id, gene_id, sum(ln(count)) / max(n) AS ml FROM counts_year JOIN (SELECT dataset_id, count(DISTINCT sample_id) AS n FROM counts_year GROUP BY 1) USING (dataset_id) WHERE count > 0 GROUP BY ALL) USING (dataset_id, gene_id) WHERE count > 0 GROUP BY ALL)"""),
)
queries.add(
    "size_normalize",
    lambda v: rounded(C.size_normalize(v.counts("nation")), "size_factor", "normalized"),
    sql("counts_nation", "SELECT dataset_id, gene_id, sample_id, count, round(size_factor, 6) AS size_factor, round(count / size_factor, 6) AS normalized FROM counts_nation JOIN sf USING (dataset_id, sample_id)", **SIZE),
)
queries.add(
    "low_count_filter",
    lambda v: C.filter_low_counts(v.counts(), 150),
    sql("counts", "SELECT dataset_id, gene_id, sample_id, count FROM counts JOIN (SELECT dataset_id, gene_id FROM counts GROUP BY ALL HAVING sum(count) >= 150) USING (dataset_id, gene_id)"),
)
queries.add(
    "top_variance_genes",
    lambda v: rounded(C.top_variance_genes(v.counts("nation"), "count", 100), "variance"),
    sql("counts_nation", """SELECT dataset_id, gene_id, round(variance, 6) AS variance FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY variance DESC, gene_id) AS rn
        FROM (SELECT dataset_id, gene_id, (sum(count * count)::double - sum(count)::double * sum(count)::double / max(ns)) / (max(ns) - 1) AS variance FROM counts_nation JOIN ns USING (dataset_id) GROUP BY dataset_id, gene_id)) WHERE rn <= 100""", ns=SIZE["ns"]),
)

# --- tests -----------------------------------------------------------------

EFFECT = ["baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue", "padj"]


def _two_group(v: Views):
    return T.two_group_test(v.counts("nation"), v.samples("nation"), "case", "control")


SCALED = {
    **SIZE,
    "scaled": "SELECT c.*, count / size_factor AS x, size_factor AS f, \"group\" AS g FROM counts_nation c JOIN sf USING (dataset_id, sample_id) JOIN samples_nation USING (dataset_id, sample_id)",
    "sizes": """SELECT dataset_id, sum((g = 'case')::int) AS n1, sum((g = 'control')::int) AS n0, avg(CASE WHEN g = 'case' THEN 1 / f END) AS r1, avg(CASE WHEN g = 'control' THEN 1 / f END) AS r0
        FROM (SELECT DISTINCT dataset_id, sample_id, g, f FROM scaled) GROUP BY ALL""",
    "sums": """SELECT dataset_id, gene_id, sum(CASE WHEN g = 'case' THEN x ELSE 0 END) AS s1, sum(CASE WHEN g = 'case' THEN x * x ELSE 0 END) AS q1,
        sum(CASE WHEN g = 'control' THEN x ELSE 0 END) AS s0, sum(CASE WHEN g = 'control' THEN x * x ELSE 0 END) AS q0 FROM scaled GROUP BY ALL""",
    "p1": "SELECT *, s1 / n1 AS m1, s0 / n0 AS m0, (s1 + s0) / (n1 + n0) AS bm FROM sums JOIN sizes USING (dataset_id)",
    "p2": """SELECT *, greatest(1e-8::double, (((q1 - s1 * m1) + (q0 - s0 * m0)) / (n1 + n0 - 2) - bm * (n1 * r1 + n0 * r0) / (n1 + n0)) / (bm * bm)) AS a FROM p1""",
    "p3": """SELECT dataset_id, gene_id, bm AS baseMean, log2((m1 + 0.5) / (m0 + 0.5)) AS log2FoldChange,
        sqrt((m1 * r1 + a * m1 * m1) / n1 / ((m1 + 0.5) * (m1 + 0.5)) + (m0 * r0 + a * m0 * m0) / n0 / ((m0 + 0.5) * (m0 + 0.5))) / ln(2.0::double) AS lfcSE, n1 + n0 AS sample_size FROM p2""",
    "p4": f"SELECT *, log2FoldChange / lfcSE AS stat, {two_sided_sql('log2FoldChange / lfcSE')} AS pvalue FROM p3",
    "effects": bh_sql("p4", "pvalue", "dataset_id", "padj"),
}
ALL_EFFECT = ", ".join(f"round({c}, 6) AS {c}" for c in EFFECT)
queries.add(
    "two_group_test",
    lambda v: rounded(_two_group(v), *EFFECT).drop("sample_size"),
    sql("counts_nation samples_nation", f"SELECT dataset_id, gene_id, {ALL_EFFECT} FROM effects", **SCALED),
)
queries.add(
    "significant_genes",
    lambda v: T.significant(_two_group(v), 0.5, 0.5).select("dataset_id", "gene_id"),
    sql("counts_nation samples_nation", "SELECT dataset_id, gene_id FROM effects WHERE padj < 0.5 AND abs(log2FoldChange) >= 0.5", **SCALED),
)
queries.add(
    "volcano_table",
    lambda v: rounded(T.volcano(_two_group(v), 0.5, 0.5).select("dataset_id", "gene_id", "significant", "minus_log10_padj"), "minus_log10_padj"),
    sql("counts_nation samples_nation", """SELECT dataset_id, gene_id, padj < 0.5 AND abs(log2FoldChange) >= 0.5 AS significant,
        round(-log10(greatest(padj, 2.2250738585072014e-308::double)), 6) + 0.0 AS minus_log10_padj FROM effects""", **SCALED),
)
queries.add(
    "direction_summary",
    lambda v: rounded(T.direction_summary(_two_group(v), ["dataset_id"], 0.9, 0.2), "median_significant_log2fc"),
    sql("counts_nation samples_nation", """SELECT dataset_id, count(*) AS tested_genes, count(*) FILTER (WHERE c) AS significant_genes, count(*) FILTER (WHERE c AND log2FoldChange > 0) AS up_genes,
        count(*) FILTER (WHERE c AND log2FoldChange < 0) AS down_genes, round(median(log2FoldChange) FILTER (WHERE c), 6) AS median_significant_log2fc
        FROM (SELECT *, padj < 0.9 AND abs(log2FoldChange) >= 0.2 AS c FROM effects) GROUP BY ALL""", **SCALED),
)
queries.add(
    "top_genes_heatmap",
    lambda v: T.top_genes(_two_group(v), ["dataset_id"], 50).select("dataset_id", "gene_id").withColumn("n", F.lit(1)).groupBy("dataset_id").agg(F.sum("n").alias("n")),
    sql("counts_nation samples_nation", "SELECT dataset_id, least(50, count(*))::bigint AS n FROM effects GROUP BY ALL", **SCALED),
)
queries.add(
    "contrast_qc",
    lambda v: T.contrast_qc(v.counts("nation"), v.samples("nation"), _two_group(v), "case", "control", 2, 2, 0.9, 0.2),
    sql("counts_nation samples_nation", """SELECT dataset_id, 'case' AS numerator, 'control' AS denominator, 2 AS design_rank, 2 AS design_columns, 'true' AS design_full_rank,
        sample_count, numerator_samples, denominator_samples, genes_in_raw_matrix, genes_analyzed, genes_in_raw_matrix - genes_analyzed AS genes_filtered, significant_genes, 0 AS samples_removed
        FROM (SELECT dataset_id, count(*) AS sample_count, count(*) FILTER (WHERE "group" = 'case') AS numerator_samples, count(*) FILTER (WHERE "group" = 'control') AS denominator_samples FROM samples_nation GROUP BY ALL)
        JOIN (SELECT dataset_id, count(DISTINCT gene_id) AS genes_in_raw_matrix FROM counts_nation GROUP BY ALL) USING (dataset_id)
        JOIN (SELECT dataset_id, count(*) AS genes_analyzed, count(*) FILTER (WHERE padj < 0.9 AND abs(log2FoldChange) >= 0.2) AS significant_genes FROM effects GROUP BY ALL) USING (dataset_id)""", **SCALED),
)
queries.add(
    "contrast_test_joint",
    lambda v: rounded(T.contrast_test(v.counts("nation"), v.samples("nation"), "case", "control", "~ group + dataset_id"), *EFFECT),
)
queries.add(
    "batch_adjusted_counts",
    # The small offset keeps exact decimal ties from rounding differently in two engines.
    lambda v: rounded(T.adjust_batch(v.counts("nation"), v.samples("nation")).withColumn("adjusted", F.col("adjusted") + 1e-9), "adjusted", digits=4),
    sql("counts_nation samples_nation", """SELECT dataset_id, gene_id, sample_id, count, batch, round(count * ((s / 25) / (sb / nb)) + 1e-9::double, 4) AS adjusted, 'adjusted' AS count_label
        FROM (SELECT *, sum(count) OVER (PARTITION BY gene_id)::double AS s, sum(count) OVER (PARTITION BY gene_id, batch)::double AS sb FROM counts_nation JOIN samples_nation USING (dataset_id, sample_id))
        JOIN (SELECT batch, count(*) AS nb FROM samples_nation GROUP BY ALL) USING (batch)"""),
)

# --- matrix profile and joins ----------------------------------------------


def _entries(v: Views):
    """Line values as matrix text: prices have fractions, quantities do not."""
    lines = v.lines().select("dataset_id", F.concat(F.lit("G"), "l_partkey").alias("gene_id"), F.col("n_name").alias("sample_id"), F.col("l_quantity"))
    return lines.select("dataset_id", "gene_id", "sample_id", F.col("l_quantity").cast("string").alias("value_text"))


PROFILE = {
    "entries": "SELECT dataset_id, 'G' || l_partkey AS gene_id, n_name AS sample_id, l_quantity AS x FROM lines",
    "pe": """SELECT dataset_id, count(*) AS entries, count(*) FILTER (WHERE x IS NULL) AS non_numeric, count(*) FILTER (WHERE x < 0) AS negative, count(*) FILTER (WHERE abs(x - round(x)) > 1e-8 + 1e-5 * abs(round(x))) AS fractional,
        count(*) FILTER (WHERE x <> round(x)) AS inexact, min(x) AS minimum, max(x) AS maximum, sum(x) AS total FROM entries GROUP BY ALL""",
    "pc": """SELECT dataset_id, count(*) AS sample_columns, min(s) AS min_column_sum, max(s) AS max_column_sum, min(s) FILTER (WHERE s <> 0) AS min_nonzero_sum, max(s) FILTER (WHERE s <> 0) AS max_nonzero_sum
        FROM (SELECT dataset_id, sample_id, sum(x) AS s FROM entries GROUP BY ALL) GROUP BY ALL""",
    "pr": """SELECT dataset_id, count(*) AS genes, count(*) FILTER (WHERE copies > 1) AS duplicate_genes, count(*) FILTER (WHERE trim(gene_id) = '') AS blank_genes, count(*) FILTER (WHERE s = 0) AS all_zero_genes
        FROM (SELECT dataset_id, gene_id, max(n) AS copies, sum(s) AS s FROM (SELECT dataset_id, gene_id, sample_id, count(*) AS n, sum(x) AS s FROM entries GROUP BY ALL) GROUP BY ALL) GROUP BY ALL""",
}
queries.add(
    "matrix_profile",
    lambda v: C.profile_matrix(_entries(v), ["dataset_id"]),
    sql("lines", "SELECT * FROM pe JOIN pc USING (dataset_id) JOIN pr USING (dataset_id)", **PROFILE),
)
queries.add(
    "count_type_ladder",
    lambda v: C.count_type(C.profile_matrix(_entries(v), ["dataset_id"]).withColumn("label", F.col("dataset_id"))).select("dataset_id", "count_type", "is_integer", "has_negative", "likely_log_transformed", "likely_normalized"),
    sql("lines", """SELECT dataset_id, CASE WHEN non_numeric = 0 AND inexact = 0 AND negative = 0 THEN 'raw_integer_counts' ELSE 'other' END AS count_type, 'true' AS is_integer, 'false' AS has_negative,
        'false' AS likely_log_transformed, CASE WHEN min_nonzero_sum >= 900000 AND max_nonzero_sum <= 1100000 THEN 'true' ELSE 'false' END AS likely_normalized FROM pe JOIN pc USING (dataset_id)""", **PROFILE),
)
for _policy, _rule in (("bulk", "min_column_sum >= 950000 AND max_column_sum <= 1050000"), ("adapter", "fractional > 0 OR (maximum <= 50 AND total <= 10000)"), ("small", "maximum <= 50 AND max_column_sum <= 1000")):
    queries.add(
        f"looks_normalized_{_policy}",
        lambda v, p=_policy: C.looks_normalized(C.profile_matrix(_entries(v), ["dataset_id"]).withColumn("label", F.lit("")), p).select("dataset_id", "likely_normalized"),
        sql("lines", f"SELECT dataset_id, {_rule} AS likely_normalized FROM pe JOIN pc USING (dataset_id)", **PROFILE),
    )
queries.add(
    "fractional_values",
    lambda v: v.t("lineitem").groupBy("l_returnflag").agg(F.count_if(~is_integral("l_discount")).alias("fractional"), F.count_if(~is_integral("l_quantity")).alias("fractional_quantity")),
    "SELECT l_returnflag, count(*) FILTER (WHERE abs(l_discount - round_even(l_discount, 0)) > 1e-8 + 1e-5 * abs(round_even(l_discount, 0))) AS fractional, 0::bigint AS fractional_quantity FROM lineitem GROUP BY ALL",
)
queries.add(
    "manifest_count_match",
    # Every supplier, against the successor of every supplier that shipped: some sides miss.
    lambda v: J.match_samples(
        v.samples().select("dataset_id", "sample_id"),
        v.lines().select("dataset_id", F.concat(F.lit("S"), F.col("l_suppkey") + 1).alias("sample_id")).distinct(),
    ),
    sql("samples lines", """SELECT coalesce(a.dataset_id, b.dataset_id) AS dataset_id, coalesce(a.sample_id, b.sample_id) AS sample_id,
        CASE WHEN b.sample_id IS NULL THEN 'missing_in_matrix' WHEN a.sample_id IS NULL THEN 'extra_in_matrix' ELSE 'matched' END AS match_status
        FROM samples a FULL JOIN (SELECT DISTINCT dataset_id, 'S' || (l_suppkey + 1) AS sample_id FROM lines) b ON a.dataset_id = b.dataset_id AND a.sample_id = b.sample_id"""),
)
queries.add(
    "gene_space_check",
    lambda v: J.gene_space(v.counts("nation")),
    sql("counts_nation", """SELECT dataset_id, sample_count, count(*) AS genes, count(*) FILTER (WHERE n = sample_count) AS complete_genes, count(*) FILTER (WHERE n <> sample_count) AS incomplete_genes, count(*) FILTER (WHERE copies > n) AS duplicated_genes
        FROM (SELECT dataset_id, gene_id, count(DISTINCT sample_id) AS n, count(*) AS copies FROM counts_nation GROUP BY ALL) JOIN (SELECT dataset_id, count(DISTINCT sample_id) AS sample_count FROM counts_nation GROUP BY ALL) USING (dataset_id) GROUP BY dataset_id, sample_count"""),
)
queries.add(
    "stacked_dataset_gene_space",
    lambda v: J.shared_gene_space(v.counts("nation")),
    sql("counts_nation", """SELECT dataset_id, count(*) FILTER (WHERE d = nd) AS shared_genes, count(*) FILTER (WHERE d <> nd) AS unshared_genes, count(*) FILTER (WHERE d <> nd) = 0 AS identical
        FROM (SELECT DISTINCT dataset_id, gene_id FROM counts_nation) JOIN (SELECT gene_id, count(DISTINCT dataset_id) AS d FROM counts_nation GROUP BY ALL) USING (gene_id), (SELECT count(DISTINCT dataset_id) AS nd FROM counts_nation) GROUP BY dataset_id"""),
)
queries.add(
    "order_check",
    lambda v: J.check_order(
        v.t("orders").select(F.col("o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("sample_id"), F.col("o_orderkey").alias("position")),
        v.t("orders").select(F.col("o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("sample_id"), F.col("o_totalprice").alias("position")),
        "dataset_id",
    ),
    """SELECT dataset_id, count(*) FILTER (WHERE a <> b) AS moved, count(*) FILTER (WHERE a <> b) = 0 AS same_order FROM
        (SELECT o_custkey AS dataset_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS b FROM orders) GROUP BY ALL""",
)
