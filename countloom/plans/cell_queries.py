"""Registered queries: cells, pseudobulk, proportions."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import cells as K
from countloom.operators import pseudobulk as P
from countloom.plans.registry import Registry, rounded
from countloom.plans.views import Views, sql

queries = Registry()

CFG = {
    "strategy": "combined",
    "hard": {"min_counts": 5, "max_counts": 400, "min_genes": 1, "max_genes": 10, "max_pct_mt": 90, "max_pct_ribo": 100, "max_pct_hb": 100, "min_complexity": 0.05},
    "mad": {"enabled": True, "min_cells": 20, "lower_n_mads": 2.0, "upper_n_mads": 2.0, "metrics": ["total_counts", "n_genes_by_counts", "pct_counts_mt"]},
    "gene_prefixes": {"mitochondrial": ["red "], "ribosomal": ["small ", "large "], "hemoglobin": ["blue "]},
    "low_count_quantile": 0.1,
}

queries.add(
    "cell_totals", lambda v: K.cell_totals(v.cells(), v.cell_counts()).select("cell_id", "sample_id", "subject_id", "group", "total_counts", "detected_genes"),
    sql("cells cell_counts", "SELECT cell_id, sample_id, subject_id, \"group\", sum(count)::bigint AS total_counts, count(*) AS detected_genes FROM cells JOIN cell_counts USING (cell_id) GROUP BY ALL"),
)
queries.add(
    "sample_cell_counts", lambda v: K.sample_cell_counts(v.cells()),
    sql("cells", "SELECT dataset_id, sample_id, subject_id, \"group\", count(*) AS cell_count FROM cells GROUP BY ALL"),
)

QC = {
    "marks": "SELECT gene_id, gene_symbol LIKE 'red %' AS mt, gene_symbol LIKE 'small %' OR gene_symbol LIKE 'large %' AS ribo, gene_symbol LIKE 'blue %' AS hb FROM genes",
    "qs": """SELECT cell_id, sum(count)::bigint AS t, count(*) AS g, sum(CASE WHEN mt THEN count ELSE 0 END)::bigint AS mt, sum(CASE WHEN ribo THEN count ELSE 0 END)::bigint AS rb, sum(CASE WHEN hb THEN count ELSE 0 END)::bigint AS hb
        FROM cell_counts LEFT JOIN marks USING (gene_id) GROUP BY ALL""",
    "qc": """SELECT cell_id, sample_id, coalesce(t, 0) AS total_counts, coalesce(g, 0) AS n_genes_by_counts, CASE WHEN t > 0 THEN 100.0::double * mt / t ELSE 0.0::double END AS pct_counts_mt, CASE WHEN t > 0 THEN 100.0::double * rb / t ELSE 0.0::double END AS pct_counts_ribo,
        CASE WHEN t > 0 THEN 100.0::double * hb / t ELSE 0.0::double END AS pct_counts_hb, CASE WHEN t > 0 THEN log10(g + 1) / log10(t + 1) ELSE 0.0::double END AS complexity FROM cells LEFT JOIN qs USING (cell_id)""",
}
SHARES = ["pct_counts_mt", "pct_counts_ribo", "pct_counts_hb", "complexity"]


def _qc(v: Views):
    return K.cell_qc(v.cells(), v.cell_counts(), v.genes(), CFG["gene_prefixes"])


queries.add(
    "cell_qc_metrics",
    lambda v: rounded(_qc(v).select("cell_id", "sample_id", *K.METRICS), *SHARES, digits=5),
    sql("cells cell_counts genes", "SELECT cell_id, sample_id, total_counts, n_genes_by_counts, " + ", ".join(f"round({s}, 5) AS {s}" for s in SHARES) + " FROM qc", **QC),
)
_HARD = {"total_counts": (5, 400), "n_genes_by_counts": (1, 10), "pct_counts_mt": (None, 90), "pct_counts_ribo": (None, 100), "pct_counts_hb": (None, 100), "complexity": (0.05, None)}
_num = lambda x: "NULL::double" if x is None else f"{float(x)}::double"
THRESHOLDS = {
    **QC,
    "qlong": " UNION ALL ".join(f"SELECT sample_id, '{m}' AS metric, {m}::double AS x, {_num(_HARD[m][0])} AS hl, {_num(_HARD[m][1])} AS hu, {m in CFG['mad']['metrics']} AS listed, {K.BOUNDS[m][2]} AS lo, {K.BOUNDS[m][3]} AS hi FROM qc" for m in K.METRICS),
    "qmed": "SELECT *, median(x) OVER (PARTITION BY sample_id, metric) AS med FROM qlong",
    "qmad": "SELECT sample_id, metric, any_value(hl) AS hl, any_value(hu) AS hu, any_value(lo) AS lo, any_value(hi) AS hi, any_value(med) AS med, median(abs(x - med)) / 0.6744897501960817::double AS sc, count(*) >= 20 AND any_value(listed) AS ap FROM qmed GROUP BY ALL",
    "qmb": "SELECT *, CASE WHEN ap AND sc > 0 THEN med - 2 * sc WHEN ap THEN '-infinity'::double END AS ml, CASE WHEN ap AND sc > 0 THEN med + 2 * sc WHEN ap THEN 'infinity'::double END AS mu FROM qmad",
    "thr": """SELECT sample_id, metric, hl AS hard_lower, hu AS hard_upper, ml AS mad_lower, mu AS mad_upper, ap AS mad_applied,
        coalesce(greatest(hl, CASE WHEN lo THEN ml END), '-infinity'::double) AS effective_lower, coalesce(least(hu, CASE WHEN hi THEN mu END), 'infinity'::double) AS effective_upper FROM qmb""",
    "judged": "SELECT q.*, " + ", ".join(f"{m} < max(effective_lower) FILTER (WHERE metric = '{m}') OVER s OR {m} > max(effective_upper) FILTER (WHERE metric = '{m}') OVER s AS f_{m}" for m in K.METRICS)
    + " FROM qc q JOIN thr t USING (sample_id) WINDOW s AS (PARTITION BY cell_id)",
    "jq": "SELECT DISTINCT cell_id, sample_id, concat_ws(';', " + ", ".join(f"CASE WHEN f_{m} THEN '{m}' END" for m in K.METRICS) + ") AS r FROM judged",
}
EDGES = ["hard_lower", "hard_upper", "mad_lower", "mad_upper", "effective_lower", "effective_upper"]


def _finite_edges(df):
    return df.withColumns({c: F.when(F.abs(F.col(c)) < 1e300, F.round(F.col(c), 5)) for c in EDGES})


queries.add(
    "qc_thresholds",
    lambda v: _finite_edges(K.qc_thresholds(_qc(v), CFG)).drop("strategy"),
    sql("cells cell_counts genes", "SELECT sample_id, metric, mad_applied, " + ", ".join(f"CASE WHEN abs({c}) < 1e300 THEN round({c}, 5) END AS {c}" for c in EDGES) + " FROM thr", **THRESHOLDS),
)
queries.add(
    "cell_filter_reasons",
    lambda v: K.preprocess_qc(v.cells(), v.cell_counts(), v.genes(), CFG)["cell_qc"].select("cell_id", "qc_retained", "filter_reason"),
    sql("cells cell_counts genes", "SELECT cell_id, r = '' AS qc_retained, CASE WHEN r = '' THEN 'pass' ELSE r END AS filter_reason FROM jq", **THRESHOLDS),
)
queries.add(
    "preprocess_summary",
    lambda v: K.preprocess_qc(v.cells(), v.cell_counts(), v.genes(), CFG)["sample_summary"],
    sql("cells cell_counts genes", "SELECT sample_id, count(*) AS input_cells, count(*) FILTER (WHERE r = '') AS retained_cells, 0::bigint AS predicted_doublets, count(*) FILTER (WHERE r = '') = 0 AS failed FROM jq GROUP BY ALL", **THRESHOLDS),
)
queries.add(
    "hard_threshold_qc",
    lambda v: K.apply_qc(_qc(v), K.qc_thresholds(_qc(v), {**CFG, "strategy": "hard", "mad": {**CFG["mad"], "enabled": False}})).groupBy("sample_id", "filter_reason").agg(F.count(F.lit(1)).alias("cells")),
    sql("cells cell_counts genes", "SELECT sample_id, CASE WHEN r = '' THEN 'pass' ELSE r END AS filter_reason, count(*) AS cells FROM (SELECT sample_id, concat_ws(';', CASE WHEN total_counts < 5 OR total_counts > 400 THEN 'total_counts' END, CASE WHEN n_genes_by_counts < 1 OR n_genes_by_counts > 10 THEN 'n_genes_by_counts' END, CASE WHEN pct_counts_mt > 90 THEN 'pct_counts_mt' END, CASE WHEN complexity < 0.05 THEN 'complexity' END) AS r FROM qc) GROUP BY ALL", **QC),
)
AMBIENT = {
    "tot": "SELECT cell_id, sample_id, coalesce(sum(count), 0)::bigint AS t FROM cells LEFT JOIN cell_counts USING (cell_id) GROUP BY ALL",
    "low": "SELECT cell_id, sample_id FROM tot JOIN (SELECT sample_id, quantile_cont(t, 0.1) AS cut FROM tot GROUP BY ALL) USING (sample_id) WHERE t <= cut",
    "bg": "SELECT sample_id, gene_id, sum(count) AS b FROM low JOIN cell_counts USING (cell_id) GROUP BY ALL",
    "prof": "SELECT sample_id, gene_id, b::double / sum(b) OVER (PARTITION BY sample_id) AS p FROM bg",
}
queries.add(
    "ambient_score",
    lambda v: rounded(K.ambient_score(v.cells(), v.cell_counts(), 0.1)[0], "ambient_rna_score"),
    sql("cells cell_counts", """SELECT cell_id, round(CASE WHEN max(m) > 0 THEN coalesce(sum(count::double / greatest(t, 1) * p), 0.0) END, 6) AS ambient_rna_score
        FROM tot LEFT JOIN (SELECT sample_id, sum(b) AS m FROM bg GROUP BY ALL) USING (sample_id) LEFT JOIN cell_counts USING (cell_id) LEFT JOIN prof USING (sample_id, gene_id) GROUP BY cell_id""", **AMBIENT),
)
queries.add(
    "ambient_status",
    lambda v: K.ambient_score(v.cells(), v.cell_counts(), 0.1)[1],
    sql("cells cell_counts", "SELECT sample_id, 'low_count_profile' AS method, count(*) AS cell_count, CASE WHEN coalesce(max(m), 0) > 0 THEN 'completed' ELSE 'not_estimable_zero_background' END AS status FROM tot LEFT JOIN (SELECT sample_id, sum(b) AS m FROM bg GROUP BY ALL) USING (sample_id) GROUP BY ALL", **AMBIENT),
)
queries.add(
    "cell_type_metrics", lambda v: K.cell_type_metrics(v.cells()),
    sql("cells", "SELECT dataset_id, sample_id, subject_id, author_label, count(*) AS cell_count FROM cells GROUP BY ALL"),
)
queries.add(
    "cluster_composition",
    lambda v: rounded(K.composition(v.cells(), "batch")[0], "cluster_fraction"),
    sql("cells", "SELECT batch, sample_id, count(*) AS cell_count, round(count(*) / sum(count(*)) OVER (PARTITION BY batch), 6) AS cluster_fraction FROM cells GROUP BY batch, sample_id"),
)
queries.add(
    "cluster_labels", lambda v: K.composition(v.cells(), "batch")[1],
    sql("cells", "SELECT batch, author_label, count(*) AS author_label_cells FROM cells GROUP BY ALL"),
)
queries.add(
    "log_normalize",
    lambda v: rounded(K.log_normalize(v.cell_counts()), "value"),
    sql("cell_counts", "SELECT cell_id, gene_id, round(ln(1 + count::double / sum(count) OVER (PARTITION BY cell_id) * 10000), 6) AS value FROM cell_counts"),
)
queries.add(
    "normalized_genes", lambda v: K.normalize_genes(v.genes().select("gene_id", "gene_symbol"), "GRCh38"),
    sql("genes", "SELECT gene_id AS gene_id_original, gene_id AS gene_id_canonical, gene_symbol, 'GRCh38' AS reference_build, 'identity' AS mapping_status FROM genes"),
)

# Ontology: one reviewed row per region and priority; the lowest priority stays pending.
ONTOLOGY = """SELECT DISTINCT dataset_id, author_label, 'L1' AS harmonized_level1, substr(author_label, 3) AS harmonized_level2, author_label AS harmonized_level3,
    CASE WHEN author_label = '5-LOW' THEN 'pending' ELSE 'confirmed' END AS review_status FROM cells"""


def ontology(v: Views):
    label = F.col("author_label")
    return v.cells().select("dataset_id", "author_label").distinct().select(
        "dataset_id", "author_label", F.lit("L1").alias("harmonized_level1"), F.expr("substr(author_label, 3)").alias("harmonized_level2"),
        label.alias("harmonized_level3"), F.when(label == "5-LOW", F.lit("pending")).otherwise(F.lit("confirmed")).alias("review_status"),
    )


queries.add(
    "ontology_mapping",
    lambda v: K.map_ontology(v.cells(), ontology(v)).groupBy("dataset_id", "harmonized_level2").agg(F.count(F.lit(1)).alias("cells")),
    sql("cells", "SELECT dataset_id, CASE WHEN author_label <> '5-LOW' THEN substr(author_label, 3) END AS harmonized_level2, count(*) AS cells FROM cells GROUP BY ALL"),
)
queries.add(
    "pseudobulk_preparation_issues",
    lambda v: P.preparation_issues(v.cells(), ontology(v)),
    sql("cells", "SELECT DISTINCT dataset_id, 'author_label_unmapped' AS problem, author_label AS value, 1::bigint AS rows FROM cells WHERE author_label = '5-LOW'"),
)
queries.add(
    "cell_annotation_lookup",
    lambda v: K.lookup_once(v.t("orders").select("o_orderkey", "o_custkey"), v.t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), ["o_orderkey"]),
    """SELECT o_orderkey, o_custkey, CASE WHEN coalesce(n, 0) = 1 THEN ln END AS l_linenumber, coalesce(n, 0) AS match_count, coalesce(n, 0) = 1 AS matched
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS ln FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey""",
)
queries.add(
    "cell_identity_conflicts",
    lambda v: K.identity_conflicts(v.cells().select(F.col("subject_id").alias("cell_id"), "dataset_id", "sample_id", "group", F.col("author_label").alias("cell_type"))),
    sql("cells", "SELECT subject_id AS cell_id, count(DISTINCT (dataset_id, sample_id, \"group\", author_label)) AS identities FROM cells GROUP BY ALL HAVING identities > 1"),
)
queries.add(
    "sample_attach",
    lambda v: K.attach_samples(v.cells().withColumn("barcode", F.col("cell_id").cast("string")), v.samples("nation").select("sample_id", F.col("batch").alias("site"))).select("cell_id", "site"),
    sql("cells samples_nation", "SELECT c.dataset_id || ':' || c.sample_id || ':' || cell_id AS cell_id, s.batch AS site FROM cells c JOIN samples_nation s USING (sample_id)"),
)

PB = {
    "typed": "SELECT *, author_label AS cell_type FROM cells",
    "pbc": "SELECT dataset_id, subject_id, \"group\", cell_type, gene_id, sum(count)::bigint AS count FROM typed JOIN cell_counts USING (cell_id) GROUP BY ALL",
    "pbs": "SELECT dataset_id, subject_id, \"group\", cell_type, sum(count)::bigint AS u, count(*) AS d FROM pbc GROUP BY ALL",
    "pba": """SELECT dataset_id, subject_id, "group", cell_type, count(*) AS cell_count, string_agg(DISTINCT sample_id, ';' ORDER BY sample_id) AS sample_ids, count(DISTINCT sample_id) AS ns, min(sample_id) AS s1,
        CASE WHEN count(DISTINCT batch) = 1 THEN min(batch) ELSE 'NA' END AS batch FROM typed GROUP BY ALL""",
    "pbm": """SELECT dataset_id, subject_id, "group", cell_type, CASE WHEN ns = 1 THEN s1 ELSE 'multiple' END AS sample_id, cell_type AS author_label, sample_ids, cell_count, coalesce(u, 0) AS total_UMI, coalesce(d, 0) AS detected_genes, batch,
        concat_ws(';', CASE WHEN cell_count < 2 THEN 'min_cells_per_pseudobulk' END, CASE WHEN coalesce(u, 0) < 100 THEN 'min_total_counts' END, CASE WHEN coalesce(d, 0) < 3 THEN 'min_detected_genes' END) AS r
        FROM pba LEFT JOIN pbs USING (dataset_id, subject_id, "group", cell_type)""",
}


def bulk(v: Views, keep: bool = False):
    return P.pseudobulk(v.cells(), v.cell_counts(), 2, 100, 3, keep=keep)


queries.add(
    "pseudobulk_counts", lambda v: bulk(v)[0],
    sql("cells cell_counts", "SELECT * FROM pbc", **PB),
)
queries.add(
    "pseudobulk_metadata", lambda v: bulk(v)[1],
    sql("cells cell_counts", "SELECT * EXCLUDE (r), CASE WHEN r = '' THEN 'eligible' ELSE 'ineligible' END AS eligibility, CASE WHEN r = '' THEN 'pass' ELSE r END AS exclusion_reason, CASE WHEN r = '' THEN 'true' ELSE 'false' END AS eligible_for_de FROM pbm", **PB),
)
queries.add(
    "eligible_pseudobulk",
    lambda v: P.eligible(bulk(v)[1]).groupBy("dataset_id", "cell_type").agg(F.count(F.lit(1)).alias("units")),
    sql("cells cell_counts", "SELECT dataset_id, cell_type, count(*) AS units FROM pbm WHERE r = '' GROUP BY ALL", **PB),
)
queries.add(
    "cell_type_eligibility",
    lambda v: P.cell_type_eligibility(bulk(v)[1], 1, 100),
    sql("cells cell_counts", """SELECT cell_type, CASE WHEN min(s) >= 100 THEN 'eligible' ELSE 'skipped' END AS eligibility, CASE WHEN min(s) >= 100 THEN 'pass' ELSE 'min_subjects_per_group_not_met' END AS exclusion_reason
        FROM (SELECT cell_type, "group", count(DISTINCT subject_id) AS s FROM pbm GROUP BY ALL) GROUP BY ALL""", **PB),
)
queries.add(
    "pseudobulk_group_statistics",
    lambda v: P.group_statistics(bulk(v)[1]),
    sql("cells cell_counts", "SELECT cell_type, \"group\", count(DISTINCT subject_id) AS subjects, sum(cell_count)::bigint AS cells, sum(total_UMI)::bigint AS total_UMI, max(detected_genes) AS max_detected_genes FROM pbm GROUP BY ALL", **PB),
)
queries.add(
    "subjects_per_group",
    lambda v: P.subjects_per_group(v.cells(), "case", "control", ["dataset_id", "author_label"]),
    sql("cells", "SELECT dataset_id, author_label, count(DISTINCT subject_id) FILTER (WHERE \"group\" = 'case') AS numerator_subjects, count(DISTINCT subject_id) FILTER (WHERE \"group\" = 'control') AS denominator_subjects FROM cells GROUP BY ALL"),
)
queries.add(
    "subject_purity",
    # Units keyed by nation only would merge donors: every one is reported.
    lambda v: P.subject_purity(v.cells().select(F.concat_ws("|", "sample_id", "group").alias("pseudobulk_id"), "subject_id")),
    sql("cells", "SELECT sample_id || '|' || \"group\" AS pseudobulk_id, count(DISTINCT subject_id) AS subjects FROM cells GROUP BY ALL HAVING subjects <> 1"),
)
EFFECT = ["baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue", "padj"]
queries.add(
    "pseudobulk_test",
    lambda v: rounded(P.pseudobulk_test(*P.pseudobulk(v.cells(), v.cell_counts(), keep=True), "case", "control", 2)[0], *EFFECT),
)
queries.add(
    "pseudobulk_skipped",
    lambda v: P.skipped_types(bulk(v)[1], "case", "control", 20),
    sql("cells cell_counts", """SELECT dataset_id, cell_type, n1 AS numerator_subjects, n0 AS denominator_subjects, 'insufficient_subjects_per_group' AS reason FROM (SELECT dataset_id, cell_type, count(DISTINCT subject_id) FILTER (WHERE "group" = 'case') AS n1, count(DISTINCT subject_id) FILTER (WHERE "group" = 'control') AS n0
        FROM pbm WHERE r = '' AND "group" IN ('case', 'control') GROUP BY ALL) WHERE n1 < 20 OR n0 < 20""", **PB),
)
