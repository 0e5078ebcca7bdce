"""Registered queries: evidence integration and gene mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import integrate as N
from countloom.operators import joins as J
from countloom.plans.registry import Registry, rounded
from countloom.plans.reviewed import TEXT, reviewed
from countloom.plans.views import Views, sql
from countloom.session import reuse

queries = Registry()


def mapping(v: Views):
    """Every tenth part maps to two ids, every seventh to none, the rest to one."""
    part = v.t("part").where("p_partkey % 7 <> 3")
    k = F.col("p_partkey")
    one = part.select(F.concat(F.lit("G"), k).alias("original_gene_id"), F.concat(F.lit("CG"), k).alias("canonical_gene_id"), F.col("p_name").alias("gene_symbol"))
    two = part.where("p_partkey % 10 = 0").select(F.concat(F.lit("G"), k).alias("original_gene_id"), F.concat(F.lit("CG"), k, F.lit("b")).alias("canonical_gene_id"), F.col("p_name").alias("gene_symbol"))
    return one.unionByName(two).withColumn("mapping_source", F.lit("table"))


def bulk(v: Views):
    """Case against control quantity per region and part; p shrinks with the number of lines."""
    side = lambda a: F.sum(F.when((F.col("l_suppkey") % 2 == a), F.col("l_quantity").cast("bigint")).otherwise(0))
    g = v.lines().groupBy("dataset_id", "l_partkey").agg(side(1).alias("a"), side(0).alias("b"), F.count(F.lit(1)).alias("n"))
    return g.select(F.concat(F.lit("G"), "l_partkey").alias("gene_id"), "dataset_id", F.log2((F.col("a") + 1) / (F.col("b") + 1)).alias("log2FoldChange"), (1.0 / (F.col("n") * F.col("n"))).alias("padj"))


def bulk_meta(v: Views):
    return v.t("part").select(F.concat(F.lit("G"), "p_partkey").alias("gene_id"), (F.col("p_size") - 25.5).alias("pooled_log2fc"), (F.col("p_size") / 1000.0).alias("meta_padj"))


def pb(v: Views):
    j = v.lines().join(v.t("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    side = lambda a: F.sum(F.when(F.col("o_orderstatus") == a, F.col("l_quantity").cast("bigint")).otherwise(0))
    g = j.groupBy("dataset_id", "l_partkey", F.col("o_orderpriority").alias("cell_type")).agg(side("F").alias("a"), side("O").alias("b"), F.count(F.lit(1)).alias("n"))
    return g.select(F.concat(F.lit("G"), "l_partkey").alias("gene_id"), "dataset_id", "cell_type", F.log2((F.col("a") + 1) / (F.col("b") + 1)).alias("log2FoldChange"), (1.0 / (1 + F.col("n") * F.col("n") * F.col("n"))).alias("padj"))


def pb_meta(v: Views):
    return v.t("part").select(F.concat(F.lit("G"), "p_partkey").alias("gene_id"), F.lit("1-URGENT").alias("cell_type"), (F.col("p_size") - 25.5).alias("pooled_log2fc"), (F.col("p_size") / 100.0).alias("meta_padj"))


def expression(v: Views):
    return N.cell_type_expression(v.cells(), v.cell_counts(), "author_label", above=25)


def tables(v: Views, only: str | None = None):
    # One pass over the raw counts for each of the three reduced tables that several steps read.
    e, by_dataset, by_type = reuse(expression(v)), reuse(bulk(v)), reuse(pb(v))
    avg = e.select("gene_id", "cell_type", F.col("mean_expression").alias("average_expression"))
    frac = e.select("gene_id", "cell_type", F.col("pct_expression").alias("expression_cell_fraction"))
    part = v.t("part")
    loo = part.select(F.concat(F.lit("CG"), "p_partkey").alias("gene_id"), F.when(F.col("p_size") % 5 == 0, F.lit("true")).otherwise(F.lit("false")).alias("dataset_driven"))
    val = part.select(F.concat(F.lit("CG"), "p_partkey").alias("gene_id"), F.when(F.col("p_size") % 4 == 0, F.lit("replicated")).when(F.col("p_size") % 4 == 1, F.lit("not_available")).otherwise(F.lit("direction_mismatch")).alias("replication_status"))
    markers = N.dominant_cell_type(e).select("gene_id", F.col("dominant_cell_type").alias("cell_type"), "pct_expression")
    return N.integrate(by_dataset, bulk_meta(v), by_type, pb_meta(v), markers, avg, frac, loo, val, reviewed(v, "ontology"), mapping(v), only=only)


MAPPING = """SELECT 'G' || p_partkey AS o, 'CG' || p_partkey AS c, p_name AS s FROM part WHERE p_partkey % 7 <> 3 UNION ALL SELECT 'G' || p_partkey, 'CG' || p_partkey || 'b', p_name FROM part WHERE p_partkey % 7 <> 3 AND p_partkey % 10 = 0"""
MAPPED = "SELECT t.*, coalesce(c, t.gene_id) AS cg, coalesce(s, 'NA') AS sym, CASE WHEN c IS NULL THEN 'identity' WHEN amb THEN 'ambiguous_one_to_many' ELSE 'mapped' END AS st FROM {} t LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY o) > 1 AS amb FROM gmap) ON o = t.gene_id"
INT = {
    "gmap": MAPPING,
    "bulk0": """SELECT 'G' || l_partkey AS gene_id, dataset_id, log2((sum(CASE WHEN l_suppkey % 2 = 1 THEN l_quantity ELSE 0 END) + 1) / (sum(CASE WHEN l_suppkey % 2 = 0 THEN l_quantity ELSE 0 END) + 1)) AS effect, 1.0::double / (count(*) * count(*)) AS padj FROM lines GROUP BY l_partkey, dataset_id""",
    "bm0": "SELECT 'G' || p_partkey AS gene_id, (p_size - 25.5)::double AS effect, p_size / 1000.0::double AS padj FROM part",
    "pb0": """SELECT 'G' || l_partkey AS gene_id, dataset_id, o_orderpriority AS cell_type, log2((sum(CASE WHEN o_orderstatus = 'F' THEN l_quantity ELSE 0 END) + 1) / (sum(CASE WHEN o_orderstatus = 'O' THEN l_quantity ELSE 0 END) + 1)) AS effect, 1.0::double / (1 + count(*) * count(*) * count(*)) AS padj
        FROM lines JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey, dataset_id, o_orderpriority""",
    "pm0": "SELECT 'G' || p_partkey AS gene_id, '1-URGENT' AS cell_type, (p_size - 25.5)::double AS effect, p_size / 100.0::double AS padj FROM part",
    "ex0": "SELECT gene_id, author_label AS cell_type, avg(count) AS a, avg((count > 25)::int) AS f FROM cell_counts JOIN cells USING (cell_id) GROUP BY ALL",
    **{f"{n}m": MAPPED.format(f"{n}0") for n in ("bulk", "bm", "pb", "pm", "ex")},
    "bb": "SELECT cg, sym, effect, padj FROM (SELECT cg, sym, effect, padj, 0 AS o, dataset_id AS d FROM bulkm UNION ALL SELECT cg, sym, effect, padj, 1, 'NA' FROM bmm) QUALIFY row_number() OVER (PARTITION BY cg ORDER BY padj, o, d, effect) = 1",
    "pbb": "SELECT cg, cell_type, effect, padj FROM (SELECT cg, cell_type, effect, padj, 0 AS o, dataset_id AS d FROM pbm2 UNION ALL SELECT cg, cell_type, effect, padj, 1, 'NA' FROM pmm) QUALIFY row_number() OVER (PARTITION BY cg, cell_type ORDER BY padj, o, d, effect) = 1".replace("pbm2", "pbm"),
    "es": """SELECT cg, min(sym) AS esym, arg_min(cell_type, (-a, cell_type)) AS top, list_sort(list(a), 'DESC') AS l, sum(greatest(0.0, a)) AS t FROM exm GROUP BY cg""",
    "es2": "SELECT cg, esym, CASE WHEN len(l) > 1 AND abs(l[1] - l[2]) <= 0.05 * greatest(l[1], 1e-9) THEN 'ambiguous' ELSE top END AS dom, CASE WHEN t > 0 THEN l[1] / t ELSE 0.0 END AS spec FROM es",
    "u": "SELECT cg FROM bb UNION SELECT cg FROM pbb UNION SELECT cg FROM es",
    "kinds": "SELECT DISTINCT harmonized_level2 AS cell_type FROM ontology WHERE review_status = 'confirmed'",
    "crows": """SELECT cg, cell_type, a, f, sym, gene_id AS og, st, false AS missing FROM exm UNION ALL SELECT cg, 'missing', NULL, NULL, NULL, NULL, NULL, false FROM u WHERE cg NOT IN (SELECT cg FROM es)
        UNION ALL SELECT cg, cell_type, NULL, NULL, NULL, NULL, NULL, true FROM u CROSS JOIN kinds WHERE NOT EXISTS (SELECT 1 FROM exm x WHERE x.cg = u.cg AND x.cell_type = kinds.cell_type)""",
    "best": "SELECT cg, cell_type AS bct, effect AS be, padj AS bp FROM pbb SEMI JOIN crows USING (cg, cell_type) QUALIFY row_number() OVER (PARTITION BY cg ORDER BY padj, cell_type) = 1",
    "sup": "SELECT cg, count(DISTINCT dataset_id) AS n FROM bulkm WHERE padj < 0.05 GROUP BY 1",
    "psup": "SELECT cg, count(DISTINCT dataset_id) AS n FROM pbm WHERE padj < 0.05 GROUP BY 1",
    "loo": "SELECT 'CG' || p_partkey AS cg, p_size % 5 = 0 AS drv FROM part",
    "val": "SELECT 'CG' || p_partkey AS cg, CASE p_size % 4 WHEN 0 THEN 'replicated' WHEN 1 THEN 'not_available' ELSE 'direction_mismatch' END AS rs FROM part",
    "amb": "SELECT DISTINCT cg FROM (SELECT cg, st FROM bulkm UNION ALL SELECT cg, st FROM pbm) WHERE st = 'ambiguous_one_to_many'",
    "g0": """SELECT u.cg, coalesce(bb.sym, esym, 'NA') AS sym, bb.effect AS be0, bb.padj AS bp0, coalesce(dom, 'missing') AS dom, coalesce(spec, 0.0) AS spec, bct, be, bp, mp, pmp, coalesce(sup.n, 0) AS bs, coalesce(psup.n, 0) AS ps,
        coalesce(drv, false) AS drv, coalesce(rs, 'not_available') AS rs, amb.cg IS NOT NULL AS am,
        CASE WHEN coalesce(sign(bb.effect), 0) = 0 OR coalesce(sign(be), 0) = 0 THEN 'not_comparable' WHEN sign(bb.effect) = sign(be) THEN 'same' ELSE 'opposite' END AS dir
        FROM u LEFT JOIN bb USING (cg) LEFT JOIN es2 USING (cg) LEFT JOIN best USING (cg) LEFT JOIN (SELECT cg, min(padj) AS mp FROM bmm GROUP BY 1) USING (cg) LEFT JOIN sup USING (cg) LEFT JOIN psup USING (cg) LEFT JOIN loo USING (cg) LEFT JOIN val USING (cg) LEFT JOIN amb USING (cg)
        LEFT JOIN (SELECT cg, cell_type AS ct, min(padj) AS pmp FROM pmm GROUP BY ALL) q ON q.cg = u.cg AND q.ct = coalesce(bct, dom, 'missing')""",
    "g1": """SELECT *, CASE WHEN bp0 IS NULL THEN 0.0 ELSE least(1.0, greatest(0.0, -log10(greatest(bp0, 1e-300::double)) / 10)) END AS s1, CASE WHEN mp IS NULL THEN 0.0 ELSE least(1.0, greatest(0.0, -log10(greatest(mp, 1e-300::double)) / 10)) END AS s2,
        CASE WHEN bp IS NULL THEN 0.0 ELSE least(1.0, greatest(0.0, -log10(greatest(bp, 1e-300::double)) / 10)) END AS s3, (dir = 'same')::int::double AS s4, least(1.0, (bs + ps) / 4) AS s6, (rs = 'replicated')::int::double AS s7, (NOT drv)::int::double AS s9,
        list_sort(list_filter([CASE WHEN dir = 'opposite' THEN 'bulk_pseudobulk_opposite_direction' END, CASE WHEN bs <= 1 THEN 'single_gse_support' END, CASE WHEN dom = 'ambiguous' THEN 'ambiguous_dominant_cell_type' END,
          CASE WHEN dom = 'missing' THEN 'missing_cell_type_expression' END, CASE WHEN rs NOT IN ('replicated', 'not_available') THEN 'validation_failed' END, CASE WHEN am THEN 'ambiguous_one_to_many' END], lambda x: x IS NOT NULL)) AS lim FROM g0""",
    "g": "SELECT *, (s1 + s2 + s3 + s4 + spec + s6 + s7 + s9) / 8 AS total FROM g1",
}
ONT = {"ontology": TEXT["ontology"]}
LEVEL = "CASE WHEN total >= 0.75 THEN 'high' WHEN total >= 0.5 THEN 'moderate' WHEN total >= 0.25 THEN 'low' ELSE 'limited' END"
SCORES = ["bulk_stat_score", "bulk_meta_score", "pseudobulk_score", "celltype_specificity_score", "cross_gse_score", "total_score"]


def isql(body: str) -> str:
    return sql("lines cells cell_counts", body, **ONT, **INT)


queries.add(
    "candidate_gene_scores", lambda v: rounded(tables(v)["candidate_gene_scores"], *SCORES),
    isql(f"""SELECT cg AS canonical_gene_id, sym AS gene_symbol, round(s1, 6) AS bulk_stat_score, round(s2, 6) AS bulk_meta_score, round(s3, 6) AS pseudobulk_score, s4 AS direction_consistency_score, round(spec, 6) AS celltype_specificity_score,
        round(s6, 6) AS cross_gse_score, s7 AS validation_score, 0.0::double AS pathway_support_score, s9 AS loo_stability_score, round(total, 6) AS total_score, {LEVEL} AS evidence_level, CASE WHEN len(lim) = 0 THEN 'none' ELSE array_to_string(lim, ';') END AS limitations,
        CASE WHEN drv OR (bs <= 1 AND ps = 0) THEN 'true' ELSE 'false' END AS dataset_driven, CASE WHEN list_has_any(lim, ['ambiguous_one_to_many', 'bulk_pseudobulk_opposite_direction', 'single_gse_support', 'validation_failed']) THEN 'limited' ELSE {LEVEL} END AS confidence,
        'false' AS is_final_biological_conclusion, 'human_review_required' AS required_action FROM g"""),
)
queries.add(
    "consensus_genes", lambda v: rounded(tables(v)["consensus_genes"], "bulk_meta_padj", "pseudobulk_meta_padj"),
    isql(f"""SELECT cg AS canonical_gene_id, sym AS gene_symbol, bs AS bulk_dataset_support, ps AS pseudobulk_dataset_support, dir AS direction_consistency, round(mp, 6) AS bulk_meta_padj, round(pmp, 6) AS pseudobulk_meta_padj,
        CASE WHEN drv THEN 'false' ELSE 'true' END AS loo_stable, CASE WHEN drv OR (bs <= 1 AND ps = 0) THEN 'true' ELSE 'false' END AS dataset_driven, rs AS validation_replication_status, {LEVEL} AS evidence_level FROM g"""),
)
WIDE = "crows LEFT JOIN pbb USING (cg, cell_type) JOIN g USING (cg)"
DIR = "CASE WHEN coalesce(sign(be0), 0) = 0 OR coalesce(sign(pbb.effect), 0) = 0 THEN 'not_comparable' WHEN sign(be0) = sign(pbb.effect) THEN 'same' ELSE 'opposite' END"
queries.add(
    "bulk_scrna_concordance", lambda v: rounded(tables(v)["bulk_scrna_concordance"], "bulk_log2fc", "bulk_padj", "pseudobulk_log2fc", "pseudobulk_padj", "cell_type_specificity").drop("dominant_cell_type_interpretation"),
    isql(f"SELECT cg AS canonical_gene_id, g.sym AS gene_symbol, cell_type, round(be0, 6) AS bulk_log2fc, round(bp0, 6) AS bulk_padj, round(pbb.effect, 6) AS pseudobulk_log2fc, round(pbb.padj, 6) AS pseudobulk_padj, {DIR} AS effect_direction_consistency, dom AS dominant_cell_type, round(spec, 6) AS cell_type_specificity FROM {WIDE}"),
)
queries.add(
    "gene_celltype_mapping", lambda v: rounded(tables(v)["gene_celltype_mapping"].drop("mapping_source", "duplicate_resolution_method"), "average_expression", "expression_cell_fraction"),
    isql(f"""SELECT coalesce(og, cg) AS original_gene_id, cg AS canonical_gene_id, g.sym AS gene_symbol, coalesce(st, 'identity') AS mapping_status, cell_type, round(a, 6) AS average_expression, round(f, 6) AS expression_cell_fraction, CASE WHEN cell_type = dom THEN 'true' ELSE 'false' END AS is_dominant_cell_type,
        CASE WHEN missing THEN 'missing_cell_type' WHEN dom = 'ambiguous' THEN 'ambiguous_dominant_cell_type' WHEN dom = 'missing' THEN 'missing_cell_type_expression' ELSE 'potential_major_expression_source_not_causal' END AS dominant_cell_type_note FROM {WIDE}"""),
)
queries.add(
    "celltype_specific_effects", lambda v: rounded(tables(v)["celltype_specific_effects"].drop("expression_cell_fraction", "average_expression"), "pseudobulk_log2fc", "pseudobulk_padj", "cell_type_specificity"),
    isql(f"SELECT cg AS canonical_gene_id, g.sym AS gene_symbol, cell_type, round(pbb.effect, 6) AS pseudobulk_log2fc, round(pbb.padj, 6) AS pseudobulk_padj, round(spec, 6) AS cell_type_specificity, dom AS dominant_cell_type, {DIR} AS effect_direction_consistency FROM {WIDE}"),
)
queries.add("heatmap_table", lambda v: rounded(tables(v)["heatmap"], "value"), isql(f"SELECT cg AS canonical_gene_id, g.sym AS gene_symbol, cell_type, round(pbb.effect, 6) AS value, 'pseudobulk_log2fc' AS value_type FROM {WIDE}"))
queries.add("dotplot_table", lambda v: rounded(tables(v)["dotplot"], "average_expression", "expression_cell_fraction", "total_score"), isql(f"SELECT cg AS canonical_gene_id, g.sym AS gene_symbol, cell_type, round(a, 6) AS average_expression, round(f, 6) AS expression_cell_fraction, round(total, 6) AS total_score FROM {WIDE}"))
queries.add("effect_scatter_table", lambda v: rounded(tables(v)["effect_scatter"], "bulk_log2fc", "pseudobulk_log2fc"), isql(f"SELECT cg AS canonical_gene_id, g.sym AS gene_symbol, cell_type, round(be0, 6) AS bulk_log2fc, round(pbb.effect, 6) AS pseudobulk_log2fc, {DIR} AS effect_direction_consistency FROM {WIDE}"))
queries.add(
    "candidate_evidence_plot", lambda v: rounded(tables(v)["candidate_evidence_plot"].groupBy("component").agg(F.sum("score").alias("score")), "score", digits=4),
    isql("SELECT component, round(sum(score), 4) AS score FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS component, {c}::double AS score FROM g" for n, c in zip(N.WEIGHTS, ("s1", "s2", "s3", "s4", "spec", "s6", "s7", "0.0", "s9"))) + ") GROUP BY 1"),
)
queries.add("sankey_edges", lambda v: tables(v)["sankey_edges"].groupBy("source", "target", "edge_type").agg(F.sum("value").alias("value")), isql("SELECT 'bulk_DEG' AS source, dom AS target, 'potential_expression_source_not_causal' AS edge_type, count(*) AS value FROM g GROUP BY dom"))
queries.add(
    "dataset_support_matrix", lambda v: rounded(tables(v)["dataset_support_matrix"], "effect", "padj"),
    isql("""SELECT cg AS canonical_gene_id, t.sym AS gene_symbol, dataset_id, modality, round(effect, 6) AS effect, round(padj, 6) AS padj, CASE WHEN sign(effect) = coalesce(cs, 0) AND sign(effect) <> 0 THEN 'true' ELSE 'false' END AS supports_consensus_direction, CASE WHEN padj < 0.05 THEN 'true' ELSE 'false' END AS is_significant
        FROM (SELECT cg, sym, dataset_id, 'bulk' AS modality, effect, padj FROM bulkm UNION ALL SELECT cg, sym, dataset_id, 'pseudobulk', effect, padj FROM pbm) t JOIN (SELECT cg, sign(be0) AS cs FROM g) USING (cg)"""),
)
queries.add("unmapped_genes", lambda v: tables(v, "unmapped_genes")["unmapped_genes"].groupBy("original_gene_id", "reason").agg(F.count(F.lit(1)).alias("n")),
            isql("SELECT gene_id AS original_gene_id, st AS reason, count(*) AS n FROM (SELECT gene_id, st FROM bulkm UNION ALL SELECT gene_id, st FROM bmm UNION ALL SELECT gene_id, st FROM pbm UNION ALL SELECT gene_id, st FROM pmm UNION ALL SELECT gene_id, st FROM exm UNION ALL (SELECT gene_id, st FROM (" + MAPPED.format("(SELECT gene_id FROM cell_counts JOIN cells USING (cell_id) GROUP BY gene_id, author_label)") + ") UNION ALL SELECT gene_id, st FROM (" + MAPPED.format("(SELECT DISTINCT gene_id FROM cell_counts JOIN cells USING (cell_id))") + "))) WHERE st = 'ambiguous_one_to_many' GROUP BY ALL"))
queries.add(
    "gene_mapper", lambda v: J.map_genes(bulk(v), mapping(v)).groupBy("mapping_status").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("canonical_gene_id").alias("genes")),
    isql("SELECT st AS mapping_status, count(*) AS rows, count(DISTINCT cg) AS genes FROM bulkm GROUP BY 1"),
)
for _dense in (False, True):
    queries.add(
        "cell_type_expression_dense" if _dense else "cell_type_expression",
        lambda v, d=_dense: rounded(N.cell_type_expression(v.cells(), v.cell_counts(), "author_label", d), "mean_expression", "pct_expression"),
        sql("cells cell_counts", "SELECT gene_id, author_label AS cell_type, round(sum(count) / max(n), 6) AS mean_expression, round(count(*) / max(n), 6) AS pct_expression FROM cell_counts JOIN cells USING (cell_id) JOIN (SELECT author_label, count(*) AS n FROM cells GROUP BY 1) USING (author_label) GROUP BY ALL"
            if _dense else "SELECT gene_id, author_label AS cell_type, round(avg(count), 6) AS mean_expression, round(avg((count > 0)::int), 6) AS pct_expression FROM cell_counts JOIN cells USING (cell_id) GROUP BY ALL"),
    )
queries.add(
    "dominant_cell_type", lambda v: rounded(N.dominant_cell_type(expression(v)), "mean_expression", "pct_expression", "total_score").drop("evidence_level", "confidence"),
    sql("cells cell_counts", """SELECT gene_id, cell_type AS dominant_cell_type, round(m, 6) AS mean_expression, round(p, 6) AS pct_expression, round(p, 6) AS total_score FROM (SELECT gene_id, author_label AS cell_type, avg(count) AS m, avg((count > 25)::int) AS p FROM cell_counts JOIN cells USING (cell_id) GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY m DESC, p DESC, cell_type) = 1"""),
)
