"""Bulk and single-cell evidence joined per gene, scored, and laid out as tables.

Everything is keyed by the canonical gene; a gene's rows number at most its cell
types and datasets, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import bool_text, finite, is_missing, or_na, present
from countloom.functions.scores import confidence, direction, evidence_level, p_score, sign
from countloom.functions.text import joined_or, kept
from countloom.operators.joins import map_genes, resolve_genes
from countloom.operators.ranking import best_rows
from countloom.operators.rules.issues import when_empty
from countloom.session import reuse

GENE = "canonical_gene_id"
# The nine score parts with their default weights.
WEIGHTS = {
    "bulk_stat_score": 1.0,
    "bulk_meta_score": 1.0,
    "pseudobulk_score": 1.0,
    "direction_consistency_score": 1.0,
    "celltype_specificity_score": 1.0,
    "cross_gse_score": 1.0,
    "validation_score": 1.0,
    "pathway_support_score": 0.0,
    "loo_stability_score": 1.0,
}
SOURCE_NOTE = "potential_major_expression_source_not_causal"


def _first_number(df: DataFrame, names: Sequence[str]) -> Column:
    found = [finite(c) for c in names if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("double")


def evidence_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of all tables of evidence as one: gene, kind, cell type, dataset, effect, p-values and expression.

    Effect and adjusted p come from whichever columns a table has.
    """
    nothing = F.lit(None)
    out = None
    for kind in ("bulk", "bulk_meta", "pb", "pb_meta", "avg", "frac"):
        df = tables[kind]
        level = {"avg": "average_expression", "frac": "expression_cell_fraction"}.get(kind)
        value = nothing.cast("double") if level is None else F.coalesce(finite(level), F.lit(0.0)) if kind == "avg" else finite(level)
        part = df.select(
            F.col("gene_id").cast("string").alias("original_gene_id"), F.lit(kind).alias("kind"),
            (nothing if kind.startswith("bulk") else F.col("cell_type")).cast("string").alias("cell_type"),
            (or_na("dataset_id") if "dataset_id" in df.columns else F.lit("NA")).alias("dataset_id"),
            _first_number(df, ("log2FoldChange", "pooled_log2fc")).alias("effect"),
            _first_number(df, ("padj", "meta_padj", "pvalue")).alias("padj"),
            _first_number(df, ("meta_padj", "meta_pvalue")).alias("meta_p"), value.alias("level"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _of_type(cell_type: Column) -> Column:
    """What ``_types`` holds for one cell type, null without it."""
    return F.get(F.filter("_types", lambda t: t["cell_type"] == cell_type), F.lit(0))


def by_gene(known: DataFrame, kinds: DataFrame, delta: float = 0.05) -> DataFrame:
    """One row per canonical gene: best effects, support, expression summary and its cell rows (``_rows``).

    A gene has a row for each expression row, or one named missing without any, and one
    marked missing for every known cell type it was not seen in.  Its cell types and
    datasets are few, so its lists are short.  The smallest adjusted p is the best; a missing one never wins over a number.
    """
    of = lambda *names: F.col("kind").isin(*names)
    place = F.when(of("bulk", "pb"), F.lit(0)).otherwise(F.lit(1))
    best = F.struct(F.coalesce("padj", F.lit(float("inf"))).alias("o"), place.alias("n"), "dataset_id", "effect", "gene_symbol", "mapping_status", "padj")
    hit = present("dataset_id") & (F.col("padj") < 0.05)
    expressed = F.struct("original_gene_id", "mapping_source", "mapping_status", "duplicate_resolution_method", "gene_symbol", F.col("level").alias("average_expression"))
    typed = known.repartition(GENE).groupBy(GENE, "cell_type").agg(
        F.min(F.when(of("bulk", "bulk_meta"), best)).alias("_bulk"), F.min(F.when(of("pb", "pb_meta"), best)).alias("_pb"),
        F.min(F.when(of("bulk_meta"), F.col("meta_p"))).alias("_bulk_meta"), F.min(F.when(of("pb_meta"), F.col("meta_p"))).alias("_pb_meta"),
        F.collect_set(F.when(of("bulk") & hit, F.col("dataset_id"))).alias("_bulk_in"), F.collect_set(F.when(of("pb") & hit, F.col("dataset_id"))).alias("_pb_in"),
        F.max(of("bulk", "pb") & (F.col("mapping_status") == "ambiguous_one_to_many")).alias("_ambiguous"),
        F.max(F.when(of("frac"), F.col("level"))).alias("_frac"), F.collect_list(F.when(of("avg"), expressed)).alias("_expressed"),
        F.max("_driven").alias("_driven"), F.max("_status").alias("_status"), F.max(of("bulk", "bulk_meta", "pb", "pb_meta", "avg")).alias("_in"),
    )
    named = lambda c: F.when(F.col("cell_type").isNotNull(), F.col(c)).alias(c)
    distinct = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    gene = typed.groupBy(GENE).agg(
        F.collect_list(F.struct("cell_type", named("_pb"), named("_pb_meta"), named("_frac"), "_expressed")).alias("_types"),
        F.min("_bulk").alias("_bulk"), F.min("_bulk_meta").alias("bulk_meta_padj"), F.max("_ambiguous").alias("_ambiguous"),
        distinct("_bulk_in").alias("bulk_dataset_support"), distinct("_pb_in").alias("pseudobulk_dataset_support"),
        F.max("_driven").alias("_driven"), F.max("_status").alias("_status"), F.max("_in").alias("_in"),
    ).where("_in")

    def row(kind: Column, missing: bool, pb: Column, e: Column | None = None, frac: Column | None = None) -> Column:
        texts = ("original_gene_id", "mapping_source", "mapping_status", "duplicate_resolution_method")
        text = lambda c: (F.lit(None) if e is None else e[c]).cast("string").alias(c)
        number = lambda v, c: (F.lit(None) if v is None else v).cast("double").alias(c)
        return F.struct(
            kind.cast("string").alias("cell_type"), F.lit(missing).alias("missing_cell_type"), *[text(c) for c in texts],
            number(None if e is None else e["average_expression"], "average_expression"), number(frac, "expression_cell_fraction"),
            number(pb["effect"], "pseudobulk_log2fc"), number(pb["padj"], "pseudobulk_padj"),
        )

    seen = F.flatten(F.transform("_types", lambda t: F.transform(t["_expressed"], lambda e: row(t["cell_type"], False, t["_pb"], e, t["_frac"]))))
    symbols = F.flatten(F.transform("_types", lambda t: F.transform(t["_expressed"], lambda e: e["gene_symbol"])))
    known_types = kinds.agg(F.array_sort(F.collect_set("cell_type")).alias("_kinds"))
    gene = gene.crossJoin(F.broadcast(known_types)).withColumn("_seen", seen)  # one row
    blank = F.array(row(F.lit("missing"), False, _of_type(F.lit("missing"))["_pb"]))
    gene = gene.withColumn("_given", F.when(F.size("_seen") > 0, F.col("_seen")).otherwise(blank))
    absent = F.array_except("_kinds", F.transform("_given", lambda r: r["cell_type"]))
    gene = gene.withColumn("_rows", F.concat("_given", F.transform(absent, lambda k: row(k, True, _of_type(k)["_pb"]))))
    paired = F.filter("_rows", lambda r: r["pseudobulk_padj"].isNotNull() | r["pseudobulk_log2fc"].isNotNull())
    strongest = F.array_min(F.transform(paired, lambda r: F.struct(
        F.coalesce(r["pseudobulk_padj"], F.lit(float("inf"))).alias("o"), r["cell_type"].alias("c"), r["pseudobulk_log2fc"].alias("e"), r["pseudobulk_padj"].alias("p"))))
    average = lambda r: r["average_expression"]
    gene = gene.withColumns({
        "_best": strongest,
        "_top": F.array_min(F.transform("_seen", lambda r: F.struct((-average(r)).alias("a"), r["cell_type"].alias("c"))))["c"],
        "_two": F.slice(F.sort_array(F.transform("_seen", average), asc=False), 1, 2),
        "_total": F.aggregate("_seen", F.lit(0.0), lambda s, r: s + F.greatest(F.lit(0.0), average(r))),
        "expression_symbol": F.array_min(F.filter(symbols, present)),
    })
    # Near ties are called ambiguous.
    top, second = F.get("_two", F.lit(0)), F.get("_two", F.lit(1))
    close = second.isNotNull() & (F.abs(top - second) <= delta * F.greatest(top, F.lit(1e-9)))
    some = F.size("_seen") > 0
    return gene.select(
        GENE, "_types", "_rows", F.col("_bulk.gene_symbol").alias("bulk_symbol"), F.col("_bulk.effect").alias("bulk_log2fc"), F.col("_bulk.padj").alias("bulk_padj"), F.col("_bulk").isNotNull().alias("has_bulk"),
        "bulk_meta_padj", "bulk_dataset_support", "pseudobulk_dataset_support", "_ambiguous", "_driven", "_status", "expression_symbol",
        F.col("_best.c").alias("best_cell_type"), F.col("_best.e").alias("best_pb_effect"), F.col("_best.p").alias("best_pb_padj"),
        F.when(close, F.lit("ambiguous")).otherwise(F.col("_top")).alias("dominant_cell_type"),
        F.when(some, F.when(close, F.lit("ambiguous_dominant_cell_type")).otherwise(F.lit(SOURCE_NOTE))).alias("dominant_cell_type_note"),
        F.when(F.col("_total") > 0, top / F.col("_total")).otherwise(F.lit(0.0)).alias("cell_type_specificity"),
    )


def unmapped(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of every input whose gene could not be mapped to one canonical id."""
    names = ["original_gene_id", "mapping_status", "mapping_source", "duplicate_resolution_method"]
    out = None
    for t in tables:
        part = t.where(F.col("mapping_status").isin("unmapped", "ambiguous_one_to_many")).select(*names, F.col("mapping_status").alias("reason"))
        out = part if out is None else out.unionByName(part)
    return out


def integrate(
    bulk: DataFrame, bulk_meta: DataFrame, pb: DataFrame, pb_meta: DataFrame, markers: DataFrame, avg: DataFrame, frac: DataFrame,
    loo: DataFrame, validation: DataFrame, ontology: DataFrame, mapping: DataFrame,
    weights: Mapping[str, float] | None = None, delta: float = 0.05, versions: bool = True, deconvolution: bool = False, only: str | None = None,
) -> dict[str, DataFrame]:
    """All result tables by name; ``only`` names one that is wanted, and what it does not need is left out.

    The inputs are read several times: tables that cost a pass over raw counts should be reduced before (``reuse``).
    """
    weights = {**WEIGHTS, **(weights or {})}
    tables = {"bulk": bulk, "bulk_meta": bulk_meta, "pb": pb, "pb_meta": pb_meta, "markers": markers, "avg": avg, "frac": frac}
    unresolved = unmapped([map_genes(df, mapping, versions) for df in tables.values()])
    if only == "unmapped_genes":
        return {only: unresolved}
    # Every row of evidence meets its canonical ids in one join and its gene in one shuffle; the rest works within genes.
    facts = evidence_facts(tables)
    codes = reuse(resolve_genes(facts, mapping, versions))
    known = facts.join(codes, "original_gene_id")
    kinds = ontology.where(F.col("review_status") == "confirmed").select(
        next(F.col(c) for c in ("harmonized_level2", "cell_type", "author_label") if c in ontology.columns).alias("cell_type")
    ).distinct()
    stable = loo.select(F.col("gene_id").alias(GENE), (F.lower("dataset_driven") == "true").alias("_driven"))
    checked = validation.select(F.col("gene_id").alias(GENE), F.col("replication_status").alias("_status"))
    g = by_gene(known.unionByName(stable, allowMissingColumns=True).unionByName(checked, allowMissingColumns=True), kinds, delta)
    g = g.withColumns(
        {
            "dominant_cell_type": F.coalesce("dominant_cell_type", F.lit("missing")),
            "dominant_cell_type_note": F.coalesce("dominant_cell_type_note", F.lit("missing_cell_type_expression")),
            "cell_type_specificity": F.coalesce("cell_type_specificity", F.lit(0.0)),
            "gene_symbol": F.coalesce("bulk_symbol", "expression_symbol", F.lit("NA")),
            "bulk_dataset_support": F.coalesce("bulk_dataset_support", F.lit(0)),
            "pseudobulk_dataset_support": F.coalesce("pseudobulk_dataset_support", F.lit(0)),
            "_driven": F.coalesce("_driven", F.lit(False)),
            "validation_replication_status": F.coalesce("_status", F.lit("not_available")),
        }
    ).withColumn("direction_consistency", direction("bulk_log2fc", "best_pb_effect"))
    g = g.withColumn("pseudobulk_meta_padj", _of_type(F.coalesce("best_cell_type", "dominant_cell_type"))["_pb_meta"]).drop("_types")
    few = F.col("bulk_dataset_support") <= 1
    replication = F.col("validation_replication_status")
    limits = kept(
        (F.col("direction_consistency") == "opposite", "bulk_pseudobulk_opposite_direction"),
        (few, "single_gse_support"),
        (F.col("dominant_cell_type") == "ambiguous", "ambiguous_dominant_cell_type"),
        (F.col("dominant_cell_type") == "missing", "missing_cell_type_expression"),
        (~replication.isin("replicated", "not_available", "NA", ""), "validation_failed"),
        (F.coalesce("_ambiguous", F.lit(False)), "ambiguous_one_to_many"),
    )
    parts = {
        "bulk_stat_score": p_score("bulk_padj"),
        "bulk_meta_score": p_score("bulk_meta_padj"),
        "pseudobulk_score": p_score("best_pb_padj"),
        "direction_consistency_score": F.when(F.col("direction_consistency") == "same", F.lit(1.0)).otherwise(F.lit(0.0)),
        "celltype_specificity_score": F.col("cell_type_specificity"),
        "cross_gse_score": F.least(F.lit(1.0), (F.col("bulk_dataset_support") + F.col("pseudobulk_dataset_support")) / 4.0),
        "validation_score": F.when(replication == "replicated", F.lit(1.0)).otherwise(F.lit(0.0)),
        "pathway_support_score": F.lit(0.0),
        "loo_stability_score": F.when(F.col("_driven"), F.lit(0.0)).otherwise(F.lit(1.0)),
    }
    weight = sum(max(0.0, float(w)) for w in weights.values()) or 1.0
    g = g.withColumns({**parts, "_limits": F.array_sort(F.array_distinct(limits)), "dataset_driven": bool_text(F.col("_driven") | (few & (F.col("pseudobulk_dataset_support") == 0)))})
    g = g.withColumn("total_score", sum((F.col(n) * float(weights.get(n, 0.0)) for n in parts), F.lit(0.0)) / weight)
    g = reuse(g.withColumn("evidence_level", evidence_level("total_score")).withColumn("confidence", confidence("evidence_level", F.col("_limits"))))
    wide = g.select(
        GENE, "gene_symbol", "bulk_log2fc", "bulk_padj", "dominant_cell_type", "dominant_cell_type_note", "cell_type_specificity", "total_score", F.explode("_rows").alias("_row")
    ).select("*", "_row.*").drop("_row")
    wide = wide.withColumn("effect_direction_consistency", direction("bulk_log2fc", "pseudobulk_log2fc"))
    # The sign a dataset must agree with: bulk when there is one, else the last cell row's.
    last = F.array_max(F.transform("_rows", lambda r: F.struct(
        r["missing_cell_type"].cast("int").alias("m"), F.coalesce(-r["average_expression"], F.lit(0.0)).alias("a"), r["cell_type"].alias("c"), r["pseudobulk_log2fc"].alias("e"))))
    consensus = g.select(GENE, sign(F.when(F.col("has_bulk"), F.col("bulk_log2fc")).otherwise(last["e"])).alias("_sign"))
    genes = g.select(GENE)
    modality = F.when(F.col("kind") == "bulk", F.lit("bulk")).otherwise(F.lit("pseudobulk")).alias("modality")
    support = known.where(F.col("kind").isin("bulk", "pb") & present("dataset_id")).select("*", modality)
    support = support.join(consensus, GENE, "left").select(
        GENE, "gene_symbol", "dataset_id", "modality", "effect", "padj",
        bool_text((sign("effect") == F.col("_sign")) & (sign("effect") != 0)).alias("supports_consensus_direction"),
        bool_text(F.col("padj") < 0.05).alias("is_significant"),
    )
    nothing = F.lit(None).cast("double")
    placeholder = genes.crossJoin(F.broadcast(when_empty(support))).select(  # one row or none
        GENE, F.lit("NA").alias("gene_symbol"), F.lit("NA").alias("dataset_id"), F.lit("NA").alias("modality"), nothing.alias("effect"), nothing.alias("padj"),
        F.lit("false").alias("supports_consensus_direction"), F.lit("false").alias("is_significant"),
    )
    spark = bulk.sparkSession
    ready = "interface_ready_not_interpreted_as_causality"
    return {
        "gene_celltype_mapping": wide.select(
            F.coalesce("original_gene_id", GENE).alias("original_gene_id"), GENE, "gene_symbol",
            *[F.coalesce(c, F.lit("identity")).alias(c) for c in ("mapping_source", "mapping_status", "duplicate_resolution_method")],
            "cell_type", "average_expression", "expression_cell_fraction",
            bool_text(F.col("cell_type") == F.col("dominant_cell_type")).alias("is_dominant_cell_type"),
            F.when(F.col("missing_cell_type"), F.lit("missing_cell_type")).otherwise(F.col("dominant_cell_type_note")).alias("dominant_cell_type_note"),
        ),
        "bulk_scrna_concordance": wide.select(
            GENE, "gene_symbol", "cell_type", "bulk_log2fc", "bulk_padj", "pseudobulk_log2fc", "pseudobulk_padj", "effect_direction_consistency", "dominant_cell_type",
            F.lit(SOURCE_NOTE).alias("dominant_cell_type_interpretation"), "cell_type_specificity",
        ),
        "consensus_genes": g.select(
            GENE, "gene_symbol", "bulk_dataset_support", "pseudobulk_dataset_support", "direction_consistency", "bulk_meta_padj", "pseudobulk_meta_padj",
            bool_text(~F.col("_driven")).alias("loo_stable"), "dataset_driven", "validation_replication_status", "evidence_level",
        ),
        "candidate_gene_scores": g.select(
            GENE, "gene_symbol", *parts, "total_score", "evidence_level", joined_or(F.col("_limits"), "none").alias("limitations"), "dataset_driven", "confidence",
            F.lit("false").alias("is_final_biological_conclusion"), F.lit("human_review_required").alias("required_action"),
        ),
        "dataset_support_matrix": support.unionByName(placeholder),
        "celltype_specific_effects": wide.select(
            GENE, "gene_symbol", "cell_type", "average_expression", "expression_cell_fraction", "pseudobulk_log2fc", "pseudobulk_padj", "cell_type_specificity", "dominant_cell_type", "effect_direction_consistency"
        ),
        "unmapped_genes": unresolved,
        "dotplot": wide.select(GENE, "gene_symbol", "cell_type", "average_expression", "expression_cell_fraction", "total_score"),
        "heatmap": wide.select(GENE, "gene_symbol", "cell_type", F.col("pseudobulk_log2fc").alias("value"), F.lit("pseudobulk_log2fc").alias("value_type")),
        "effect_scatter": wide.select(GENE, "gene_symbol", "cell_type", "bulk_log2fc", "pseudobulk_log2fc", "effect_direction_consistency"),
        "candidate_evidence_plot": g.select(GENE, "gene_symbol", *parts).unpivot([GENE, "gene_symbol"], list(parts), "component", "score"),
        "sankey_edges": g.select(F.lit("bulk_DEG").alias("source"), F.col("dominant_cell_type").alias("target"), F.lit(1).alias("value"), F.lit("potential_expression_source_not_causal").alias("edge_type")),
        "consensus_pathways": spark.range(1).select(
            F.lit("NA").alias("pathway_id"), F.lit("not_run").alias("pathway_name"), F.lit("").alias("supporting_genes"), F.lit(0).alias("pathway_support_score"), F.lit("pathway_support_input_not_provided").alias("limitations")
        ),
        "deconvolution_interface": spark.range(1).select(
            F.lit(ready if deconvolution else "disabled").alias("status"), F.lit("single_cell_reference" if deconvolution else "NA").alias("signature_source"), F.lit("NA").alias("cell_type"),
            F.lit("NA").alias("bulk_cell_fraction_change"), F.lit("NA").alias("within_celltype_transcription_change"),
            F.lit("distinguish_cell_fraction_change_from_within_celltype_transcription;not_cell_migration_or_disease_causality").alias("interpretation_limitations"),
        ),
    }


def cell_type_expression(cells: DataFrame, cell_counts: DataFrame, cell_type: str = "cell_type", dense: bool = False, above: float = 0.0) -> DataFrame:
    """Mean count and share of cells above ``above`` per gene and cell type.

    Over the rows present, as a long table has them; ``dense`` divides by all
    cells of the type instead.
    """
    joined = cell_counts.join(cells.select("cell_id", F.col(cell_type).alias("cell_type")), "cell_id")
    sums = joined.groupBy("gene_id", "cell_type").agg(F.sum("count").alias("_s"), F.count_if(F.col("count") > above).alias("_d"), F.count(F.lit(1)).alias("_n"))
    if dense:
        sizes = cells.groupBy(F.col(cell_type).alias("cell_type")).agg(F.count(F.lit(1)).alias("_all"))
        sums = sums.join(sizes, "cell_type").withColumn("_n", F.col("_all"))
    return sums.select("gene_id", "cell_type", (F.col("_s") / F.col("_n")).alias("mean_expression"), (F.col("_d") / F.col("_n")).alias("pct_expression"))


def dominant_cell_type(expression: DataFrame) -> DataFrame:
    """Best type by mean, then share; the score is the share."""
    best = best_rows(expression, ["gene_id"], [-F.col("mean_expression"), -F.col("pct_expression"), F.col("cell_type")])
    return best.select("gene_id", F.col("cell_type").alias("dominant_cell_type"), "mean_expression", "pct_expression", F.col("pct_expression").alias("total_score"), F.lit("expression_only").alias("evidence_level"), F.lit("low").alias("confidence"))


def missing_rows(df: DataFrame, name: str) -> DataFrame:
    return df.where(is_missing(name))
