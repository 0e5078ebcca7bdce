"""Pooling, leave-one-out, validation and integration on small evidence."""

import json
import math

import numpy as np
import pytest

from countloom.operators import compat, integrate, meta
from countloom.operators.rules import design

SCHEMA = "gene_id string, gene_symbol string, dataset_id string, log2FoldChange double, lfcSE double, pvalue double, sample_size double"


def evidence(spark, rows):
    return spark.createDataFrame([(g, "SYM", d, float(e), float(s), float(p), float(n)) for g, d, e, s, p, n in rows], SCHEMA)


def brute(effects, errors):
    e, v = np.array(effects), np.array(errors) ** 2
    w = 1 / v
    fixed = (w * e).sum() / w.sum()
    q, df = (w * (e - fixed) ** 2).sum(), len(e) - 1
    tau2 = max(0.0, (q - df) / (w.sum() - (w**2).sum() / w.sum()))
    r = 1 / (v + tau2)
    return fixed, math.sqrt(1 / w.sum()), (r * e).sum() / r.sum(), math.sqrt(1 / r.sum()), q, tau2


ROWS = [("g1", "D1", 1.0, 0.2, 0.001, 10), ("g1", "D2", 1.4, 0.3, 0.01, 20), ("g1", "D3", 0.7, 0.25, 0.03, 5),
        ("g2", "D1", 1.0, 0.2, 0.001, 10), ("g2", "D2", -1.0, 0.2, 0.001, 20), ("g3", "D1", 0.4, 0.2, 0.2, 10), ("g4", "D2", float("nan"), 0.2, 0.2, 1), ("g4", "D1", 0.0, 0.1, 0.9, 9), ("g4", "D3", 0.1, 0.1, 0.5, 9)]


@pytest.mark.parametrize("method", meta.METHODS)
def test_pooling_matches_closed_forms(spark, method):
    table = {r.gene_id: r for r in meta.meta(evidence(spark, ROWS), method, 0.05, 2).collect()}
    assert set(table) == {"g1", "g2", "g4"}
    fixed, fixed_se, random, random_se, q, tau2 = brute([1.0, 1.4, 0.7], [0.2, 0.3, 0.25])
    r = table["g1"]
    want = (fixed, fixed_se) if method == "fixed_effect" else (random, random_se)
    assert np.allclose((r.pooled_log2fc, r.pooled_se, r.Q, r.tau2), (*want, q, tau2))
    assert np.isclose(r.Q_pvalue, math.exp(-q / 2))
    assert table["g2"].direction_consistency == "mixed" and r.direction_consistency == "consistent_up" and table["g4"].direction_consistency == "mixed"
    assert r.n_studies == 3 and r.significant_study_count == 3 and table["g4"].n_studies == 2
    assert json.loads(r.dataset_specific_effects)["D2"]["log2FoldChange"] == 1.4
    if method == "fisher":
        x = -2 * sum(math.log(p) for p in (0.001, 0.01, 0.03))
        assert np.isclose(r.meta_pvalue, math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(3)))
    if method.endswith("effects") or method == "fixed_effect":
        assert np.isclose(r.meta_pvalue, math.erfc(abs(want[0] / want[1]) / math.sqrt(2)))


def test_rank_aggregation_uses_rank_before_filtering(spark):
    rows = [("a", "D1", 1, 0.1, 0.01, 1), ("b", "D1", 1, 0.1, 0.5, 1), ("a", "D2", 1, 0.1, 0.02, 1), ("b", "D2", 1, 0.1, 0.6, 1)]
    table = {r.gene_id: r.meta_pvalue for r in meta.meta(evidence(spark, rows), "robust_rank_aggregation").collect()}
    # a has rank 1/2 twice: min(1 - 0.25, 0.25) x 2 studies.
    assert np.isclose(table["a"], 0.5) and table["b"] == 1.0


def test_leave_one_out_flags_the_driving_dataset(spark):
    rows = [("g", "D1", 3.0, 0.2, 1e-6, 10), ("g", "D2", -0.2, 0.2, 0.4, 10), ("g", "D3", -0.2, 0.2, 0.4, 10), ("s", "D1", 1.0, 0.1, 1e-9, 10), ("s", "D2", 1.05, 0.1, 1e-9, 10), ("s", "D3", 0.95, 0.1, 1e-9, 10)]
    summary, detail = meta.leave_one_out(evidence(spark, rows), "random_effects")
    found = {r.gene_id: r for r in summary.collect()}
    assert found["g"].dataset_driven == "true" and found["s"].dataset_driven == "false"
    assert found["s"].excluded_dataset_count == 3 and detail.count() == 6
    again = {r.gene_id: r for r in meta.leave_one_out(evidence(spark, rows[::-1]).repartition(5), "random_effects")[0].collect()}
    assert np.isclose(again["g"].max_effect_change, found["g"].max_effect_change)


def test_validation_ladder(spark):
    d = [(g, "D1", e, 0.1, 0.001, 5) for g, e in (("rep", 2), ("mis", 2), ("weak", 2), ("none", 2), ("small", 0.1))]
    v = [("rep", "V", 1.5, 0.1, 0.001, 5), ("mis", "V", -1.5, 0.1, 0.001, 5), ("weak", "V", 0.1, 1.0, 0.9, 5), ("small", "V", 1, 0.1, 0.1, 5)]
    out = {r.gene_id: r.replication_status for r in meta.stratified_validation(evidence(spark, d), evidence(spark, v), "fixed_effect", 0.05, 0.05, 1.0).collect()}
    assert out == {"rep": "replicated", "mis": "direction_mismatch", "weak": "not_significant_in_validation", "none": "not_tested_in_validation", "small": "not_discovery_candidate"}


def test_pseudobulk_validation_has_no_candidate_condition(spark):
    from pyspark.sql import functions as F

    d = evidence(spark, [("g", "D1", 0.01, 0.5, 0.9, 5), ("g", "D2", 0.02, 0.5, 0.9, 5)]).withColumn("cell_type", F.lit("T"))
    v = evidence(spark, [("g", "V1", 1.5, 0.1, 0.001, 5), ("g", "V2", 1.4, 0.1, 0.001, 5)]).withColumn("cell_type", F.lit("T"))
    assert meta.pseudobulk_validation(d, v, "random_effects", 0.05, 2, 0.05).first().replication_status == "replicated"
    assert meta.pseudobulk_meta(v, "random_effects", 0.05, 2).first().n_subjects == 10


def test_no_family_is_one_task_of_leave_one_out(spark, monkeypatch):
    plans, pooled = [], meta.meta

    def seen(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return pooled(rows, *args)

    monkeypatch.setattr(meta, "meta", seen)
    rows = evidence(spark, ROWS)
    rows = rows.selectExpr("*", "'C' AS contrast_id")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stable = meta.leave_one_out(rows, "fixed_effect", by=["contrast_id"])[0]
        assert {r.gene_id for r in stable.collect()} == {"g1", "g2", "g4"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plans) == 2 and not [p for p in plans if "SortMergeJoin" in p]


def test_dominance_and_confounding(spark):
    rows = spark.createDataFrame([("A", "GSE1", "case", "case", "control")] * 9 + [("A", "GSE2", "control", "case", "control")], "analysis_id string, dataset_id string, group string, numerator string, denominator string")
    top = design.dominant_dataset(rows, 0.8, ["analysis_id"]).first()
    assert (top.dataset_id, round(top.fraction, 6)) == ("GSE1", 0.9)
    assert design.confounded(rows, ["analysis_id"]).count() == 1
    mixed = rows.unionByName(spark.createDataFrame([("A", "GSE1", "control", "case", "control")], rows.schema))
    assert design.confounded(mixed, ["analysis_id"]).count() == 0


def test_integration_limits_and_missing_types(spark):
    b = spark.createDataFrame([("ENSG1.2", "D1", 2.0, 0.001), ("ENSG1.2", "D2", 1.5, 0.002), ("X", "D1", 1.0, 0.01)], "gene_id string, dataset_id string, log2FoldChange double, padj double")
    bm = spark.createDataFrame([("ENSG1", 1.8, 1e-6)], "gene_id string, pooled_log2fc double, meta_padj double")
    pb = spark.createDataFrame([("ENSG1", "D1", "T", -1.0, 0.001)], "gene_id string, dataset_id string, cell_type string, log2FoldChange double, padj double")
    pm = spark.createDataFrame([], "gene_id string, cell_type string, pooled_log2fc double, meta_padj double")
    avg = spark.createDataFrame([("ENSG1", "T", 4.0), ("ENSG1", "B", 1.0)], "gene_id string, cell_type string, average_expression double")
    frac = spark.createDataFrame([("ENSG1", "T", 0.5)], "gene_id string, cell_type string, expression_cell_fraction double")
    loo = spark.createDataFrame([("C1", "true")], "gene_id string, dataset_driven string")
    val = spark.createDataFrame([("C1", "replicated")], "gene_id string, replication_status string")
    ont = spark.createDataFrame([("T", "confirmed"), ("NK", "confirmed"), ("Z", "pending")], "harmonized_level2 string, review_status string")
    mapping = spark.createDataFrame([("ENSG1", "C1", "S1"), ("X", "CX", "SX"), ("X", "CY", "SY")], "original_gene_id string, canonical_gene_id string, gene_symbol string")
    out = integrate.integrate(b, bm, pb, pm, b.limit(0), avg, frac, loo, val, ont, mapping)
    score = {r.canonical_gene_id: r for r in out["candidate_gene_scores"].collect()}
    assert set(score) == {"C1", "CX", "CY"}
    assert score["C1"].limitations == "bulk_pseudobulk_opposite_direction" and score["C1"].dataset_driven == "true" and score["C1"].validation_score == 1.0
    assert "ambiguous_one_to_many" in score["CX"].limitations and "missing_cell_type_expression" in score["CX"].limitations
    types = {r.cell_type: r for r in out["gene_celltype_mapping"].where("canonical_gene_id = 'C1'").collect()}
    assert set(types) == {"T", "B", "NK"} and types["NK"].dominant_cell_type_note == "missing_cell_type" and types["T"].is_dominant_cell_type == "true"
    assert out["unmapped_genes"].count() == 2 and out["consensus_pathways"].count() == 1


def test_integration_shuffles_genes_once_and_merges_ids(spark, monkeypatch):
    writes, write = [], integrate.reuse

    def seen(df):
        writes.append(df.columns)
        return write(df)

    monkeypatch.setattr(integrate, "reuse", seen)
    b = spark.createDataFrame([("A", "D1", 1.0, 0.001), ("B", "D2", -2.0, 0.0001), ("B", "D1", 0.5, 0.2)], "gene_id string, dataset_id string, log2FoldChange double, padj double")
    bm = spark.createDataFrame([], "gene_id string, pooled_log2fc double, meta_padj double")
    pb = spark.createDataFrame([("A", "D1", "T", 3.0, None), ("B", "D2", "T", -1.0, 0.01), ("B", "D3", "missing", 1.0, 0.001), ("Q", "D1", None, 1.0, 0.5)], "gene_id string, dataset_id string, cell_type string, log2FoldChange double, padj double")
    pm = spark.createDataFrame([("A", "T", 1.0, 0.3), ("B", "T", 1.0, 0.2)], "gene_id string, cell_type string, pooled_log2fc double, meta_padj double")
    avg = spark.createDataFrame([("A", "T", 4.0), ("B", "T", 1.0), ("B", None, 2.0)], "gene_id string, cell_type string, average_expression double")
    frac = spark.createDataFrame([("B", "T", 0.5), ("A", "T", 0.25), ("B", None, 0.1), ("only", "T", 1.0)], "gene_id string, cell_type string, expression_cell_fraction double")
    loo, val = (spark.createDataFrame([], f"gene_id string, {c} string") for c in ("dataset_driven", "replication_status"))
    ont = spark.createDataFrame([("T", "confirmed"), ("NK", "confirmed")], "harmonized_level2 string, review_status string")
    mapping = spark.createDataFrame([("A", "C", "SA"), ("B", "C", "SB")], "original_gene_id string, canonical_gene_id string, gene_symbol string")
    out = integrate.integrate(b, bm, pb, pm, b.limit(0), avg, frac, loo, val, ont, mapping)
    assert len(writes) <= 2
    rows = {(r.canonical_gene_id, r.cell_type, r.average_expression): (r.pseudobulk_log2fc, r.expression_cell_fraction) for r in out["celltype_specific_effects"].collect()}
    assert rows == {("C", "T", 4.0): (-1.0, 0.5), ("C", "T", 1.0): (-1.0, 0.5), ("C", None, 2.0): (None, None), ("C", "NK", None): (None, None),
                    ("Q", "missing", None): (None, None), ("Q", "T", None): (None, None), ("Q", "NK", None): (None, None)}
    both = {r.canonical_gene_id: r for r in out["consensus_genes"].collect()}
    assert (both["C"].gene_symbol, both["C"].bulk_dataset_support, both["C"].pseudobulk_dataset_support, both["C"].pseudobulk_meta_padj) == ("SB", 2, 2, 0.2)
    assert set(both) == {"C", "Q"} and both["C"].direction_consistency == "same"


def test_compatibility_reasons(spark):
    cols = "dataset_id string, sample_id string, subject_id string, gsm_id string, srr_id string, include string, review_status string, data_type string, tissue string, library_layout string, matrix_path string, fastq_r1 string, fastq_r2 string, group string"
    rows = [(d, f"{d}{i}", f"{d}{i}", f"{d}{i}", f"{d}{i}", "true", "confirmed", "bulk", "liver", "PAIRED", f"{d}.tsv", "NA", "NA", g) for d in ("D1", "D2") for i, g in enumerate(("case", "control"))]
    samples = spark.createDataFrame(rows, cols)
    plan = spark.createDataFrame([("A", d, "true", "discovery", "joint_model") for d in ("D1", "D2")], "analysis_id string, dataset_id string, include string, role string, analysis_strategy string")
    contrasts = spark.createDataFrame([("C", "A", "bulk", "case", "control", "true")], "contrast_id string, analysis_id string, data_scope string, numerator string, denominator string, enabled string")
    refs = {"species": "human", "genome_build": "GRCh38", "annotation_release": "v1", "gene_id_space": "e"}
    facts = {d: {"platform": "p", "library_strategy": "RNA-Seq", "quantification_source": "star", "allow_author_counts_joint_model": "true"} for d in ("D1", "D2")}
    good = compat.compatibility(samples, plan, contrasts, compat.technical_profile(samples, facts, refs)).collect()
    assert {r.compatible_for_joint_model for r in good} == {"true"} and {r.incompatibility_reason for r in good} == {"none"}
    facts["D2"]["species"] = "mouse"
    bad = compat.compatibility(samples, plan, contrasts, compat.technical_profile(samples, facts, refs)).collect()
    assert {r.compatible_for_meta_analysis for r in bad} == {"false"} and all("incompatible_or_unknown_species" in r.incompatibility_reason for r in bad)
    with pytest.raises(ValueError):
        compat.strategy_of(plan, "B")
    assert compat.strategy_of(plan, "A") == "joint_model"


def test_connected_chain_is_one_component(spark):
    import random

    from countloom.operators.network import connected

    ids = list(range(400))
    random.Random(3).shuffle(ids)
    edges = spark.createDataFrame([("d", a, b) for a, b in zip(ids, ids[1:])], "dataset_id string, a long, b long")
    nodes = spark.createDataFrame([("d", i) for i in range(401)], "dataset_id string, node long")
    labels = {r["node"]: r["label"] for r in connected(nodes, edges, ["dataset_id"]).collect()}
    assert set(labels.values()) == {0, 400} and labels[400] == 400


def test_neighbours_of_equal_vectors_are_the_smallest_ids(spark):
    from countloom.operators.cellgraph import knn

    vectors = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], "id long, vector array<double>")
    near = knn(vectors, 5).where("id = 7").collect()
    assert sorted(r["neighbor"] for r in near) == [0, 1, 2, 3, 4]


def test_unmapped_genes_alone_need_no_other_step(spark, monkeypatch):
    from countloom.operators import integrate as N
    from countloom.plans import integration_queries as Q
    from countloom.plans.views import Views

    views = Views(spark, "/root/testdata/sf0.001")
    whole = Q.tables(views)["unmapped_genes"]
    monkeypatch.setattr(N, "reuse", lambda df: pytest.fail("a step that unmapped genes do not need"))
    alone = Q.tables(views, "unmapped_genes")
    assert list(alone) == ["unmapped_genes"]
    assert sorted(map(str, alone["unmapped_genes"].collect())) == sorted(map(str, whole.collect()))


def test_contrast_status_runs_no_test(spark, monkeypatch):
    from countloom.operators import pseudobulk
    from countloom.plans import design_queries as Q

    monkeypatch.setattr(pseudobulk, "two_group_test", lambda *args, **named: pytest.fail("the status needs units only"))
    status = Q.queries.callables()["pseudobulk_contrast_status"](spark, "/root/testdata/sf0.001")
    assert status.count() > 0
