"""Count, cell and graph operators against numpy on small fixtures."""

import itertools
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from countloom.operators import cellgraph, cells, counts, enrich, network, pairwise, proportions, pseudobulk, testing
from countloom.operators.rules import matrix

RNG = np.random.default_rng(5)


def long_counts(spark, table, dataset="D"):
    rows = [(dataset, f"g{i}", f"s{j}", int(v)) for i, row in enumerate(table) for j, v in enumerate(row) if v]
    return spark.createDataFrame(rows, "dataset_id string, gene_id string, sample_id string, count bigint")


def test_gram_tiles_agree(spark):
    table = RNG.poisson(2.0, (40, 7))
    df = long_counts(spark, table).withColumn("x", F.col("count").cast("double"))
    expected = table.T @ table
    for tiles in (1, 3):
        got = {(r.col_i, r.col_j): r.dot for r in pairwise.gram(df.repartition(4), ["dataset_id"], "gene_id", "sample_id", "x", tiles).collect()}
        for i, j in itertools.combinations_with_replacement(range(7), 2):
            assert got.get((f"s{i}", f"s{j}"), 0.0) == expected[i, j]


def test_pca_matches_svd(spark):
    table = RNG.poisson(20.0, (30, 6))
    x = np.log2(table + 1.0).T
    x = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    want = u[:, :3] * s[:3]
    got = {r.sample_id: [r.PC1, r.PC2, r.PC3] for r in counts.sample_pca(long_counts(spark, table), 3).collect()}
    mine = np.array([got[f"s{j}"] for j in range(6)])
    assert np.allclose(np.abs(mine), np.abs(want), atol=1e-6)


def test_sample_qc_flags_and_keeps_outliers(spark):
    table = np.vstack([RNG.poisson(50.0, 8) for _ in range(25)])
    table[:, 7] *= 40
    samples = spark.createDataFrame([("D", f"s{j}", "case", "b", f"p{j}") for j in range(8)], "dataset_id string, sample_id string, group string, batch string, subject_id string")
    out = {r.sample_id: r for r in counts.sample_qc(long_counts(spark, table), samples, z=3.0).collect()}
    assert len(out) == 8 and "library_size" in out["s7"].flagged_metrics and out["s7"].retained_for_analysis == "true"
    size = table.sum(axis=0)
    logs = np.log10(size + 1)
    mad = np.median(np.abs(logs - np.median(logs)))
    assert math.isclose(out["s7"].library_size_robust_z, 0.6744897501960817 * (logs[7] - np.median(logs)) / mad, rel_tol=1e-9)


def test_robust_z_fallbacks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 1.0), ("a", 5.0), ("b", 2.0), ("b", 2.0)], "f string, x double")
    out = counts.robust_z(df, ["x"], ["f"]).collect()
    a = [r.x_robust_z for r in out if r.f == "a" and r.x == 5.0][0]
    assert math.isclose(a, 3.0 / np.std([1, 1, 1, 5])) and all(r.x_robust_z == 0.0 for r in out if r.f == "b")


def test_two_group_test_finds_the_planted_gene(spark):
    table = RNG.poisson(100.0, (60, 8))
    table[0, :4] *= 8
    samples = spark.createDataFrame([("D", f"s{j}", "case" if j < 4 else "control", "b" if j % 2 else "a") for j in range(8)], "dataset_id string, sample_id string, group string, batch string")
    out = {r.gene_id: r for r in testing.two_group_test(long_counts(spark, table), samples, "case", "control").collect()}
    assert abs(out["g0"].log2FoldChange - 3) < 0.3 and out["g0"].padj < 1e-6 and np.median([abs(r.log2FoldChange) for r in out.values()]) < 0.2
    fit = {r.gene_id: r for r in testing.contrast_test(long_counts(spark, table), samples, "case", "control", "~ group + batch").collect()}
    assert abs(fit["g0"].log2FoldChange - 3) < 0.3 and fit["g0"].padj < 1e-4
    with pytest.raises(ValueError):
        testing.contrast_test(long_counts(spark, table), samples.withColumn("copy", F.col("group")), "case", "control", "~ group + copy")


def test_pseudobulk_merges_samples_of_one_subject(spark):
    c = spark.createDataFrame([("c1", "D", "S1", "P", "case", "T"), ("c2", "D", "S1", "P", "case", "T"), ("c3", "D", "S2", "P", "case", "T"), ("c4", "D", "S2", "P", "case", "T"), ("c5", "D", "S3", "Q", "control", "T")],
                              "cell_id string, dataset_id string, sample_id string, subject_id string, group string, author_label string")
    k = spark.createDataFrame([(f"c{i}", g, i) for i in range(1, 6) for g in ("a", "b")], "cell_id string, gene_id string, count bigint")
    sums, about = pseudobulk.pseudobulk(c, k, 2)
    rows = {r.subject_id: r for r in about.collect()}
    assert (rows["P"].cell_count, rows["P"].sample_ids, rows["P"].sample_id, rows["P"].total_UMI) == (4, "S1;S2", "multiple", 20)
    assert rows["Q"].exclusion_reason == "min_cells_per_pseudobulk" and rows["P"].eligibility == "eligible"
    assert {(r.subject_id, r.gene_id): r["count"] for r in sums.collect()}[("P", "a")] == 10


def test_raw_counts_guard(spark):
    bad = spark.createDataFrame([(1.0,), (1.5,), (-1.0,), (float("nan"),), (None,), (float("inf"),)], "count double")
    assert matrix.raw_count_problems(bad).count() == 5
    with pytest.raises(ValueError):
        matrix.assert_raw_counts(bad, "layer")


def test_rank_sum_exact_and_normal(spark):
    def enumerate_p(a, b):
        both = a + b
        u = sum((x > y) for x in a for y in b)
        all_u = [sum((both[i] > both[j]) for i in pick for j in range(len(both)) if j not in pick) for pick in itertools.combinations(range(len(both)), len(a))]
        high = max(u, len(a) * len(b) - u)
        return min(1.0, 2 * sum(v >= high for v in all_u) / len(all_u))

    rows = [("D", f"c{i}", "case", "T", p) for i, p in enumerate((0.1, 0.4, 0.35))] + [("D", f"d{i}", "control", "T", p) for i, p in enumerate((0.5, 0.6, 0.7, 0.38))]
    props = spark.createDataFrame([(d, s, g, label, 1, p) for d, s, g, label, p in rows], "dataset_id string, subject_id string, group string, author_label string, cell_count bigint, proportion double")
    contrasts = spark.createDataFrame([("A", "C", "cell_proportion", "case", "control", "true")], "analysis_id string, contrast_id string, data_scope string, numerator string, denominator string, enabled string")
    plan = spark.createDataFrame([("A", "D", "true")], "analysis_id string, dataset_id string, include string")
    r = proportions.proportion_test(props, contrasts, plan).first()
    assert math.isclose(r.pvalue, enumerate_p([0.1, 0.4, 0.35], [0.5, 0.6, 0.7, 0.38])) and math.isclose(r.proportion_difference, 0.85 / 3 - 2.18 / 4)


def test_markers_match_dense_ranks(spark):
    table = RNG.poisson(0.7, (5, 14)).astype(float)
    groups = ["x" if j < 6 else "y" for j in range(14)]
    expr = spark.createDataFrame([(f"c{j}", f"g{i}", float(v)) for i, row in enumerate(table) for j, v in enumerate(row) if v], "cell_id string, gene_id string, value double")
    clusters = spark.createDataFrame([(f"c{j}", g) for j, g in enumerate(groups)], "cell_id string, cluster string")
    got = {(r.cluster, r.gene_id): r.score for r in cellgraph.markers(expr, clusters, None).collect()}
    for i, row in enumerate(table):
        ranks = np.array([(row < v).sum() + ((row == v).sum() + 1) / 2 for v in row])
        inside = np.array(groups) == "x"
        n1, n = inside.sum(), len(row)
        want = (ranks[inside].sum() - n1 * (n + 1) / 2) / math.sqrt(n1 * (n - n1) * (n + 1) / 12)
        if row.any():
            assert math.isclose(got[("x", f"g{i}")], want, abs_tol=1e-9)


def test_neighbours_do_not_depend_on_blocks(spark):
    points = RNG.normal(size=(60, 4))
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vector array<double>")
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    np.fill_diagonal(gaps, np.inf)
    for blocks in (1, 5):
        got = {}
        for r in cellgraph.knn(df, 3, blocks=blocks).collect():
            got.setdefault(r.id, set()).add(r.neighbor)
        assert all(got[i] == set(np.argsort(gaps[i])[:3]) for i in range(60))


def test_neighbours_of_asking_rows_with_many_ties(spark):
    grid = RNG.integers(0, 3, (700, 3)).astype(float)
    df = spark.createDataFrame([(f"n{i:04d}", [float(x) for x in p]) for i, p in enumerate(grid)], "id string, vector array<double>")
    gaps = np.linalg.norm(grid[:, None] - grid[None], axis=2)
    np.fill_diagonal(gaps, np.inf)
    for blocks in (1, 3):
        got = {}
        for r in cellgraph.knn(df, 40, blocks=blocks, asking=F.col("id") < "n0100").collect():
            got.setdefault(int(r.id[1:]), []).append((r.distance, int(r.neighbor[1:])))
        assert set(got) == set(range(100))
        for i, found in got.items():
            assert sorted(found) == [(gaps[i, j], j) for j in np.lexsort((np.arange(700), gaps[i]))[:40]]


def test_clusters_of_two_cliques(spark):
    edges = [(a, b) for base in (0, 10) for a in range(base, base + 6) for b in range(base, base + 6) if a < b]
    got = {r.id: r.cluster for r in cellgraph.cluster(spark.createDataFrame(edges, "id bigint, neighbor bigint")).collect()}
    assert len({got[i] for i in range(6)}) == 1 and len(set(got.values())) == 2


def test_clusters_settle(spark):
    pairs = sorted({tuple(sorted((int(a), int(b)))) for a, b in np.random.default_rng(11).integers(0, 40, (90, 2))} | {(i, i + 1) for i in range(50, 70)})
    edges = spark.createDataFrame(pairs, "id bigint, neighbor bigint")
    labels = cellgraph.cluster(edges)
    got = {r.id: r.cluster for r in labels.collect()}
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    assert set(got) == {i for p in pairs for i in p}
    links, sums = sum(map(len, near.values())), Counter()
    for node, others in near.items():
        sums[got[node]] += len(others)
    for node, others in near.items():
        votes, k = Counter(got[o] for o in others), len(others)
        score = {c: links * votes[c] - k * (sums[c] - k * (c == got[node])) for c in {*votes, got[node]}}
        assert max(score.values()) == score[got[node]]
    assert len({got[i] for i in range(50, 71)}) > 1
    quality = cellgraph.cluster_quality(edges, labels).first()
    inside = sum(got[a] == got[b] for a, b in pairs if a != b)
    assert (quality.unsettled, quality.edges_within, quality.single_cluster) == (0, inside, False)
    none = spark.createDataFrame([], "id bigint, neighbor bigint")
    assert cellgraph.cluster(none).count() == 0 and cellgraph.cluster_quality(none, cellgraph.cluster(none)).first().single_cluster


def test_cluster_turns_send_no_table_to_the_driver(spark, monkeypatch):
    plans, write = [], cellgraph.written

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(cellgraph, "written", seen)
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "id bigint, neighbor bigint")
    assert cellgraph.cluster(edges).count() == 7
    assert len(plans) > 4 and not [p for p in plans if "Broadcast" in p]


def test_components_of_a_long_chain(spark):
    nodes = spark.createDataFrame([("D", f"n{i:02d}") for i in range(30)], "dataset_id string, node string")
    edges = spark.createDataFrame([("D", f"n{i:02d}", f"n{i + 1:02d}") for i in range(29) if i != 14], "dataset_id string, a string, b string")
    labels = {r.node: r.label for r in network.connected(nodes, edges, ["dataset_id"]).collect()}
    assert {labels[f"n{i:02d}"] for i in range(15)} == {"n00"} and {labels[f"n{i:02d}"] for i in range(15, 30)} == {"n15"}


def test_cell_fractions_recover_a_mixture(spark):
    signature = RNG.uniform(1, 10, (30, 3))
    truth = np.array([0.6, 0.3, 0.1])
    mix = signature @ truth
    sig = spark.createDataFrame([(f"g{i}", f"t{j}", float(signature[i, j])) for i in range(30) for j in range(3)], "gene_id string, cell_type string, weight double")
    expr = spark.createDataFrame([("D", "s", f"g{i}", float(mix[i])) for i in range(30)], "dataset_id string, sample_id string, gene_id string, value double")
    got = {r.cell_type: r.fraction for r in network.cell_fractions(expr, sig, "value").collect()}
    assert np.allclose([got[f"t{j}"] for j in range(3)], truth, atol=1e-9)


def test_weights_keep_the_optimality_conditions():
    rng = np.random.default_rng(12)
    for columns in (1, 3, 6):
        for _ in range(40):
            a, y = rng.normal(size=(20, columns)), rng.normal(size=20)
            a[:, -1] = a[:, 0] if columns > 3 else a[:, -1]
            x = network._active_set(a.T @ a, a.T @ y)
            slope = a.T @ (a @ x - y)
            assert (x >= 0).all() and (slope >= -1e-9).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-9
    assert (network._active_set(np.eye(2), np.array([-1.0, -2.0])) == 0).all()


def test_clusters_ask_for_their_edges_once(spark):
    edges = spark.createDataFrame([(a, b) for a in range(6) for b in range(6) if a // 3 == b // 3], "id bigint, neighbor bigint")
    seen = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    assert len({r.cluster for r in cellgraph.cluster(edges.mapInPandas(tally, edges.schema)).collect()}) == 2
    assert seen.value == edges.count()


def test_survival_without_a_maximum_is_not_converged():
    def fit(x, time, event):
        return network._hazard(("D", "g"), pd.DataFrame({"x": x, "time": time, "event": event})).iloc[0]

    apart = fit([3.0, 2.0, 1.0, 0.0], [1.0, 2.0, 3.0, 4.0], [1.0, 1.0, 1.0, 1.0])
    assert not apart.converged
    mixed = fit([1.0, 0.0, 1.0, 0.0, 2.0, 1.0], [1.0, 1.0, 2.0, 3.0, 3.0, 4.0], [1.0, 1.0, 1.0, 1.0, 0.0, 1.0])
    assert mixed.converged and mixed.standard_error > 0
    assert not fit([1.0, 2.0], [1.0, 2.0], [0.0, 0.0]).converged


def test_survival_slope_zeroes_the_score(spark):
    time, event = RNG.exponential(5, 40), RNG.integers(0, 2, 40)
    x = RNG.normal(size=40) + (time < 3)
    expr = spark.createDataFrame([("D", "g", f"s{i}", float(v)) for i, v in enumerate(x)], "dataset_id string, gene_id string, sample_id string, value double")
    surv = spark.createDataFrame([("D", f"s{i}", float(t), int(e)) for i, (t, e) in enumerate(zip(time, event))], "dataset_id string, sample_id string, time double, event int")
    b = network.survival_scan(expr, surv).first().coefficient
    score = sum(x[i] - (np.exp(b * x[time >= time[i]]) * x[time >= time[i]]).sum() / np.exp(b * x[time >= time[i]]).sum() for i in range(40) if event[i])
    assert abs(score) < 1e-6


def test_enrichment_score_equals_the_full_walk(spark):
    stat = np.sort(RNG.normal(size=80))[::-1]
    member = {3, 5, 8, 20, 70, 1, 2}
    effects = spark.createDataFrame([(f"g{i:02d}", float(s)) for i, s in enumerate(stat)], "gene_id string, stat double")
    sets = spark.createDataFrame([("S", f"g{i:02d}") for i in member], "set_name string, gene_id string")
    hit = np.array([abs(stat[i]) if i in member else 0.0 for i in range(80)])
    walk = np.cumsum(hit / hit.sum() - np.array([0.0 if i in member else 1 / (80 - len(member)) for i in range(80)]))
    r = enrich.ranked_enrichment(effects, sets, permutations=30, min_size=2).first()
    assert math.isclose(r.ES, max(walk, key=abs), rel_tol=1e-9) and r.size == len(member) and 0 < r.pval <= 1


def test_doublets_get_a_status_per_sample(spark):
    c = spark.createDataFrame([(f"c{i}", "big" if i < 40 else "tiny") for i in range(45)], "cell_id string, sample_id string")
    k = spark.createDataFrame([(f"c{i}", f"g{j}", int(RNG.integers(1, 9))) for i in range(45) for j in range(10)], "cell_id string, gene_id string, count bigint")
    scores, status = cellgraph.doublet_score(c, k, 5, 10)
    assert {r.sample_id: r.status for r in status.collect()} == {"big": "completed", "tiny": "not_estimable_too_few_cells"}
    assert scores.count() == 40 and scores.where("doublet_score between 0 and 1").count() == 40
    flagged = cells.run_detector(c, k, lambda pdf, name: pdf[["cell_id"]].drop_duplicates().assign(doublet_score=0.9, predicted_doublet=True))
    assert flagged.count() == 45


def test_size_factors_without_a_complete_gene(spark):
    """No gene is free of zeros: factors come from positive counts, and a sample of zeros is kept."""
    exp, log = math.exp, math.log

    rows = [("D", "g1", "a", 2), ("D", "g1", "b", 8), ("D", "g2", "a", 4), ("D", "g3", "b", 4), ("D", "g1", "c", 0)]
    table = spark.createDataFrame(rows, "dataset_id string, gene_id string, sample_id string, count long")
    got = {r["sample_id"]: r for r in counts.size_factors(table).collect()}
    mean = {"g1": (log(2) + log(8)) / 3, "g2": log(4) / 3, "g3": log(4) / 3}
    a = (log(2) - mean["g1"] + log(4) - mean["g2"]) / 2
    b = (log(8) - mean["g1"] + log(4) - mean["g3"]) / 2
    assert abs(got["a"]["size_factor"] - exp(a - (a + b) / 2)) < 1e-9 and got["a"]["size_method"] == "positive"
    assert got["c"]["size_factor"] is None and got["c"]["size_method"] == "not_estimable"
    assert counts.size_normalize(table).count() == 5


def test_neighbours_are_exact_over_batches_and_lanes(spark):
    """Ties over batches, ids that ask twice, a row with no number, and no shuffle of candidates."""
    points = RNG.integers(0, 4, (150, 3)).astype(float)
    rows = [(f"f{i % 2}", f"n{i:03d}", points[i].tolist()) for i in range(150)] + [("f0", "n000", [9.0, 9.0, 9.0]), ("f1", "nan", [float("nan"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "family string, id string, vector array<double>")
    want = {}
    for family, name in {(f, i) for f, i, _ in rows}:
        found = [(math.dist(a, b), other) for f, i, a in rows if (f, i) == (family, name) for g, other, b in rows if g == family and other != name]
        want[family, name] = [(n, round(d, 9)) for d, n in sorted(x for x in found if x[0] == x[0])[:4]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        for lanes in (None, 3):
            near = cellgraph.knn(df, 4, ["family"], lanes)
            plan = near._jdf.queryExecution().executedPlan().toString()
            assert "Window" not in plan and plan.count("Exchange") == 1
            got = {}
            for r in near.collect():
                got.setdefault((r.family, r.id), []).append((r.distance, r.neighbor))
            assert {key: [(n, round(d, 9)) for d, n in sorted(v)] for key, v in got.items()} == {k: v for k, v in want.items() if v}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_neighbours_of_many_rows_are_counted_without_the_row_itself():
    """The bound of the smallest of each group leaves room for the asking row."""
    points = RNG.normal(size=(1500, 4))
    table = pd.DataFrame({"id": np.arange(1500), "vector": list(points)})
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    np.fill_diagonal(gaps, np.inf)
    for cuts in ([0, 1500], [0, 1100, 1500]):
        state = cellgraph._Nearest(table, 5)
        for first, last in zip(cuts, cuts[1:]):
            state.meet(table[first:last])
        found = pd.concat(state.result())
        assert (found["neighbor"].to_numpy().reshape(1500, 5) == np.argsort(gaps, axis=1)[:, :5]).all()


def test_doublet_profiles_are_the_sums_of_partners():
    """Genes of both partners are added before the logarithm; a cell without counts still has a partner; sums do not hang on cuts."""
    rows = [("s", 1, "a", "b", "g1", 2.0, 0, 1.0), ("s", 1, "b", "c", "g1", 3.0, 0, 1.0), ("s", 1, "b", "c", "g2", 5.0, 1, -1.0), ("s", 1, "c", "a", None, None, None, None), ("s", 2, "d", "d", "g2", 4.0, 1, -1.0)]
    table = pd.DataFrame(rows, columns=["sample_id", "_bucket", "cell_id", "_next", "gene_id", "count", "_slot", "_sign"])
    want = {"a": [2, 0], "b": [3, 5], "d": [0, 4], "sim:a": [5, 5], "sim:b": [3, 5], "sim:c": [2, 0]}
    for cut in (1, 2, 5):
        made = pd.concat(cellgraph._profiles(iter([table[i: i + cut] for i in range(0, 5, cut)]), 2)).set_index("id")
        assert set(made.index) == set(want) and set(made["sample_id"]) == {"s"}
        for name, (x, y) in want.items():
            assert np.allclose(made.loc[name, "vector"], [math.log1p(x / (x + y) * 1e4), -math.log1p(y / (x + y) * 1e4)])


def test_doublet_status_reads_no_counts(spark, monkeypatch):
    from countloom.plans import all_queries
    from countloom.plans.views import Views

    def refused(self):
        raise AssertionError("the status needs the cells only")

    monkeypatch.setattr(Views, "cell_counts", refused)
    assert all_queries().callables()["doublet_status"](spark, "/root/testdata/sf0.001").count() == 25


def tallied(df, seen):
    def tally(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(tally, df.schema)


def test_pseudobulk_test_reads_its_counts_once(spark):
    """Units, factors and the test come from sums that are made once; a unit without counts has no factor."""
    rows = [(f"c{i}", "D", f"s{i % 6}", f"p{i % 6}", "case" if i % 2 else "control", "T", "L") for i in range(30)] + [("c30", "D", "s6", None, "case", "T", "L"), ("c31", "D", "s7", "p7", "case", "T", "L")]
    c = spark.createDataFrame(rows, "cell_id string, dataset_id string, sample_id string, subject_id string, group string, cell_type string, author_label string")
    k = spark.createDataFrame([(f"c{i}", f"g{j}", int(RNG.integers(1, 9))) for i in range(31) for j in range(4)], "cell_id string, gene_id string, count bigint")
    seen = spark.sparkContext.accumulator(0)
    effects, skipped = pseudobulk.pseudobulk_test(*pseudobulk.pseudobulk(c, tallied(k, seen), keep=True), "case", "control")
    assert [r.sample_size for r in effects.collect()] == [6] * 4
    assert skipped.count() == 0 and seen.value == k.count()


def test_contrast_effects_read_their_counts_once(spark):
    """Without adjusted p-values nothing is written for them; a unit without a subject meets no counts and is no sample."""
    rows = [(f"c{i}", "D", f"s{i % 6}", f"p{i % 6}", "case" if i % 2 else "control", "T", "L") for i in range(30)] + [("c30", "D", "s6", None, "case", "T", "L")]
    c = spark.createDataFrame(rows, "cell_id string, dataset_id string, sample_id string, subject_id string, group string, cell_type string, author_label string")
    k = spark.createDataFrame([(f"c{i}", f"g{j}", int(RNG.integers(1, 9))) for i in range(31) for j in range(4)], "cell_id string, gene_id string, count bigint")
    contrasts = spark.createDataFrame([("C", "case", "control", "scrna_pseudobulk", "2", "true")], "contrast_id string, numerator string, denominator string, data_scope string, min_replicates_per_group string, enabled string")
    seen = spark.sparkContext.accumulator(0)
    effects, status = pseudobulk.contrast_tests(*pseudobulk.pseudobulk(c, tallied(k, seen), keep=True), contrasts, adjust=False)
    assert [r.sample_size for r in effects.collect()] == [6] * 4 and "padj" not in effects.columns
    assert [r.status for r in status.collect()] == ["tested"] and seen.value == k.count()
