"""A cross-section of registered queries against their oracle at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = (
    "library_metrics", "sample_metrics_qc", "bh_adjust_per_dataset", "meta_random_effects", "cell_qc_metrics", "pseudobulk_metadata", "manifest_rules",
    "contrast_rules", "suggested_manifest", "transition_audit", "cluster_markers", "set_zscore", "candidate_gene_scores",
)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    ok, detail, _, _ = compare(spark, duck(SF), entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, detail


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
