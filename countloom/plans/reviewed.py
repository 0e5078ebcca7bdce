"""Reviewed tables derived from the driver data, in Spark SQL text that both engines run.

The manifest has one row per customer; modular arithmetic on the key plants the
defects the rules look for, so every rule sees real rows that break it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from countloom.plans.views import Views

MANIFEST = """SELECT r_name AS dataset_id, concat('GSE', r_regionkey) AS gse_id, concat('GSM', CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END) AS gsm_id,
  concat('SRX', c_custkey) AS srx_id, CASE WHEN c_custkey % 30 = 7 THEN concat('SRR', c_custkey, ';SRR', c_custkey + 1) ELSE concat('SRR', c_custkey) END AS srr_id,
  concat('S', CASE WHEN c_custkey % 100 = 3 THEN c_custkey - 1 ELSE c_custkey END) AS sample_id,
  CASE WHEN c_custkey % 40 = 5 THEN 'NA' WHEN c_custkey % 40 = 6 THEN 'ACGTACGTACGT-1' ELSE concat('D', (c_custkey - c_custkey % 2)) END AS subject_id,
  CASE WHEN c_acctbal < 500 THEN 'false' WHEN c_custkey % 97 = 0 THEN 'True' ELSE 'true' END AS include,
  CASE WHEN c_custkey % 60 = 8 THEN 'NA' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'case' ELSE 'control' END AS {q}group{q},
  c_mktsegment AS condition, CASE WHEN c_custkey % 9 = 0 THEN 'NA' ELSE 'liver' END AS tissue, n_name AS batch, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
  CASE WHEN c_custkey % 33 = 0 THEN 'NA' ELSE CAST(20 + c_custkey % 60 AS {text}) END AS age, 'NA' AS timepoint, 'NA' AS treatment,
  CASE WHEN c_custkey % 45 = 10 THEN 'NA' ELSE concat('P', (c_custkey - c_custkey % 2)) END AS paired_group,
  CASE WHEN c_custkey % 3 = 0 THEN 'scrna' ELSE 'bulk_rnaseq' END AS data_type, CASE WHEN c_custkey % 4 = 1 THEN 'PAIRED' ELSE 'SINGLE' END AS library_layout,
  CASE WHEN c_custkey % 7 = 2 THEN 'NA' WHEN c_custkey % 11 = 0 THEN concat('data/', r_name, '.xlsx') ELSE concat('data/', r_name, '.tsv') END AS matrix_path,
  CASE WHEN c_custkey % 7 = 2 AND c_custkey % 2 = 0 THEN concat('fq/', (c_custkey - c_custkey % 28), '_1.fastq.gz') WHEN c_custkey % 7 = 2 AND c_custkey % 8 = 1 THEN concat('fq/', c_custkey, '_1.bam') ELSE 'NA' END AS fastq_r1,
  CASE WHEN c_custkey % 7 = 2 AND c_custkey % 6 = 2 THEN concat('fq/', (c_custkey - c_custkey % 28), '_1.fastq.gz') WHEN c_custkey % 7 = 2 AND c_custkey % 8 = 1 THEN concat('fq/', c_custkey, '_1.bam') ELSE 'NA' END AS fastq_r2,
  CASE WHEN c_custkey % 71 = 0 THEN ' checked' ELSE 'NA' END AS notes, 'NA' AS reviewer_note,
  CASE WHEN c_custkey % 25 = 4 THEN 'pending' WHEN c_custkey % 25 = 9 THEN 'excluded' WHEN c_custkey % 200 = 1 THEN 'done' ELSE 'confirmed' END AS review_status,
  c_custkey + 2 AS line
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

PLAN = """SELECT 'A1' AS analysis_id, r_name AS dataset_id, 'true' AS include, CASE WHEN r_name = 'ASIA' THEN 'validation' ELSE 'discovery' END AS role, 'NA' AS merge_group, 'per_dataset_meta' AS analysis_strategy, 'NA' AS reference_dataset, 'NA' AS notes, r_regionkey + 2 AS line FROM region
  UNION ALL SELECT 'A2', r_name, 'true', 'discovery', 'M1', 'joint_model', 'NA', 'NA', r_regionkey + 12 FROM region
  UNION ALL SELECT 'A3', r_name, 'false', 'discovery', 'NA', 'independent_only', 'NA', 'NA', r_regionkey + 22 FROM region WHERE r_regionkey < 2
  UNION ALL SELECT 'A4', concat(r_name, '_X'), 'true', 'supplementary', 'NA', CASE WHEN r_regionkey = 0 THEN 'single_cell_integration' ELSE 'independent_only' END, 'NA', 'NA', r_regionkey + 32 FROM region WHERE r_regionkey < 2
  UNION ALL SELECT 'A5', r_name, 'true', CASE WHEN r_name = 'EUROPE' THEN 'validation' ELSE 'discovery' END, 'M5', 'stratified_validation', 'NA', 'NA', r_regionkey + 42 FROM region WHERE r_name IN ('EUROPE', 'AFRICA')"""

CONTRASTS = """SELECT concat('C1_', r_regionkey) AS contrast_id, 'A1' AS analysis_id, 'bulk' AS data_scope, 'case' AS numerator, 'control' AS denominator, 'condition' AS subset_column, CASE WHEN r_regionkey < 3 THEN 'BUILDING' ELSE 'MACHINERY' END AS subset_value,
    '~ group + batch' AS design_formula, 'false' AS paired, '3' AS min_replicates_per_group, 'true' AS enabled, 'NA' AS notes, r_regionkey + 2 AS line FROM region
  UNION ALL SELECT concat('C2_', r_regionkey), 'A2', CASE WHEN r_regionkey = 1 THEN 'scrna_pseudobulk' ELSE 'bulk' END, 'case', 'control', 'NA', 'NA', '~ group + sex + age', CASE WHEN r_regionkey % 2 = 0 THEN 'true' ELSE 'false' END, '400', CASE WHEN r_regionkey = 4 THEN 'false' ELSE 'true' END, 'NA', r_regionkey + 12 FROM region
  UNION ALL SELECT concat('C3_', r_regionkey), 'A5', 'cell_proportion', 'case', CASE WHEN r_regionkey = 0 THEN 'case' WHEN r_regionkey = 1 THEN 'treated' ELSE 'control' END, CASE WHEN r_regionkey = 2 THEN 'nowhere' ELSE 'NA' END, 'x', CASE WHEN r_regionkey = 3 THEN '~ group + moon' ELSE '~ group' END, 'false', 'x2', 'true', 'NA', r_regionkey + 22 FROM region
  UNION ALL SELECT concat('C4_', r_regionkey), 'A9', 'bulk', 'case', 'control', 'NA', 'NA', '~ group', 'maybe', '2', 'false', 'NA', r_regionkey + 32 FROM region WHERE r_regionkey < 2"""

ONTOLOGY = """SELECT r_name AS dataset_id, p AS author_label, 'L1' AS harmonized_level1, CASE WHEN p = '2-HIGH' THEN '3-MEDIUM' ELSE p END AS harmonized_level2, 'NA' AS harmonized_level3, 'manual' AS mapping_method, CASE WHEN p = '1-URGENT' THEN 'sure' ELSE 'high' END AS confidence, 'confirmed' AS review_status, 'NA' AS notes, n AS line FROM
  (SELECT r_name, p, row_number() OVER (ORDER BY r_name, p) + 1 AS n FROM region CROSS JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders) WHERE p NOT IN ('3-MEDIUM', '5-LOW') OR r_name = 'ASIA')
  UNION ALL SELECT concat(r_name, '_Y'), '1-URGENT', 'L1', 'x', 'NA', 'manual', 'high', 'confirmed', 'NA', r_regionkey + 102 FROM region WHERE r_regionkey < 2
  UNION ALL SELECT r_name, '1-URGENT', 'L2', 'other', 'NA', 'manual', 'high', 'pending', 'NA', r_regionkey + 112 FROM region WHERE r_regionkey < 2"""

FILES = "SELECT concat('data/', r_name, '.tsv') AS path FROM region UNION ALL SELECT concat('fq/', c_custkey, '_1.fastq.gz') FROM customer WHERE c_custkey % 3 = 0"

BARE = {"manifest": MANIFEST, "plan": PLAN, "contrasts": CONTRASTS, "ontology": ONTOLOGY, "files": FILES}
TEXT = {name: sql.format(q='"', text="VARCHAR") for name, sql in BARE.items()}


def reviewed(v: Views, name: str) -> DataFrame:
    """The same SELECT on the driver's parquet tables, without naming any view globally."""
    tables = {t: v.t(t) for t in ("customer", "nation", "region", "orders")}
    body = BARE[name].format(q="`", text="STRING")
    for t in tables:
        body = body.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ").replace(f"FROM {t})", f"FROM {{{t}}})")
        if body.endswith(f"FROM {t}"):
            body = body[: -len(t)] + f"{{{t}}}"
        body = body.replace(f"FROM {t}\n", f"FROM {{{t}}}\n")
    used = {t: df for t, df in tables.items() if f"{{{t}}}" in body}
    return v.spark.sql(body, **used)
