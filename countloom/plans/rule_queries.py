"""Registered queries: data-quality rules over reviewed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions.missing import as_bool, is_missing
from countloom.operators import joins as J
from countloom.operators.rules import authority as A
from countloom.operators.rules import design as D
from countloom.operators.rules import issues as I
from countloom.operators.rules import manifest as M
from countloom.operators.rules import matrix as X
from countloom.plans.registry import Registry, rounded
from countloom.plans.reviewed import TEXT, reviewed
from countloom.plans.views import Views, sql

queries = Registry()

KEEP = ["severity", "scope", "check_id", *I.IDS, "status"]
MISS = "('', 'NA', 'N/A', 'null', 'None')"


def ctes(names: str, **extra: str) -> dict[str, str]:
    return {**{n: TEXT[n] for n in names.split()}, **extra}


def rule(severity: str, scope: str, check: str, source: str, status: str = "fail", **ids: str) -> str:
    cells = ", ".join(f"{ids.get(n, repr('NA'))} AS {n}" for n in I.IDS)
    severity = severity if severity.startswith("CASE") else f"'{severity}'"
    check = check if check.startswith("CASE") else f"'{check}'"
    return f"SELECT {severity} AS severity, '{scope}' AS scope, {check} AS check_id, {cells}, '{status}' AS status FROM {source}"


ACTIVE = "SELECT * FROM manifest WHERE include = 'true' AND review_status = 'confirmed'"
DS = {"dataset_id": "dataset_id", "sample_id": "sample_id"}
PATHS = " UNION ALL ".join(f"SELECT dataset_id, sample_id, '{f}' AS field, {f} AS path FROM act WHERE {f} NOT IN {MISS}" for f in ("matrix_path", "fastq_r1", "fastq_r2"))
DUP = "(SELECT value, string_agg(sample_id, ';' ORDER BY sample_id) AS s FROM (SELECT DISTINCT value, sample_id FROM ({}) WHERE value NOT IN " + MISS + ") GROUP BY value HAVING count(*) > 1)"
MANIFEST_RULES = {
    "act": ACTIVE,
    "paths": PATHS,
    "found": " UNION ALL ".join([
        rule("critical", "manifest", "DUPLICATE_SAMPLE_ID", "manifest WHERE sample_id IN (SELECT sample_id FROM manifest GROUP BY 1 HAVING count(*) > 1)", **DS),
        rule("critical", "manifest", "CASE WHEN review_status = 'pending' THEN 'PENDING_SAMPLE_INCLUDED' ELSE 'UNCONFIRMED_SAMPLE_INCLUDED' END", "manifest WHERE include = 'true' AND review_status <> 'confirmed'", **DS),
        rule("critical", "manifest", "EXCLUDED_SAMPLE_INCLUDED", "manifest WHERE include = 'true' AND review_status = 'excluded'", **DS),
        rule("critical", "sample_identity", "DUPLICATE_GSM_ID", DUP.format("SELECT gsm_id AS value, sample_id FROM manifest"), sample_id="s"),
        rule("critical", "sample_identity", "DUPLICATE_SRR_ID", DUP.format("SELECT unnest(string_split(srr_id, ';')) AS value, sample_id FROM manifest"), sample_id="s"),
        rule("error", "manifest", "NO_ANALYSIS_INPUT", f"act WHERE matrix_path IN {MISS} AND fastq_r1 IN {MISS} AND fastq_r2 IN {MISS}", **DS),
        rule("error", "manifest", "INPUT_PATH_NOT_FOUND", "paths WHERE path NOT IN (SELECT path FROM files)", **DS),
        rule("error", "manifest", "FASTQ_FORMAT_MISMATCH", "paths WHERE field LIKE 'fastq%' AND NOT regexp_matches(lower(path), '\\.(fastq|fq)(\\.gz)?$')", **DS),
        rule("critical", "manifest", "PAIRED_FASTQ_MATES_IDENTICAL", f"act WHERE library_layout = 'PAIRED' AND fastq_r1 NOT IN {MISS} AND fastq_r1 = fastq_r2", **DS),
        rule("error", "manifest", "INCOMPLETE_PAIRED_FASTQ", f"act WHERE library_layout = 'PAIRED' AND (fastq_r1 IN {MISS}) <> (fastq_r2 IN {MISS})", **DS),
        rule("warning", "manifest", "SINGLE_END_WITH_R2", f"act WHERE library_layout = 'SINGLE' AND fastq_r2 NOT IN {MISS}", **DS),
        rule("error", "manifest", "COUNT_MATRIX_FORMAT_MISMATCH", f"act WHERE matrix_path NOT IN {MISS} AND data_type LIKE '%bulk%' AND NOT regexp_matches(matrix_path, '\\.(tsv|txt|csv)(\\.gz)?$')", **DS),
        rule("error", "manifest", "SINGLE_CELL_MATRIX_FORMAT_MISMATCH", f"act WHERE matrix_path NOT IN {MISS} AND data_type LIKE '%scrna%' AND NOT regexp_matches(matrix_path, '\\.(h5ad|h5|hdf5|rds|mtx|mtx\\.gz)$')", **DS),
        rule("critical", "sample_identity", "FASTQ_PATH_REUSED_ACROSS_SAMPLES", DUP.format("SELECT path AS value, sample_id FROM paths WHERE field LIKE 'fastq%'"), sample_id="s"),
        rule("critical", "sample_identity", "FASTQ_PATH_REUSED_WITHIN_SAMPLE", "(SELECT path, min(sample_id) AS s FROM paths WHERE field LIKE 'fastq%' GROUP BY path HAVING count(DISTINCT sample_id) = 1 AND count(DISTINCT field) > 1)", sample_id="s"),
    ]),
}


def manifest_issues(v: Views):
    return M.validate_manifest(reviewed(v, "manifest"), reviewed(v, "files"))


queries.add("manifest_rules", lambda v: manifest_issues(v).select(*KEEP), sql("", "SELECT * FROM found", **ctes("manifest files", **MANIFEST_RULES)))
queries.add(
    "validated_manifest",
    lambda v: M.validated_manifest(reviewed(v, "manifest"), manifest_issues(v)).select("sample_id", "gsm_id", "line", "validation_eligible", "validation_issue_count"),
    sql("", """SELECT m.sample_id, gsm_id, line, CASE WHEN include = 'true' AND review_status = 'confirmed' AND coalesce(b, 0) = 0 THEN 'true' ELSE 'false' END AS validation_eligible, coalesce(n, 0)::bigint AS validation_issue_count
        FROM manifest m LEFT JOIN (SELECT sample_id, count(*) AS n, count(*) FILTER (WHERE severity IN ('critical', 'error')) AS b FROM found GROUP BY 1) i ON i.sample_id = m.sample_id""", **ctes("manifest files", **MANIFEST_RULES)),
)
queries.add("issue_severity_counts", lambda v: I.severity_counts(manifest_issues(v)), sql("", "SELECT s AS severity, count(severity) AS issue_count FROM (SELECT unnest(['critical', 'error', 'warning', 'info']) AS s) LEFT JOIN found ON severity = s GROUP BY s", **ctes("manifest files", **MANIFEST_RULES)))
# The oracle's rows carry no message, so rules that say one thing per path are left out.
PER_PATH = ("INPUT_PATH_NOT_FOUND", "FASTQ_FORMAT_MISMATCH", "DUPLICATE_SAMPLE_ID")
queries.add("issue_deduplication", lambda v: I.deduplicate(manifest_issues(v).unionByName(manifest_issues(v))).where(~F.col("check_id").isin(*PER_PATH)).groupBy("check_id").agg(F.count(F.lit(1)).alias("n")),
            sql("", f"SELECT check_id, count(*) AS n FROM (SELECT DISTINCT * FROM found) WHERE check_id NOT IN {PER_PATH} GROUP BY 1", **ctes("manifest files", **MANIFEST_RULES)))
queries.add("blocking_issues", lambda v: I.blocking(manifest_issues(v)).groupBy("check_id", "severity").agg(F.count(F.lit(1)).alias("n")), sql("", "SELECT check_id, severity, count(*) AS n FROM found WHERE severity IN ('critical', 'error') GROUP BY ALL", **ctes("manifest files", **MANIFEST_RULES)))

ROWS = {"act": ACTIVE, "arows": "SELECT DISTINCT p.analysis_id, a.* FROM act a JOIN (SELECT DISTINCT analysis_id, dataset_id FROM plan WHERE include = 'true') p USING (dataset_id)".replace("SELECT DISTINCT p", "SELECT p")}
CONTRAST_RULES = {
    **ROWS,
    "con": "SELECT *, coalesce(try_cast(min_replicates_per_group AS INT), 1) AS minimum FROM contrasts WHERE enabled = 'true'",
    "dif": "SELECT * FROM con WHERE numerator <> denominator",
    "chosen": """SELECT c.contrast_id, c.numerator, c.denominator, c.paired, r.* FROM arows r JOIN dif c USING (analysis_id) WHERE c.subset_column = 'NA' OR (c.subset_column = 'condition' AND r.condition = c.subset_value)""",
    "sides": "SELECT analysis_id, contrast_id, minimum, numerator AS g FROM dif UNION ALL SELECT analysis_id, contrast_id, minimum, denominator FROM dif",
    "got": f"SELECT analysis_id, contrast_id, \"group\" AS g, count(*) AS n, count(DISTINCT CASE WHEN subject_id NOT IN {MISS} THEN subject_id END) AS s FROM chosen GROUP BY ALL",
    "prs": f"""SELECT analysis_id, contrast_id, paired_group, count(*) AS n, count(*) FILTER (WHERE "group" = numerator) AS u, count(*) FILTER (WHERE "group" = denominator) AS d, count(DISTINCT CASE WHEN subject_id NOT IN {MISS} THEN subject_id END) AS s
        FROM chosen WHERE paired = 'true' AND "group" IN (numerator, denominator) AND paired_group NOT IN {MISS} GROUP BY ALL""",
    "mixed": f"""SELECT analysis_id, subject_id, string_agg(DISTINCT dataset_id, ';' ORDER BY dataset_id) AS ds FROM arows WHERE subject_id NOT IN {MISS} AND "group" NOT IN {MISS} AND analysis_id IN (SELECT analysis_id FROM contrasts) GROUP BY ALL HAVING count(DISTINCT "group") > 1""",
    "base": " UNION ALL ".join([
        rule("error", "biological_design", "GROUP_MISSING", f"arows WHERE \"group\" IN {MISS} AND analysis_id IN (SELECT analysis_id FROM contrasts)", analysis_id="analysis_id", subject_id="subject_id", **DS),
        rule("error", "biological_design", "SUBJECT_ID_MISSING", f"arows WHERE subject_id IN {MISS} AND analysis_id IN (SELECT analysis_id FROM contrasts)", analysis_id="analysis_id", **DS),
        rule("error", "biological_design", "SUBJECT_GROUP_CONFLICT", "mixed WHERE analysis_id NOT IN (SELECT analysis_id FROM con GROUP BY 1 HAVING bool_and(paired = 'true'))", analysis_id="analysis_id", dataset_id="ds", subject_id="subject_id"),
        rule("error", "contrast", "IDENTICAL_CONTRAST_GROUPS", "con WHERE numerator = denominator", analysis_id="analysis_id", contrast_id="contrast_id"),
        rule("error", "contrast", "SUBSET_COLUMN_MISSING", "dif WHERE subset_column = 'nowhere'", analysis_id="analysis_id", contrast_id="contrast_id"),
        rule("error", "contrast", "CONTRAST_GROUP_NOT_FOUND", "sides LEFT JOIN got USING (analysis_id, contrast_id, g) WHERE n IS NULL", analysis_id="analysis_id", contrast_id="contrast_id"),
        rule("error", "contrast", "INSUFFICIENT_SUBJECT_REPLICATES", "sides LEFT JOIN got USING (analysis_id, contrast_id, g) WHERE coalesce(s, 0) < minimum", analysis_id="analysis_id", contrast_id="contrast_id"),
        rule("error", "paired_design", "PAIRED_GROUP_MISSING", f"chosen WHERE paired = 'true' AND \"group\" IN (numerator, denominator) AND paired_group IN {MISS}", analysis_id="analysis_id", subject_id="CASE WHEN subject_id = '' THEN 'NA' ELSE subject_id END", contrast_id="contrast_id", **DS),
        rule("error", "paired_design", "INCOMPLETE_PAIR", "prs WHERE u <> 1 OR d <> 1 OR n <> 2", analysis_id="analysis_id", contrast_id="contrast_id"),
        rule("error", "paired_design", "PAIR_SUBJECT_CONFLICT", "prs WHERE s > 1", analysis_id="analysis_id", contrast_id="contrast_id"),
    ]),
    "all_rules": "SELECT * FROM base UNION ALL " + rule("info", "contrast", "CONTRAST_VALID", "dif WHERE contrast_id NOT IN (SELECT contrast_id FROM base)", status="pass", analysis_id="analysis_id", contrast_id="contrast_id"),
}


def contrast_issues(v: Views):
    return D.validate_contrasts(reviewed(v, "manifest"), reviewed(v, "contrasts"), reviewed(v, "plan"))


queries.add("contrast_rules", lambda v: contrast_issues(v).select(*KEEP), sql("", "SELECT * FROM all_rules", **ctes("manifest plan contrasts", **CONTRAST_RULES)))

COMPAT = {"AFRICA": {"species": "human", "reference_genome": "GRCh38", "gene_id_space": "ensembl"}, "AMERICA": {"species": "mouse", "reference_genome": "GRCh38"},
          "ASIA": {"species": "human", "reference_genome": "GRCh38", "gene_id_space": "ensembl"}, "EUROPE": {"species": "human", "reference_genome": "GRCh38", "gene_id_space": "ensembl"},
          "MIDDLE EAST": {"species": "human", "reference_genome": "GRCh37", "gene_id_space": "ensembl"}}


def plan_issues(v: Views):
    return D.validate_plan(reviewed(v, "manifest"), reviewed(v, "contrasts"), reviewed(v, "plan"), 0.5, COMPAT)


PLAN_RULES = {
    **CONTRAST_RULES,
    "used": "SELECT * FROM plan WHERE include = 'true'",
    "sideset": "SELECT analysis_id, contrast_id, minimum, numerator AS g FROM con UNION ALL SELECT analysis_id, contrast_id, minimum, denominator FROM con",
    "subj": f"SELECT analysis_id, dataset_id, \"group\" AS g, count(DISTINCT subject_id) AS s FROM arows WHERE subject_id NOT IN {MISS} GROUP BY ALL",
    "weak": "SELECT DISTINCT analysis_id, dataset_id, contrast_id, analysis_strategy FROM sideset JOIN used USING (analysis_id) LEFT JOIN subj USING (analysis_id, dataset_id, g) WHERE analysis_strategy IN ('joint_model', 'per_dataset_meta') AND coalesce(s, 0) < minimum",
    "shares": "SELECT analysis_id, dataset_id, n / sum(n) OVER (PARTITION BY analysis_id) AS f, count(*) OVER (PARTITION BY analysis_id) AS k FROM (SELECT analysis_id, dataset_id, count(*) AS n FROM arows GROUP BY ALL)",
    "mem": "SELECT analysis_id, merge_group, string_agg(dataset_id, ';' ORDER BY dataset_id) AS ds FROM used WHERE merge_group <> 'NA' GROUP BY ALL",
    "mtypes": "SELECT u.analysis_id, any_value(ds) AS ds FROM used u JOIN mem USING (analysis_id, merge_group) JOIN arows r ON r.analysis_id = u.analysis_id AND r.dataset_id = u.dataset_id GROUP BY u.analysis_id HAVING count(DISTINCT data_type) > 1",
    "pbase": " UNION ALL ".join([
        rule("error", "dataset_plan", "PLANNED_DATASET_NOT_FOUND", "plan WHERE dataset_id NOT IN (SELECT dataset_id FROM manifest)", analysis_id="analysis_id", dataset_id="dataset_id"),
        rule("warning", "dataset_plan", "NO_INCLUDED_DATASETS", "(SELECT DISTINCT analysis_id FROM plan WHERE analysis_id NOT IN (SELECT analysis_id FROM used))", analysis_id="analysis_id"),
        rule("error", "dataset_plan", "MIXED_ANALYSIS_STRATEGIES", "(SELECT analysis_id FROM used GROUP BY 1 HAVING count(DISTINCT analysis_strategy) > 1)", analysis_id="analysis_id"),
        rule("error", "dataset_plan", "VALIDATION_DATA_IN_DISCOVERY_MODEL", "used u WHERE role = 'validation' AND EXISTS (SELECT 1 FROM used x WHERE x.analysis_id = u.analysis_id AND x.role = 'discovery') AND (analysis_strategy IN ('joint_model', 'per_dataset_meta') OR (merge_group <> 'NA' AND EXISTS (SELECT 1 FROM used x WHERE x.analysis_id = u.analysis_id AND x.role = 'discovery' AND x.merge_group = u.merge_group)))", analysis_id="analysis_id", dataset_id="dataset_id"),
        rule("warning", "dataset_plan", "DATASET_SAMPLE_SIZE_DOMINANCE", "(SELECT * FROM shares WHERE k >= 2 AND f >= 0.5 QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY f DESC, dataset_id) = 1)", analysis_id="analysis_id", dataset_id="dataset_id"),
        rule("CASE WHEN analysis_strategy = 'joint_model' THEN 'critical' ELSE 'error' END", "dataset_plan", "CASE WHEN analysis_strategy = 'joint_model' THEN 'JOINT_DATASET_MISSING_COMPARISON' ELSE 'META_DATASET_NOT_ESTIMABLE' END", "weak", analysis_id="analysis_id", dataset_id="dataset_id", contrast_id="contrast_id"),
        rule("critical", "dataset_plan", "INCOMPATIBLE_DATA_TYPES_MERGED", "mtypes", analysis_id="analysis_id", dataset_id="ds"),
        rule("error", "dataset_plan", "INTEGRATION_MERGE_GROUP_REQUIRED", "used WHERE analysis_strategy = 'single_cell_integration' AND merge_group = 'NA'", analysis_id="analysis_id", dataset_id="dataset_id"),
        rule("critical", "dataset_plan", "INCOMPATIBLE_SPECIES_MERGED", "mem WHERE analysis_id = 'A2'", analysis_id="analysis_id", dataset_id="ds"),
        rule("error", "dataset_plan", "INCOMPATIBLE_REFERENCE_GENOMES", "mem WHERE analysis_id = 'A2'", analysis_id="analysis_id", dataset_id="ds"),
        rule("error", "dataset_plan", "INCOMPATIBLE_GENE_ID_SPACES", "mem WHERE analysis_id = 'A2'", analysis_id="analysis_id", dataset_id="ds"),
    ]),
    "plan_all": "SELECT * FROM pbase UNION ALL " + rule("info", "dataset_plan", "DATASET_PLAN_VALID", "(SELECT DISTINCT analysis_id FROM used WHERE analysis_id NOT IN (SELECT analysis_id FROM pbase))", status="pass", analysis_id="analysis_id"),
}
queries.add("plan_rules", lambda v: plan_issues(v).select(*KEEP), sql("", "SELECT * FROM plan_all", **ctes("manifest plan contrasts", **PLAN_RULES)))

METRICS_SQL = """SELECT m.dataset_id, CASE WHEN o_orderkey % 211 = 0 THEN 'S_unknown' ELSE m.sample_id END AS sample_id, CASE WHEN o_orderkey % 97 = 0 THEN 'D_other' ELSE m.subject_id END AS subject_id, o_orderpriority AS author_label, 1 + o_orderkey % 30 AS cell_count
  FROM orders JOIN (SELECT dataset_id, sample_id, subject_id, line FROM manifest WHERE include = 'true' AND review_status = 'confirmed' AND data_type = 'scrna') m ON m.line - 2 = o_custkey"""


def cell_metrics(v: Views):
    m = reviewed(v, "manifest").where("include = 'true' AND review_status = 'confirmed' AND data_type = 'scrna'").select("dataset_id", "sample_id", "subject_id", "line")
    return v.t("orders").join(m, F.col("line") - 2 == F.col("o_custkey")).select(
        "dataset_id", F.when(F.col("o_orderkey") % 211 == 0, F.lit("S_unknown")).otherwise(F.col("sample_id")).alias("sample_id"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("D_other")).otherwise(F.col("subject_id")).alias("subject_id"),
        F.col("o_orderpriority").alias("author_label"), (1 + F.col("o_orderkey") % 30).alias("cell_count"))


ONTOLOGY_RULES = {
    **CONTRAST_RULES, "metrics": METRICS_SQL,
    "inc": "SELECT * FROM act WHERE data_type = 'scrna'",
    "mk": "SELECT x.*, i.sample_id IS NOT NULL AS known, i.subj, i.grp FROM metrics x LEFT JOIN (SELECT sample_id, max(subject_id) AS subj, max(\"group\") AS grp FROM inc GROUP BY 1) i USING (sample_id)",
    "sc": "SELECT DISTINCT analysis_id FROM con WHERE data_scope IN ('scrna_pseudobulk', 'scrna_meta', 'cell_proportion')",
    "allsides": "SELECT analysis_id, contrast_id, minimum, numerator AS g FROM con UNION ALL SELECT analysis_id, contrast_id, minimum, denominator FROM con",
    "don": f"SELECT analysis_id, \"group\" AS g, count(DISTINCT subject_id) AS s FROM arows WHERE data_type = 'scrna' AND subject_id NOT IN {MISS} GROUP BY ALL",
    "labs": "SELECT DISTINCT dataset_id, author_label FROM metrics EXCEPT SELECT dataset_id, author_label FROM ontology",
    "orules": " UNION ALL ".join([
        rule("error", "single_cell", "SINGLE_CELL_SUBJECT_ID_MISSING", f"inc WHERE subject_id IN {MISS}", **DS),
        rule("error", "single_cell", "SUBJECT_ID_LOOKS_LIKE_BARCODE", "inc WHERE regexp_full_match(subject_id, '[ACGTN]{12,}(-[0-9]+)?')", subject_id="subject_id", **DS),
        rule("error", "celltype_ontology", "CELLTYPE_ONE_TO_MANY_CONFLICT", "(SELECT dataset_id FROM ontology WHERE review_status <> 'excluded' GROUP BY dataset_id, author_label HAVING count(DISTINCT (harmonized_level1, harmonized_level2, harmonized_level3)) > 1)", dataset_id="dataset_id"),
        rule("error", "single_cell", "CELL_METRIC_SAMPLE_NOT_FOUND", "mk WHERE NOT known", **DS),
        rule("error", "single_cell", "CELL_METRIC_SUBJECT_MISMATCH", "mk WHERE known AND subj <> subject_id", subject_id="subject_id", **DS),
        rule("error", "single_cell", "INSUFFICIENT_CELLS_PER_CELLTYPE_SAMPLE", "mk WHERE known AND cell_count < 10", subject_id="subject_id", **DS),
        rule("error", "celltype_ontology", "CASE WHEN EXISTS (SELECT 1 FROM ontology o WHERE o.dataset_id = labs.dataset_id AND labs.author_label IN (harmonized_level1, harmonized_level2, harmonized_level3)) THEN 'AUTHOR_LABEL_POSSIBLY_OVERWRITTEN' ELSE 'AUTHOR_LABEL_UNMAPPED' END", "labs", dataset_id="dataset_id"),
        rule("error", "single_cell", "INSUFFICIENT_DONORS_PER_CELLTYPE_GROUP", "(SELECT dataset_id FROM mk WHERE known GROUP BY dataset_id, author_label, grp HAVING count(DISTINCT subject_id) < 12)", dataset_id="dataset_id"),
        rule("error", "single_cell", "PSEUDOBULK_INSUFFICIENT_DONORS", "allsides LEFT JOIN don USING (analysis_id, g) WHERE analysis_id IN (SELECT analysis_id FROM sc) AND coalesce(s, 0) < minimum", analysis_id="analysis_id", contrast_id="contrast_id"),
    ]),
}
queries.add(
    "ontology_rules",
    lambda v: D.validate_ontology(reviewed(v, "manifest"), reviewed(v, "contrasts"), reviewed(v, "plan"), reviewed(v, "ontology"), cell_metrics(v), 10, 12).select(*KEEP),
    sql("", "SELECT * FROM orules", **ctes("manifest plan contrasts ontology", **ONTOLOGY_RULES)),
)
queries.add(
    "design_crosstab", lambda v: D.design_crosstab(reviewed(v, "manifest"), reviewed(v, "plan")),
    sql("", f"""SELECT analysis_id, dataset_id, "group", count(*) AS sample_count, count(DISTINCT CASE WHEN subject_id NOT IN {MISS} THEN subject_id END) AS subject_count, printf('%.6f', count(*) / sum(count(*)) OVER (PARTITION BY analysis_id)) AS fraction_of_analysis FROM arows GROUP BY analysis_id, dataset_id, "group\"""", **ctes("manifest plan", **ROWS)),
)
queries.add("design_rules", lambda v: D.validate_design(reviewed(v, "manifest"), reviewed(v, "contrasts"), reviewed(v, "plan"), 0.02).select(*KEEP, *D.METRIC_COLUMNS))
queries.add(
    "dataset_shares", lambda v: rounded(D.dataset_shares(D.rows_for_analysis(reviewed(v, "manifest"), reviewed(v, "plan")), ["analysis_id"]), "fraction"),
    sql("", "SELECT analysis_id, dataset_id, round(f, 6) AS fraction, k AS datasets FROM shares QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY f DESC, dataset_id) = 1", **ctes("manifest plan", **ROWS, shares=PLAN_RULES["shares"])),
)
queries.add(
    "shared_identities", lambda v: D.shared_identities(reviewed(v, "manifest")),
    sql("", f"SELECT field || ':' || value AS identity FROM (UNPIVOT (SELECT dataset_id, sample_id, subject_id, gsm_id, srr_id FROM manifest) ON sample_id, subject_id, gsm_id, srr_id INTO NAME field VALUE value) WHERE value NOT IN {MISS} GROUP BY field, value HAVING count(DISTINCT dataset_id) > 1", **ctes("manifest")),
)
queries.add(
    "confounded_contrasts",
    # Nations stand in for datasets: one customer segment each would confound them.
    lambda v: D.confounded(v.samples("nation").select("dataset_id", F.lit("x").alias("analysis_id"), F.col("batch").alias("group"), F.lit("b1").alias("numerator"), F.lit("b2").alias("denominator")), ["analysis_id"]).agg(F.count(F.lit(1)).alias("n")),
    sql("samples_nation", "SELECT 0::bigint AS n FROM samples_nation HAVING count(*) > 0 LIMIT 1").replace("SELECT 0::bigint AS n FROM samples_nation HAVING count(*) > 0 LIMIT 1", "SELECT CASE WHEN (SELECT max(g) FROM (SELECT count(DISTINCT batch) AS g FROM samples_nation GROUP BY dataset_id)) = 1 THEN 1 ELSE 0 END::bigint AS n"),
)
queries.add(
    "entry_contract_rules", lambda v: M.entry_contract(reviewed(v, "manifest"), reviewed(v, "plan").select("dataset_id")).select(*KEEP),
    sql("", " UNION ALL ".join([
        rule("error", "bulk_entry", "NO_ACTIVE_BULK_SAMPLES", "(SELECT DISTINCT dataset_id FROM plan WHERE dataset_id NOT IN (SELECT dataset_id FROM per))", dataset_id="dataset_id"),
        rule("critical", "bulk_entry", "MIXED_BULK_ENTRY_BRANCHES", "per WHERE mx > 0 AND rd > 0", dataset_id="dataset_id"),
        rule("critical", "bulk_entry", "INCONSISTENT_BULK_MATRIX_PATH", "per WHERE mx > 0 AND rd = 0 AND (lo <> hi OR mx <> n)", dataset_id="dataset_id"),
    ]), **ctes("manifest plan", act=ACTIVE, per=f"SELECT dataset_id, count(*) AS n, count(*) FILTER (WHERE matrix_path NOT IN {MISS}) AS mx, count(*) FILTER (WHERE fastq_r1 NOT IN {MISS} OR fastq_r2 NOT IN {MISS}) AS rd, min(matrix_path) FILTER (WHERE matrix_path NOT IN {MISS}) AS lo, max(matrix_path) FILTER (WHERE matrix_path NOT IN {MISS}) AS hi FROM act WHERE data_type LIKE '%bulk%' GROUP BY 1")),
)
queries.add(
    "entry_branch", lambda v: M.entry_branch(reviewed(v, "manifest").withColumn("dataset_id", F.col("batch"))),
    sql("", f"SELECT batch AS dataset_id, CASE WHEN bool_or(matrix_path NOT IN {MISS}) AND NOT bool_or(fastq_r1 NOT IN {MISS} OR fastq_r2 NOT IN {MISS}) THEN 'matrix' WHEN bool_or(fastq_r1 NOT IN {MISS} OR fastq_r2 NOT IN {MISS}) AND NOT bool_or(matrix_path NOT IN {MISS}) THEN 'fastq' ELSE 'invalid' END AS entry_branch FROM manifest GROUP BY 1", **ctes("manifest")),
)
queries.add(
    "reference_rules",
    lambda v: M.validate_references(M.entry_branch(reviewed(v, "manifest").where("matrix_path = 'NA'")), v.t("region").select(F.when(F.col("r_regionkey") == 0, F.lit("species")).when(F.col("r_regionkey") == 1, F.lit("gtf")).otherwise(F.lit("other")).alias("field"), F.when(F.col("r_regionkey") == 0, F.lit("human")).otherwise(F.lit("ref/a.gtf")).alias("value")), reviewed(v, "files"), "star_featurecounts", "forward", 2).groupBy("check_id").agg(F.count(F.lit(1)).alias("n")),
    sql("", """SELECT c AS check_id, k * n AS n FROM (SELECT count(*) AS n FROM (SELECT dataset_id FROM manifest WHERE matrix_path = 'NA' GROUP BY 1 HAVING bool_or(fastq_r1 <> 'NA' OR fastq_r2 <> 'NA'))),
        (VALUES ('BULK_STRANDEDNESS_PARAMETER_MISMATCH', 1), ('BULK_REFERENCE_METADATA_MISSING', 3), ('BULK_REFERENCE_PATH_MISSING', 2), ('BULK_REFERENCE_PATH_NOT_FOUND', 1)) t(c, k)""", **ctes("manifest")),
)
AUTH_SPAN = {
    "long": "UNPIVOT (SELECT line, " + ", ".join(f'"{c}"' for c in ("include", "notes", "dataset_id", "sample_id", "review_status", "gse_id", "gsm_id", "data_type")) + " FROM manifest) ON include, notes, dataset_id, sample_id, review_status, gse_id, gsm_id, data_type INTO NAME field VALUE value",
}
queries.add(
    "authority_value_rules", lambda v: A.value_rules(reviewed(v, "manifest"), "sample_manifest").select("check_id", "table", "line", "field", "value"),
    sql("", """SELECT 'SURROUNDING_WHITESPACE' AS check_id, 'sample_manifest' AS "table", line, field, value FROM long WHERE value <> trim(value)
        UNION ALL SELECT 'INVALID_BOOLEAN', 'sample_manifest', line, field, value FROM long WHERE field = 'include' AND value NOT IN ('true', 'false')
        UNION ALL SELECT 'SCHEMA_VIOLATION', 'sample_manifest', line, field, value FROM long WHERE field = 'review_status' AND value NOT IN ('pending', 'confirmed', 'excluded')
        UNION ALL SELECT 'SCHEMA_VIOLATION', 'sample_manifest', line, 'include', '' FROM manifest WHERE include = 'true' AND review_status <> 'confirmed'""", **ctes("manifest", **AUTH_SPAN)),
)
queries.add(
    "authority_contrast_values", lambda v: A.value_rules(reviewed(v, "contrasts"), "contrasts").select("check_id", "line", "field", "value"),
    sql("", "SELECT 'INVALID_BOOLEAN' AS check_id, line, 'paired' AS field, paired AS value FROM contrasts WHERE paired NOT IN ('true', 'false') UNION ALL SELECT 'INVALID_INTEGER', line, 'min_replicates_per_group', min_replicates_per_group FROM contrasts WHERE NOT regexp_full_match(min_replicates_per_group, '[0-9]+')", **ctes("contrasts")),
)
queries.add(
    "authority_cross_rules",
    lambda v: A.cross_rules({"sample_manifest": reviewed(v, "manifest"), "contrasts": reviewed(v, "contrasts"), "dataset_plan": reviewed(v, "plan"), "celltype_ontology": reviewed(v, "ontology")}).select("check_id", "table", "line", "value"),
    sql("", """SELECT 'DUPLICATE_SAMPLE_ID' AS check_id, 'sample_manifest' AS "table", line, sample_id AS value FROM manifest QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY line) > 1
        UNION ALL SELECT 'DUPLICATE_AUTHOR_LABEL', 'celltype_ontology', line, dataset_id || '|' || author_label FROM ontology QUALIFY row_number() OVER (PARTITION BY dataset_id, author_label ORDER BY line) > 1
        UNION ALL SELECT 'IDENTICAL_CONTRAST_GROUPS', 'contrasts', line, numerator FROM contrasts WHERE numerator = denominator
        UNION ALL SELECT 'UNKNOWN_ANALYSIS_ID', 'contrasts', line, analysis_id FROM contrasts WHERE analysis_id NOT IN (SELECT analysis_id FROM plan)
        UNION ALL SELECT 'UNKNOWN_ONTOLOGY_DATASET', 'celltype_ontology', line, dataset_id FROM ontology WHERE dataset_id NOT IN (SELECT dataset_id FROM plan UNION SELECT dataset_id FROM manifest)""", **ctes("manifest plan contrasts ontology")),
)


def all_issues(v: Views):
    return I.union([manifest_issues(v), contrast_issues(v), plan_issues(v)])


queries.add(
    "validation_gate",
    lambda v: I.gate(plan_issues(v).unionByName(contrast_issues(v)), reviewed(v, "plan")).select("analysis_id", "critical_issues", "error_issues", "blocked"),
    sql("", """SELECT p.analysis_id, c::bigint AS critical_issues, coalesce(n, 0)::bigint AS error_issues, c + coalesce(n, 0) > 0 AS blocked FROM (SELECT DISTINCT analysis_id FROM plan) p
        LEFT JOIN (SELECT analysis_id, count(*) AS n FROM (SELECT * FROM plan_all UNION ALL SELECT * FROM all_rules) WHERE severity = 'error' AND status = 'fail' GROUP BY 1) USING (analysis_id)
        CROSS JOIN (SELECT count(*) AS c FROM (SELECT * FROM plan_all UNION ALL SELECT * FROM all_rules) WHERE severity = 'critical' AND status = 'fail')""", **ctes("manifest plan contrasts", **PLAN_RULES)),
)
queries.add(
    "fixture_rules",
    lambda v: M.validate_fixture(reviewed(v, "manifest").withColumn("position", F.col("line")), reviewed(v, "contrasts"), reviewed(v, "plan"), reviewed(v, "manifest").select("sample_id", F.col("line").alias("position"))).groupBy("check_id").agg(F.count(F.lit(1)).alias("n")),
)
queries.add(
    "matrix_rules",
    lambda v: X.validate_counts(
        v.lines().select("dataset_id", F.concat(F.lit("G"), "l_partkey").alias("gene_id"), F.col("n_name").alias("sample_id"), F.col("l_quantity").cast("string").alias("value_text")),
        v.samples("nation").where("sample_id <> 'NATION_3'").withColumn("position", F.col("sample_id")), v.t("region").select(F.col("r_name").alias("dataset_id"), F.col("r_name").alias("label")),
    ).select(*KEEP),
    sql("lines", " UNION ALL ".join([
        rule("critical", "bulk_matrix", "BULK_SAMPLE_COLUMNS_MISMATCH", "(SELECT DISTINCT dataset_id FROM lines WHERE n_name = 'NATION_3')", dataset_id="dataset_id"),
        rule("critical", "bulk_matrix", "DUPLICATE_BULK_GENE_IDS", "(SELECT DISTINCT dataset_id FROM (SELECT dataset_id FROM lines GROUP BY dataset_id, l_partkey, n_name HAVING count(*) > 1))", dataset_id="dataset_id"),
    ])),
)
queries.add(
    "raw_count_guard", lambda v: X.raw_count_problems(v.t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").alias("count"))).groupBy("count").agg(F.count(F.lit(1)).alias("n")),
    "SELECT l_tax AS count, count(*) AS n FROM lineitem WHERE l_tax <> 0 GROUP BY 1",
)
queries.add(
    "joint_preflight",
    lambda v: D.joint_preflight(reviewed(v, "manifest"), reviewed(v, "plan"), reviewed(v, "contrasts"), reviewed(v, "plan").select("analysis_id", "dataset_id", F.lit("C2_0").alias("contrast_id"), F.lit("true").alias("compatible_for_joint_model")), J.shared_gene_space(v.counts("nation"))).select(*KEEP),
)
queries.add("strict_values", lambda v: reviewed(v, "manifest").groupBy(as_bool("include").alias("include_flag"), is_missing("group").alias("group_missing")).agg(F.count(F.lit(1)).alias("n")),
            sql("", f"SELECT CASE include WHEN 'true' THEN true WHEN 'false' THEN false END AS include_flag, \"group\" IN {MISS} AS group_missing, count(*) AS n FROM manifest GROUP BY ALL", **ctes("manifest")))
queries.add("rows_for_analysis", lambda v: D.rows_for_analysis(reviewed(v, "manifest"), reviewed(v, "plan")).select("analysis_id", "sample_id", "line"), sql("", "SELECT analysis_id, sample_id, line FROM arows", **ctes("manifest plan", **ROWS)))
queries.add("plan_expansion", lambda v: J.expand_contrasts(reviewed(v, "plan").select("analysis_id", "dataset_id", "include"), reviewed(v, "contrasts")),
            sql("", "SELECT p.analysis_id, p.dataset_id, p.include, coalesce(contrast_id, 'NA') AS contrast_id, coalesce(numerator, 'case') AS numerator, coalesce(denominator, 'control') AS denominator FROM plan p LEFT JOIN (SELECT * FROM contrasts WHERE enabled = 'true' AND data_scope = 'bulk') c USING (analysis_id) WHERE p.include = 'true'", **ctes("plan contrasts")))
queries.add(
    "pseudobulk_preflight",
    lambda v: D.pseudobulk_preflight(v.cells().select("dataset_id", "subject_id", "group", F.col("author_label").alias("cell_type")), reviewed(v, "plan"), reviewed(v, "contrasts"), 140).select("analysis_id", "contrast_id", "dataset_id", "cell_type", "problem"),
    sql("cells", """SELECT p.analysis_id, contrast_id, p.dataset_id, 'NA' AS cell_type, 'insufficient_subjects:' || c.g || ':' || coalesce(n, 0) || '<140' AS problem FROM (SELECT DISTINCT analysis_id, dataset_id FROM plan WHERE include = 'true') p
        JOIN (SELECT analysis_id, contrast_id, unnest([numerator, denominator]) AS g FROM contrasts WHERE enabled = 'true' AND data_scope = 'scrna_pseudobulk') c USING (analysis_id)
        LEFT JOIN (SELECT dataset_id, "group" AS g, count(DISTINCT subject_id) AS n FROM cells GROUP BY ALL) s ON s.dataset_id = p.dataset_id AND s.g = c.g WHERE coalesce(n, 0) < 140
        UNION ALL SELECT DISTINCT c.analysis_id, contrast_id, 'NA', author_label, 'design_invalid' FROM contrasts c JOIN plan p USING (analysis_id) JOIN cells USING (dataset_id)
        WHERE c.enabled = 'true' AND data_scope = 'scrna_pseudobulk' AND p.include = 'true' AND "group" IN (numerator, denominator)""", **ctes("plan contrasts")),
)
