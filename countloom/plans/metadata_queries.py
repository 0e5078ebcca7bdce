"""Registered queries: metadata mining, entry classification, audit and event logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions import scores as S
from countloom.functions import text as X
from countloom.operators import audit as A
from countloom.operators import compat as P
from countloom.operators import entries as E
from countloom.operators import eventlog as Q
from countloom.operators import joins as J
from countloom.operators import mining as M
from countloom.plans.registry import Registry, rounded
from countloom.plans.reviewed import TEXT, reviewed
from countloom.plans.rule_queries import MANIFEST_RULES, MISS, manifest_issues
from countloom.plans.views import Views, sql

queries = Registry()

RULES = {
    "case_candidate_terms": ["stupid", "worthless", "and"], "control_candidate_terms": ["le", "und", "of"], "technical_replicate_terms": ["that"],
    "scrna_terms": ["with", "que"], "snrna_terms": ["der", "for"], "condition_keys": ["disease", "condition"], "tissue_keys": ["tissue"], "batch_keys": ["batch"],
}


def geo(v: Views):
    """One sample per document; its whole text is the title."""
    d = v.t("documents")
    i = F.col("doc_id")
    raw = F.when(i % 4 == 0, F.concat(F.lit('["tissue: '), "source", F.lit('", "condition: '), "lang", F.lit('", "Disease state: '), "lang", F.lit('"]'))).when(
        i % 4 == 1, F.concat(F.lit('{"a": ["condition: '), "lang", F.lit('", "disease: x"], "b": "batch: '), "source", F.lit('"}'))).when(
        i % 4 == 2, F.concat(F.lit('[{"field_name": "characteristics", "values": ["tissue: '), "source", F.lit('"]}]'))).otherwise(F.lit("NA"))
    return d.select(F.concat(F.lit("GSM"), i).alias("gsm_accession"), F.concat(F.lit("GSE_"), "source").alias("gse_accession"), F.col("text").alias("title"), F.lit("NA").alias("source_name"), raw.alias("characteristics_ch1_raw"))


def runs(v: Views):
    e = v.t("events")
    gsm = F.when(F.col("event_type") == "error", F.concat(F.lit("GSMX"), "user_id")).otherwise(F.concat(F.lit("GSM"), "user_id"))
    return e.select(
        F.lit("GSE_0").alias("gse_accession"), gsm.alias("gsm_accession"), F.concat(F.lit("SRX"), "event_id").alias("srx_accession"), F.concat(F.lit("SRR"), "event_id").alias("srr_accession"),
        F.when(F.col("event_type") == "view", F.lit("RNA-Seq")).otherwise(F.lit("OTHER")).alias("library_strategy"), F.lit("TRANSCRIPTOMIC").alias("library_source"),
        F.when(F.col("event_type") == "click", F.lit("NA")).otherwise(F.lit("PAIRED")).alias("library_layout"))


def files(v: Views):
    p = v.t("pages")
    return p.select(F.concat(F.lit("GSE_src"), F.col("page_id") % 25).alias("gse_accession"), F.lit("NA").alias("gsm_accession"), F.concat(F.lit('{"supplementary_file_1": ["'), "url", F.lit('"], "title": "x"}')).alias("raw_metadata_json"))


def word(term: str) -> str:
    return f"regexp_matches(t, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


GEO = {
    "smp": """SELECT 'GSM' || doc_id AS gsm, 'GSE_' || source AS gse, lower(text || CASE doc_id % 4 WHEN 0 THEN ' | tissue: ' || source || ' | condition: ' || lang || ' | Disease state: ' || lang WHEN 1 THEN ' | condition: ' || lang || ' | disease: x | batch: ' || source WHEN 2 THEN ' | tissue: ' || source ELSE '' END) AS t,
        CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN 'conflict' ELSE 'NA' END AS cond, CASE WHEN doc_id % 4 IN (0, 2) THEN source ELSE 'NA' END AS tis, CASE WHEN doc_id % 4 = 1 THEN source ELSE 'NA' END AS bat FROM documents""",
    "rn": "SELECT CASE WHEN event_type = 'error' THEN 'GSMX' || user_id ELSE 'GSM' || user_id END AS gsm, 'SRX' || event_id AS srx, 'SRR' || event_id AS srr, CASE WHEN event_type = 'view' THEN 'RNA-Seq' ELSE 'OTHER' END AS strat, CASE WHEN event_type = 'click' THEN 'NA' ELSE 'PAIRED' END AS lay FROM events",
    "jn": f"""SELECT s.gsm, gse, coalesce(srx, 'NA') AS srx, coalesce(srr, 'NA') AS srr, coalesce(strat, 'NA') AS strat, coalesce(lay, 'NA') AS lay, cond, tis, bat, {word('stupid')} OR {word('worthless')} OR {word('and')} AS ca, {word('le')} OR {word('und')} OR {word('of')} AS co, {word('that')} AS te,
        {word('with')} OR {word('que')} AS ce, {word('der')} OR {word('for')} AS nu FROM smp s LEFT JOIN rn USING (gsm)""",
}


def mined(v: Views):
    return M.suggest_manifest(geo(v), runs(v), None, RULES)


queries.add(
    "suggested_manifest",
    lambda v: mined(v)[0].select("gsm_id", "srr_id", "suggested_sample_id", "suggested_group", "suggested_condition", "suggested_tissue", "suggested_batch", "suggested_data_type", "suggestion_confidence", "review_status", "group"),
    sql("", """SELECT gsm AS gsm_id, srr AS srr_id, CASE WHEN srr = 'NA' THEN gsm ELSE gsm || '__' || srr END AS suggested_sample_id, CASE WHEN ca AND co THEN 'conflict' WHEN ca THEN 'case_candidate' WHEN co THEN 'control_candidate' ELSE 'NA' END AS suggested_group, cond AS suggested_condition, tis AS suggested_tissue, bat AS suggested_batch,
        CASE WHEN ce AND nu THEN 'conflict' WHEN nu THEN 'snRNA-seq_candidate' WHEN ce THEN 'scRNA-seq_candidate' WHEN strat = 'RNA-Seq' THEN 'bulk_RNA-seq_candidate' ELSE 'NA' END AS suggested_data_type, 'low' AS suggestion_confidence, 'pending' AS review_status, '' AS "group" FROM jn""", **GEO),
)
queries.add(
    "suggestion_conflicts", lambda v: mined(v)[1].groupBy("conflict_type", "severity").agg(F.count(F.lit(1)).alias("n")),
    sql("", """SELECT c AS conflict_type, s AS severity, count(*) AS n FROM (SELECT 'CONFLICTING_GROUP_TERMS' AS c, 'critical' AS s FROM jn WHERE ca AND co UNION ALL SELECT 'MISSING_GROUP_EVIDENCE', 'warning' FROM jn WHERE NOT ca AND NOT co UNION ALL SELECT 'TECHNICAL_REPLICATE_DESCRIPTION', 'warning' FROM jn WHERE te
        UNION ALL SELECT 'MISSING_LIBRARY_LAYOUT', 'warning' FROM jn WHERE lay = 'NA' UNION ALL SELECT 'CONFLICTING_CONDITION_VALUES', 'warning' FROM jn WHERE cond = 'conflict' UNION ALL SELECT 'CONFLICTING_DATA_TYPE_TERMS', 'critical' FROM jn WHERE ce AND nu
        UNION ALL SELECT 'MULTIPLE_SRR_FOR_GSM', 'warning' FROM (SELECT gsm FROM jn WHERE srr <> 'NA' GROUP BY gsm HAVING count(*) > 1)) GROUP BY ALL""", **GEO),
)
queries.add(
    "suggestion_unmapped", lambda v: mined(v)[2].select("gsm_id", "srr_id", "reason"),
    sql("", "SELECT gsm AS gsm_id, srr AS srr_id, 'SRA_RUN_WITHOUT_GEO_SAMPLE' AS reason FROM rn WHERE gsm NOT IN (SELECT gsm FROM smp) UNION ALL SELECT gsm, 'NA', 'GEO_SAMPLE_WITHOUT_MAPPED_SRR' FROM smp WHERE gsm NOT IN (SELECT gsm FROM rn)", **GEO),
)
queries.add(
    "term_matches", lambda v: v.t("documents").select("doc_id", X.joined_or(X.match_terms("text", ["and", "stupid", "le", "of"]), "none").alias("terms")),
    "SELECT doc_id, CASE WHEN r = '' THEN 'none' ELSE r END AS terms FROM (SELECT doc_id, concat_ws(';', " + ", ".join(f"CASE WHEN {word(t)} THEN '{t}' END" for t in ("and", "le", "of", "stupid")) + ") AS r FROM (SELECT doc_id, lower(text) AS t FROM documents))",
)
queries.add(
    "characteristics", lambda v: geo(v).select("gsm_accession", F.explode(M.characteristics("characteristics_ch1_raw")).alias("c")).groupBy("c.key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c.value").alias("distinct_values")),
    """SELECT key, count(*) AS n, count(DISTINCT value) AS distinct_values FROM (SELECT 'tissue' AS key, source AS value FROM documents WHERE doc_id % 4 IN (0, 2) UNION ALL SELECT 'condition', lang FROM documents WHERE doc_id % 4 IN (0, 1)
        UNION ALL SELECT 'Disease state', lang FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT 'disease', 'x' FROM documents WHERE doc_id % 4 = 1 UNION ALL SELECT 'batch', source FROM documents WHERE doc_id % 4 = 1) GROUP BY 1""",
)
FNAME = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*(.*)$', 1)"
queries.add(
    "supplementary_index", lambda v: M.supplementary_index(files(v), "GSE").select("gse_accession", "supplementary_url", "supplementary_file_name", "file_type"),
    f"""SELECT 'GSE_src' || (page_id % 25) AS gse_accession, url AS supplementary_url, CASE WHEN f = '' THEN 'NA' ELSE f END AS supplementary_file_name, CASE WHEN contains(f, '.') THEN regexp_replace(f, '^[^.]*\\.', '') ELSE 'NA' END AS file_type
        FROM (SELECT *, regexp_extract({FNAME}, '([^/]*)$', 1) AS f FROM pages)""",
)
queries.add(
    "entry_suggestions", lambda v: M.suggest_entry(geo(v), runs(v), M.supplementary_index(files(v), "GSE")).select("dataset_id", "srr_accession", "data_type_suggested", "entry_point_suggested", "confidence", "recommended_pipeline"),
    sql("", "SELECT 'GSE_0' AS dataset_id, srr AS srr_accession, 'bulk_RNA-seq_candidate' AS data_type_suggested, 'bulk_fastq' AS entry_point_suggested, 'medium' AS confidence, 'sra_prefetch_then_fasterq' AS recommended_pipeline FROM rn WHERE strat = 'RNA-Seq'"
        " UNION ALL SELECT gse, 'NA', d, e, 'low', p FROM (SELECT 'GSE_src' || (page_id % 25) AS gse, bool_or(contains(lower(url), 'log')) AS lg, bool_or(contains(lower(url), 'count')) AS ct FROM pages GROUP BY 1), (VALUES ('log', 'bulk_expression_candidate', 'bulk_log_expression', 'exploratory_only_no_deseq2'), ('count', 'bulk_counts_candidate', 'bulk_raw_counts', 'download_then_raw_integer_count_validation')) t(h, d, e, p) WHERE (h = 'log' AND lg) OR (h = 'count' AND ct)"
        " UNION ALL SELECT g, 'NA', 'unknown', 'ambiguous', 'low', 'manual_entry_selection_required' FROM (SELECT DISTINCT gse AS g FROM smp UNION SELECT DISTINCT 'GSE_src' || (page_id % 25) FROM pages) WHERE g NOT IN (SELECT 'GSE_src' || (page_id % 25) FROM pages WHERE contains(lower(url), 'log') OR contains(lower(url), 'count'))", **GEO),
)
queries.add(
    "suggested_plan", lambda v: M.suggest_plan(mined(v)[0].select("dataset_id", "gse_id"), "A1").select("dataset_id", "gse_id", "suggested_analysis_id", "suggested_role", "analysis_id"),
    sql("", "SELECT DISTINCT gse AS dataset_id, gse AS gse_id, 'A1' AS suggested_analysis_id, 'discovery_candidate' AS suggested_role, '' AS analysis_id FROM smp", **GEO),
)
queries.add(
    "run_accessions",
    lambda v: M.run_rows(v.t("documents").select(F.concat(F.lit("GSM"), "doc_id").alias("gsm_accession"), F.lit("g").alias("gse_accession"), F.lit("human").alias("organism"), F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("SRX"), "doc_id", F.lit(";SRX"), F.col("doc_id") + 1)).alias("srx_accessions"), F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("x=SRX"), "doc_id")).alias("relation_raw")),
                         v.t("events").select(F.concat(F.lit("SRX"), F.col("user_id") * 2).alias("Experiment"), F.concat(F.lit("SRR"), "event_id").alias("Run"), F.lit("RNA-Seq").alias("LibraryStrategy"), F.lit("T").alias("LibrarySource"), F.lit("NA").alias("LibraryLayout"), F.lit("").alias("ScientificName")))[1].groupBy("level", "event_code").agg(F.count(F.lit(1)).alias("n")),
    """SELECT CASE WHEN k = 0 THEN 'WARNING' WHEN r THEN 'INFO' ELSE 'ERROR' END AS level, CASE WHEN k = 0 THEN 'NO_SRX_RELATION' WHEN r THEN 'SRA_RUNINFO_FETCH_COMPLETE' ELSE 'SRA_RUNINFO_FETCH_FAILED' END AS event_code, count(*) AS n FROM
        (SELECT (doc_id % 3 > 0)::int AS k, x IN (SELECT user_id * 2 FROM events) AS r FROM (SELECT doc_id, doc_id AS x FROM documents UNION ALL SELECT doc_id, doc_id + 1 FROM documents WHERE doc_id % 3 > 0)) GROUP BY ALL""",
)
queries.add(
    "runs_to_samples", lambda v: J.join_runs(geo(v).select(F.col("gsm_accession").alias("gsm_id"), F.col("gsm_accession").alias("srx_id")), runs(v).select(F.col("gsm_accession").alias("srx_id"), F.col("srr_accession").alias("srr_id")))[0].select("gsm_id", "srr_id"),
    sql("", "SELECT gsm AS gsm_id, srr AS srr_id FROM jn", **GEO),
)
queries.add(
    "supplementary_to_samples",
    lambda v: J.supplementary_counts(geo(v).select(F.col("gsm_accession").alias("gsm_id"), F.col("gse_accession").alias("gse_id"), F.length("title").alias("size")), v.t("pages").select(F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("GSM"), "page_id")).otherwise(F.lit("NA")).alias("gsm_id"), F.concat(F.lit("GSE_src"), F.col("page_id") % 25).alias("gse_id"), "url"), "size"),
    """SELECT gse_id, count(*) AS n, count(*) FILTER (WHERE s IS NULL) AS unmatched FROM (SELECT 'GSE_src' || (page_id % 25) AS gse_id, doc_id AS s FROM pages LEFT JOIN documents ON doc_id = page_id WHERE page_id % 2 = 0
        UNION ALL SELECT 'GSE_src' || (page_id % 25), doc_id FROM pages LEFT JOIN documents ON source = 'src' || (page_id % 25) WHERE page_id % 2 = 1) GROUP BY 1""",
)
queries.add(
    "glob_selection", lambda v: J.select_by_glob(M.supplementary_index(files(v), "GSE").select(F.col("supplementary_file_name").alias("file_name"), F.col("supplementary_url").alias("url"), F.length("supplementary_url").alias("size_bytes")), ["*.html*", "*example.com*"], 45).groupBy("selection_status").agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE WHEN NOT (contains(lower(url), '.html') OR contains(lower(url), 'example.com')) THEN 'skipped_not_allowlisted' WHEN length(url) > 45 THEN 'skipped_size_limit' ELSE 'selected' END AS selection_status, count(*) AS n FROM pages GROUP BY 1",
)

# --- entry classification ---------------------------------------------------


def content(v: Views):
    """What a check of each file would say, derived from its path."""
    path = F.col("path")
    return reviewed(v, "files").distinct().select(
        "path", F.lit(True).alias("recognized"), F.when(path.endswith(".tsv"), F.lit("tsv_matrix")).otherwise(F.lit("fastq")).alias("file_format"), F.length("path").cast("string").alias("file_size"), F.sha2("path", 256).alias("checksum"),
        F.when(path.endswith(".tsv") & path.contains("ASIA"), F.lit("tpm")).when(path.endswith(".tsv"), F.lit("raw_integer_counts")).alias("count_type"), F.lit("true").alias("is_integer"),
        F.when(path.contains("ASIA"), F.lit("true")).otherwise(F.lit("false")).alias("likely_normalized"), F.lit("false").alias("has_negative"), F.lit("false").alias("likely_log_transformed"), F.lit("0").alias("duplicate_gene_ids"), F.lit("true").alias("sample_columns_match"))


def classified(v: Views):
    remote = v.t("pages").select(F.lit("AFRICA").alias("dataset_id"), F.concat(F.lit("S"), "page_id").alias("sample_id"), F.lit("bulk").alias("data_type_confirmed"), F.lit("x").alias("file_name"), "url", F.lit("1").alias("size_bytes"), F.lit("html").alias("file_type"))
    return E.classify_entries(reviewed(v, "manifest"), remote, content(v))


FAM = "CASE WHEN data_type = 'scrna' THEN 'single_cell' ELSE 'bulk' END"
queries.add(
    "entry_classification", lambda v: classified(v).groupBy("source_type", "entry_point", "recommended_pipeline", "technical_consistency", "paired_end_status", "status").agg(F.count(F.lit(1)).alias("n")),
    sql("", f"""SELECT source_type, entry_point, CASE WHEN source_type = 'SRA' THEN 'sra_prefetch_then_fasterq' WHEN source_type = 'GEO_supplementary' THEN 'download_then_content_classification' WHEN entry_point = 'bulk_gene_count_matrix' THEN 'bulk_raw_count_qc_then_deseq2' WHEN entry_point = 'bulk_expression_matrix_exploratory' THEN 'exploratory_only_no_deseq2'
          WHEN entry_point = 'bulk_fastq' THEN 'bulk_fastq_quantification' WHEN entry_point LIKE 'single_cell_%' THEN 'single_cell_raw_count_workflow' ELSE 'manual_entry_selection_required' END AS recommended_pipeline,
          CASE WHEN source_type = 'SRA' THEN 'unverified' WHEN source_type = 'GEO_supplementary' THEN 'warning:content_not_downloaded' WHEN fam = 'bulk' AND path LIKE '%ASIA%' AND known THEN 'warning:normalized_matrix_exploratory_only' WHEN NOT known THEN 'warning:unrecognized_content' ELSE 'consistent' END AS technical_consistency,
          ps AS paired_end_status, CASE WHEN source_type IN ('SRA', 'GEO_supplementary') THEN 'remote_candidate' WHEN known THEN 'available' ELSE 'unrecognized' END AS status, count(*) AS n FROM (
          SELECT *, CASE WHEN source_type = 'SRA' THEN fam || '_fastq_candidate' WHEN source_type = 'GEO_supplementary' THEN 'unverified_remote_candidate' WHEN NOT known THEN 'unknown' WHEN source_type = 'reviewed_fastq_path' THEN fam || '_fastq' WHEN fam = 'single_cell' THEN 'single_cell_matrix_candidate' WHEN path LIKE '%ASIA%' THEN 'bulk_expression_matrix_exploratory' ELSE 'bulk_gene_count_matrix' END AS entry_point FROM (
            SELECT 'reviewed_matrix_path' AS source_type, {FAM} AS fam, matrix_path AS path, 'NA' AS ps, matrix_path IN (SELECT path FROM files) AS known FROM manifest WHERE matrix_path NOT IN {MISS}
            UNION ALL SELECT 'reviewed_fastq_path', {FAM}, unnest([fastq_r1, fastq_r2]), CASE WHEN library_layout <> 'PAIRED' THEN 'single' WHEN fastq_r1 NOT IN {MISS} AND fastq_r2 NOT IN {MISS} THEN 'complete' ELSE 'incomplete' END, unnest([fastq_r1, fastq_r2]) IN (SELECT path FROM files) FROM manifest
            UNION ALL SELECT 'SRA', {FAM}, 'NA', CASE WHEN library_layout = 'PAIRED' THEN 'expected_paired' ELSE 'expected_single' END, true FROM manifest
            UNION ALL SELECT 'GEO_supplementary', 'bulk', 'NA', 'NA', true FROM pages) WHERE path <> 'NA' OR source_type IN ('SRA', 'GEO_supplementary')) GROUP BY ALL""".replace("unnest([fastq_r1, fastq_r2]) IN (SELECT path FROM files) FROM manifest", "NULL FROM manifest").replace("THEN 'complete' ELSE 'incomplete' END, NULL FROM manifest", "THEN 'complete' ELSE 'incomplete' END, NULL::boolean FROM manifest")
        .replace("SELECT *, CASE WHEN source_type = 'SRA' THEN fam", "SELECT * REPLACE (coalesce(known, path IN (SELECT path FROM files)) AS known), CASE WHEN source_type = 'SRA' THEN fam").replace("WHEN NOT known THEN 'unknown' WHEN source_type", "WHEN NOT coalesce(known, path IN (SELECT path FROM files)) THEN 'unknown' WHEN source_type"), **{k: TEXT[k] for k in ("manifest", "files")}),
)
queries.add(
    "final_inventory",
    lambda v: E.inventory(classified(v), reviewed(v, "manifest").where("matrix_path <> 'NA'").select("dataset_id", "sample_id", F.col("data_type").alias("data_type_confirmed"), F.col("matrix_path").alias("file_path"), F.lit("SRA").alias("source_type"), F.lit("u").alias("source_url"), F.lit("i").alias("source_id"), F.lit("NA").alias("paired_end_status"), F.when(F.col("sex") == "F", F.lit("verified")).otherwise(F.lit("error")).alias("status")), content(v)).groupBy("status").agg(F.count(F.lit(1)).alias("n")),
    sql("", f"""SELECT status, count(*) AS n FROM (SELECT CASE WHEN sex = 'F' THEN 'verified' ELSE 'error' END AS status FROM manifest WHERE matrix_path <> 'NA' UNION ALL SELECT 'remote_candidate' FROM manifest UNION ALL SELECT 'remote_candidate' FROM pages
        UNION ALL SELECT CASE WHEN p IN (SELECT path FROM files) THEN 'available' ELSE 'unrecognized' END FROM (SELECT unnest([matrix_path, fastq_r1, fastq_r2]) AS p FROM manifest) WHERE p NOT IN {MISS}) GROUP BY 1""", **{k: TEXT[k] for k in ("manifest", "files")}),
)
queries.add(
    "reviewed_inventory", lambda v: E.reviewed_inventory(reviewed(v, "manifest"), "counts.tsv").select("sample_id", "provenance_id"),
    sql("", "SELECT sample_id, substr(sha1(dataset_id || ':' || sample_id || ':counts.tsv'), 1, 12) AS provenance_id FROM manifest", manifest=TEXT["manifest"]),
)
queries.add(
    "adapter_choice",
    lambda v: E.pick_adapter(v.t("orders").select("o_orderkey", F.col("o_orderstatus").alias("input_kind")), v.t("customer").select(F.substring("c_mktsegment", 1, 1).alias("_k"), F.col("c_name").alias("adapter"), F.col("c_acctbal").alias("priority"), F.when(F.col("c_custkey") % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("enabled")).withColumn("input_kind", F.when(F.col("_k") == "F", F.lit("F")).otherwise(F.lit("O")))).groupBy("input_kind", "adapter").agg(F.count(F.lit(1)).alias("n")),
    """SELECT o_orderstatus AS input_kind, coalesce(a, 'NA') AS adapter, count(*) AS n FROM orders LEFT JOIN (SELECT CASE WHEN c_mktsegment LIKE 'F%' THEN 'F' ELSE 'O' END AS k, arg_min(c_name, (c_acctbal, c_name)) AS a FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1) ON k = o_orderstatus GROUP BY ALL""",
)

# --- audit -------------------------------------------------------------------

AUDITED = ("sample_id", "group", "tissue", "include", "review_status")
queries.add(
    "audit_trail", lambda v: A.audit_trail({"manifest": reviewed(v, "manifest").select(*AUDITED, F.col("condition").alias("group_raw"), F.col("batch").alias("group_suggested"))}, "v1").select("field", "record_id", "original_value", "suggested_value", "final_user_value", "review_status"),
    sql("", "SELECT field, sample_id AS record_id, CASE WHEN field = 'group' THEN condition ELSE 'NA' END AS original_value, CASE WHEN field = 'group' THEN batch ELSE 'NA' END AS suggested_value, val AS final_user_value, rs AS review_status FROM (SELECT sample_id, condition, batch, review_status AS rs, unnest(['sample_id', 'group', 'tissue', 'include', 'review_status']) AS field, unnest([sample_id, \"group\", tissue, include, review_status]) AS val FROM manifest)", manifest=TEXT["manifest"]),
)
queries.add("exclusion_table", lambda v: A.exclusions({"manifest": reviewed(v, "manifest"), "plan": reviewed(v, "plan")}).select("record_id", "reason", "source_file"),
            sql("", "SELECT sample_id AS record_id, notes AS reason, 'manifest' AS source_file FROM manifest WHERE include = 'false' UNION ALL SELECT analysis_id, notes, 'plan' FROM plan WHERE include = 'false'", manifest=TEXT["manifest"], plan=TEXT["plan"]))
queries.add("warning_table", lambda v: A.warnings(manifest_issues(v), "manifest").groupBy("severity").agg(F.count(F.lit(1)).alias("n")),
            sql("", "SELECT severity, count(*) AS n FROM found WHERE severity <> 'info' GROUP BY 1", manifest=TEXT["manifest"], files=TEXT["files"], **MANIFEST_RULES))
queries.add("package_manifest", lambda v: A.package_manifest(reviewed(v, "files").withColumns({"size_bytes": F.length("path"), "sha256": F.sha2("path", 256)}), ["data/ASIA.tsv"]).groupBy("reason", "included").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sha256") == "NA").alias("no_sha")),
            sql("", "SELECT r AS reason, CASE WHEN r = 'included' THEN 'true' ELSE 'false' END AS included, count(*) AS n, count(*) FILTER (WHERE r <> 'included') AS no_sha FROM (SELECT CASE WHEN path LIKE '%.fastq.gz' THEN 'excluded_large_raw_sequence_file' WHEN path = 'data/ASIA.tsv' THEN 'excluded_package_output' ELSE 'included' END AS r FROM files) GROUP BY 1", files=TEXT["files"]))
queries.add("result_provenance", lambda v: A.result_provenance(reviewed(v, "files").select("path", F.sha2("path", 256).alias("sha256")), reviewed(v, "files").where("path LIKE 'data/%'").select("path", F.sha2("path", 256).alias("sha256")), reviewed(v, "manifest"), producing_rule="r").select("result_file", "input_files", "manifest_rows"),
            sql("", "SELECT path AS result_file, (SELECT string_agg(path, ';' ORDER BY path) FROM files WHERE path LIKE 'data/%') AS input_files, (SELECT count(*) FROM manifest) AS manifest_rows FROM files", manifest=TEXT["manifest"], files=TEXT["files"]))
queries.add("report_counts", lambda v: A.summary_counts({t: v.t(t) for t in ("orders", "lineitem", "customer")}), " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("orders", "lineitem", "customer")))
queries.add("manifest_trace", lambda v: A.manifest_trace(reviewed(v, "manifest")), sql("", "SELECT sample_id, dataset_id, include, review_status FROM manifest", manifest=TEXT["manifest"]))
queries.add("wording_guard", lambda v: A.guard_wording(v.t("documents").select("doc_id", F.concat("text", F.when(F.col("doc_id") % 5 == 0, F.lit(" Causal link")).otherwise(F.lit(""))).alias("text")), ["text"]).select("doc_id", F.col("text").endswith("evidence]").alias("flagged")),
            "SELECT doc_id, contains(' ' || lower(text || CASE WHEN doc_id % 5 = 0 THEN ' Causal link' ELSE '' END) || ' ', ' causal ') OR contains(lower(text), ' driver ') OR contains(lower(text), ' mechanism ') AS flagged FROM documents")

# --- event logs and requests -------------------------------------------------

STEPS = {"signup": ("view", "click"), "view": ("click", "view", "purchase"), "click": ("view", "purchase", "error"), "purchase": ("view",)}


def log(v: Views):
    return v.t("events").select(F.col("user_id").alias("job_id"), "ts", "event_id", F.col("event_type").alias("status"))


_PAIRS = ", ".join(f"'{a}>{b}'" for a, n in STEPS.items() for b in n)
_AUDIT = f"SELECT user_id AS job_id, event_id, p AS previous_status, event_type AS status FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NOT NULL AND p || '>' || event_type NOT IN ({_PAIRS})"
queries.add("transition_audit", lambda v: Q.transition_audit(log(v), STEPS).select("job_id", "event_id", "previous_status", "status"), _AUDIT)
queries.add("current_status", lambda v: Q.current_status(log(v)), "SELECT user_id AS job_id, arg_max(event_type, (ts, event_id)) AS status, count(*) AS events, false AS terminal, true AS cancellable FROM events GROUP BY 1")


def requests(v: Views):
    c = v.t("customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("request_id"),
        F.map_filter(
            F.create_map(
                F.lit("accession"), F.when(k % 5 == 0, F.concat(F.lit("a/"), k)).otherwise(F.concat(F.lit("GSE"), k)), F.lit("analysis_type"), F.when(k % 4 == 0, F.lit("wgs")).otherwise(F.lit("bulk")), F.lit("species"), F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("Homo sapiens")),
                F.lit("output_format"), F.when(k % 3 == 0, F.lit("pdf")).otherwise(F.lit("json")), F.lit("requested_by"), F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("c_name")), F.lit("extra"), F.when(k % 10 == 0, F.lit("x")),
                F.lit("notes"), F.col("c_mktsegment")), lambda _, x: x.isNotNull()).alias("fields"))


queries.add(
    "request_screening", lambda v: Q.screen_requests(requests(v)).select("request_id", X.joined_or(F.col("problems"), "none").alias("problems"), "accepted"),
    """SELECT k AS request_id, CASE WHEN r = '' THEN 'none' ELSE r END AS problems, r = '' AS accepted FROM (SELECT c_custkey AS k, concat_ws(';', CASE WHEN c_custkey % 10 = 0 THEN 'UNKNOWN_FIELD:extra' END, CASE WHEN c_custkey % 6 = 0 THEN 'MISSING_FIELD:requested_by' END, CASE WHEN c_custkey % 5 = 0 THEN 'INVALID_ACCESSION:accession' END,
        CASE WHEN c_custkey % 7 = 0 THEN 'INVALID_REQUEST:species' END, CASE WHEN c_custkey % 6 <> 0 THEN 'INVALID_REQUEST:requested_by' END, CASE WHEN c_custkey % 4 = 0 THEN 'INVALID_ANALYSIS_TYPE:analysis_type' END, CASE WHEN c_custkey % 3 = 0 THEN 'INVALID_OUTPUT_FORMAT:output_format' END) AS r FROM customer)""",
)
queries.add(
    "dry_run_reasons",
    lambda v: Q.dry_run_reasons(v.t("events").select("event_id", F.create_map(F.lit("Mode"), F.when(F.col("event_type") == "view", F.lit("real")).otherwise(F.lit("Dry_Run")), F.lit("allow_network"), F.when(F.col("event_type") == "click", F.lit("true")).otherwise(F.lit("false")), F.lit("dataset_accession"), F.concat(F.lit("GSE"), F.when(F.col("event_id") % 5 == 0, F.lit(";")).otherwise(F.lit("1"))), F.when(F.col("event_id") % 3 == 0, F.lit("db_name")).otherwise(F.lit("title")), F.col("props")).alias("fields"))).select("event_id", X.joined_or(F.col("rejection_reasons"), "none").alias("reasons"), "accepted"),
    """SELECT event_id, CASE WHEN r = '' THEN 'none' ELSE r END AS reasons, r = '' AS accepted FROM (SELECT event_id, concat_ws(';', CASE WHEN event_type = 'view' THEN 'REAL_EXECUTION_NOT_ALLOWED' END, CASE WHEN event_type = 'click' THEN 'NETWORK_ACCESS_NOT_ALLOWED' END, CASE WHEN event_id % 5 = 0 THEN 'UNSAFE_DATASET_ACCESSION' END, CASE WHEN event_id % 3 = 0 THEN 'DATABASE_WRITE_NOT_ALLOWED' END) AS r FROM events)""",
)

# --- compatibility and routing -------------------------------------------------

FACTS = {"AFRICA": {"species": "human", "reference_genome": "GRCh38", "quantification_source": "star"}, "AMERICA": {"species": "human", "quantification_source": "star"}, "ASIA": {"species": "mouse"}}
REFS = {"genome_build": "GRCh38", "annotation_release": "v44", "gene_id_space": "ensembl"}


def profile(v: Views):
    bulk_rows = reviewed(v, "manifest").withColumns({c: F.lit("NA") for c in ("fastq_r1", "fastq_r2")}).withColumn("matrix_path", F.concat(F.lit("data/"), "dataset_id"))
    return bulk_rows, P.technical_profile(bulk_rows, FACTS, REFS)


_PROFILE = """SELECT dataset_id, CASE dataset_id WHEN 'AFRICA' THEN 'human' WHEN 'AMERICA' THEN 'human' WHEN 'ASIA' THEN 'mouse' ELSE 'unknown' END AS species, string_agg(DISTINCT tissue, ';' ORDER BY tissue) FILTER (WHERE tissue <> 'NA') AS tissue, string_agg(DISTINCT data_type, ';' ORDER BY data_type) AS data_type,
  string_agg(DISTINCT library_layout, ';' ORDER BY library_layout) AS library_layout, 'GRCh38' AS reference_genome, 'author_raw_integer_counts' AS count_source, CASE WHEN dataset_id IN ('AFRICA', 'AMERICA') THEN 'star' ELSE 'unknown' END AS quantification_source, true AS profile_requires_review
  FROM manifest WHERE include = 'true' AND review_status = 'confirmed' AND data_type LIKE '%bulk%' GROUP BY dataset_id"""
queries.add("technical_profile", lambda v: profile(v)[1].select("dataset_id", "species", "tissue", "data_type", "library_layout", "reference_genome", "count_source", "quantification_source", "profile_requires_review"), sql("", _PROFILE, manifest=TEXT["manifest"]))
queries.add(
    "compatibility_table", lambda v: P.compatibility(profile(v)[0], reviewed(v, "plan"), reviewed(v, "contrasts"), profile(v)[1]).select("analysis_id", "dataset_id", "contrast_id", "case_count", "control_count", "compatible_for_joint_model", "compatible_for_meta_analysis", "incompatibility_reason", "requires_manual_review"),
)
queries.add(
    "compatibility_counts", lambda v: P.compatibility(profile(v)[0], reviewed(v, "plan"), reviewed(v, "contrasts"), profile(v)[1]).select("analysis_id", "dataset_id", "contrast_id", "case_count", "control_count"),
    sql("", """SELECT p.analysis_id, p.dataset_id, coalesce(contrast_id, 'NA') AS contrast_id, coalesce(a.n, 0)::bigint AS case_count, coalesce(b.n, 0)::bigint AS control_count FROM plan p LEFT JOIN (SELECT * FROM contrasts WHERE enabled = 'true' AND data_scope = 'bulk') c USING (analysis_id)
        LEFT JOIN gc a ON a.dataset_id = p.dataset_id AND a.g = coalesce(numerator, 'case') LEFT JOIN gc b ON b.dataset_id = p.dataset_id AND b.g = coalesce(denominator, 'control') WHERE p.include = 'true'""",
        manifest=TEXT["manifest"], plan=TEXT["plan"], contrasts=TEXT["contrasts"], gc="SELECT dataset_id, \"group\" AS g, count(*) AS n FROM manifest WHERE include = 'true' AND review_status = 'confirmed' AND data_type LIKE '%bulk%' GROUP BY ALL"),
)
queries.add("single_value", lambda v: P.single_value(v.t("customer"), ["c_nationkey"], "c_mktsegment"), "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS c_mktsegment, count(DISTINCT c_mktsegment) <> 1 AS c_mktsegment_review FROM customer GROUP BY 1")
queries.add("strategy_routing", lambda v: P.route(reviewed(v, "plan")), sql("", "SELECT analysis_id, CASE WHEN count(DISTINCT analysis_strategy) = 1 THEN min(analysis_strategy) ELSE 'mixed_strategies' END AS analysis_strategy, count(*) AS datasets FROM plan WHERE include = 'true' GROUP BY 1", plan=TEXT["plan"]))
queries.add(
    "required_compatibility",
    lambda v: J.require_compatible(reviewed(v, "plan").where("include = 'true'").select("analysis_id", "dataset_id", F.lit("C").alias("contrast_id")), v.t("region").select(F.lit("A1").alias("analysis_id"), F.col("r_name").alias("dataset_id"), F.lit("C").alias("contrast_id"), F.when(F.col("r_regionkey") < 3, F.lit("true")).otherwise(F.lit("false")).alias("ok"), F.lit("why").alias("incompatibility_reason")), "ok"),
    sql("", "SELECT p.analysis_id, p.dataset_id, 'C' AS contrast_id, CASE WHEN r_regionkey IS NULL THEN 'missing' ELSE 'why' END AS reason FROM plan p LEFT JOIN region ON r_name = dataset_id AND p.analysis_id = 'A1' WHERE include = 'true' AND (r_regionkey IS NULL OR r_regionkey >= 3)", plan=TEXT["plan"]),
)

# --- small scalar functions ------------------------------------------------------

queries.add("id_versions", lambda v: v.t("part").select("p_partkey", X.strip_version(F.concat(F.lit("ENSG"), "p_partkey", F.lit("."), "p_size")).alias("gene_id"), X.safe_name("p_name").alias("safe_name")), "SELECT p_partkey, 'ENSG' || p_partkey AS gene_id, regexp_replace(p_name, '[^A-Za-z0-9._-]', '_', 'g') AS safe_name FROM part")
queries.add("prefix_masks", lambda v: v.t("part").select("p_partkey", X.gene_mask("p_name", "p_brand", ["red ", "Brand#1"]).alias("masked")), "SELECT p_partkey, p_name LIKE 'red %' OR p_brand LIKE 'Brand#1%' AS masked FROM part")
queries.add("type_family", lambda v: reviewed(v, "manifest").groupBy(E.family("data_type").alias("family"), X.is_bulk("data_type").alias("bulk"), X.is_single_cell("data_type").alias("cell")).agg(F.count(F.lit(1)).alias("n")),
            sql("", "SELECT CASE WHEN data_type = 'scrna' THEN 'single_cell' ELSE 'bulk' END AS family, data_type <> 'scrna' AS bulk, data_type = 'scrna' AS cell, count(*) AS n FROM manifest GROUP BY ALL", manifest=TEXT["manifest"]))
queries.add("barcode_shape", lambda v: reviewed(v, "manifest").select("line", X.looks_like_barcode("subject_id").alias("barcode")), sql("", "SELECT line, regexp_full_match(subject_id, '[ACGTN]{12,}(-[0-9]+)?') AS barcode FROM manifest", manifest=TEXT["manifest"]))
queries.add("split_identifiers", lambda v: reviewed(v, "manifest").select("line", F.explode(X.split_ids("srr_id")).alias("srr")), sql("", "SELECT line, unnest(string_split(srr_id, ';')) AS srr FROM manifest", manifest=TEXT["manifest"]))
queries.add("p_scores", lambda v: rounded(v.t("lineitem").select("l_orderkey", "l_linenumber", S.p_score(F.when(F.col("l_discount") > 0, F.col("l_discount"))).alias("score"), S.direction(F.col("l_tax") - 0.04, F.col("l_discount") - 0.05).alias("direction"), S.evidence_level(F.col("l_discount") * 10).alias("level")), "score"),
            "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN round(least(1.0, greatest(0.0, -log10(l_discount) / 10)), 6) ELSE 0.0 END AS score, CASE WHEN l_tax - 0.04::double = 0 OR l_discount - 0.05::double = 0 THEN 'not_comparable' WHEN sign(l_tax - 0.04::double) = sign(l_discount - 0.05::double) THEN 'same' ELSE 'opposite' END AS direction, CASE WHEN l_discount * 10 >= 0.75 THEN 'high' WHEN l_discount * 10 >= 0.5 THEN 'moderate' WHEN l_discount * 10 >= 0.25 THEN 'low' ELSE 'limited' END AS level FROM lineitem")
queries.add("url_parts", lambda v: v.t("pages").select("page_id", X.url_scheme("url").alias("scheme"), F.coalesce(X.url_file_name("url"), F.lit("")).alias("file_name")), f"SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract({FNAME}, '([^/]*)$', 1) AS file_name FROM pages")

# --- further provenance ------------------------------------------------------------


def hashed(v: Views):
    return reviewed(v, "files").distinct().withColumns({"sha256": F.sha2("path", 256), "size_bytes": F.length("path")})


queries.add(
    "download_verification",
    lambda v: J.verify_files(reviewed(v, "manifest").where("fastq_r1 <> 'NA'").select("line", F.col("fastq_r1").alias("path"), F.when(F.col("line") % 4 == 0, F.lit("other")).otherwise(F.sha2("fastq_r1", 256)).alias("sha256")), hashed(v).withColumn("integrity", F.when(F.length("path") % 2 == 0, F.lit("fail")).otherwise(F.lit("pass")))).select("line", "verification_status"),
    sql("", "SELECT line, CASE WHEN fastq_r1 NOT IN (SELECT path FROM files) THEN 'missing_file' WHEN line % 4 = 0 THEN 'checksum_mismatch' WHEN length(fastq_r1) % 2 = 0 THEN 'fastq_integrity_failed' ELSE 'verified' END AS verification_status FROM manifest WHERE fastq_r1 <> 'NA'", manifest=TEXT["manifest"], files=TEXT["files"]),
)
queries.add(
    "reference_table", lambda v: A.reference_table(v.t("region").select(F.concat(F.lit("f"), "r_regionkey").alias("field"), F.when(F.col("r_regionkey") < 3, F.concat(F.lit("data/"), "r_name", F.lit(".tsv"))).otherwise(F.lit("nowhere")).alias("value")), hashed(v)),
    sql("", "SELECT 'f' || r_regionkey AS field, CASE WHEN r_regionkey < 3 THEN 'data/' || r_name || '.tsv' ELSE 'nowhere' END AS value, CASE WHEN r_regionkey < 3 THEN sha256('data/' || r_name || '.tsv') ELSE 'NA' END AS sha256, r_regionkey < 3 AS exists FROM region"),
)
queries.add(
    "reproducibility_manifest", lambda v: A.reproducibility_manifest(hashed(v), ["data/ASIA.tsv", "data/AFRICA.tsv"]).select("artifact", "sha256"),
    sql("", "SELECT r_name || '.tsv' AS artifact, sha256('data/' || r_name || '.tsv') AS sha256 FROM region WHERE r_name IN ('ASIA', 'AFRICA')"),
)
queries.add("snapshot_hashes", lambda v: A.snapshot_hashes(hashed(v), ["ASIA.tsv"]), "SELECT 'data/' || r_name || '.tsv' AS path, sha256('data/' || r_name || '.tsv') AS sha256 FROM region WHERE r_name = 'ASIA'")
queries.add(
    "bulk_provenance",
    lambda v: A.bulk_provenance(v.samples("nation").withColumn("position", F.col("sample_id")), v.t("region").select(F.col("r_name").alias("dataset_id"), F.lit("matrix").alias("entry_branch")), {"species": "human"}, "star").select("dataset_id", F.get_json_object("payload", "$.sample_count").cast("bigint").alias("n"), F.get_json_object("payload", "$.sample_ids_in_analysis_order[0]").alias("first_sample"), F.get_json_object("payload", "$.quantification_method").alias("method")),
    sql("samples_nation", "SELECT dataset_id, count(*) AS n, min(sample_id) AS first_sample, 'provided_matrix' AS method FROM samples_nation GROUP BY 1"),
)
