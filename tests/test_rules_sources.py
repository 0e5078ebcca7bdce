"""Rules on planted violations, and sources on files written here."""

import pytest
from pyspark.sql import functions as F

from countloom.operators import audit, eventlog, mining, ordered
from countloom.operators.rules import authority, design, issues, manifest, matrix
from countloom.schemas import TABLES
from countloom.sources import files, matrices, tables


def one_issue(spark, severity, analysis="NA", dataset="NA"):
    return issues.issue(spark.range(1), severity, "s", "CHECK", "m", "a", analysis_id=F.lit(analysis), dataset_id=F.lit(dataset))


def test_gate_scopes(spark):
    plan = spark.createDataFrame([("A1", "D1", "true"), ("A2", "D2", "true"), ("A3", "D1", "false")], "analysis_id string, dataset_id string, include string")

    def blocked(df):
        return {r.analysis_id for r in issues.gate(df, plan).where("blocked").collect()}

    assert blocked(one_issue(spark, "warning")) == set()
    assert blocked(one_issue(spark, "error", "A1")) == {"A1"}
    assert blocked(one_issue(spark, "error", dataset="D1;D2")) == {"A1", "A2"}
    assert blocked(one_issue(spark, "error")) == {"A1", "A2", "A3"}
    assert blocked(one_issue(spark, "critical", "A1")) == {"A1", "A2", "A3"}
    with pytest.raises(RuntimeError):
        issues.require_open(one_issue(spark, "error", "A1"), plan, "A1")
    issues.require_open(one_issue(spark, "error", "A1"), plan, "A2")


def test_long_lists_are_split_but_whole(spark):
    pairs = spark.range(2500).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("item"))
    rows = issues.listed(pairs, ["key"], "item").collect()
    assert len(rows) > 1 and sum(len(r["items"]) for r in rows) == 2500
    assert issues.listed(pairs.limit(5), ["key"], "item").count() == 1


def matrix_checks(spark, values, order=("s1", "s2"), label="counts.tsv"):
    entries = spark.createDataFrame([("D", g, s, v) for g, row in values for s, v in zip(("s1", "s2"), row)], "dataset_id string, gene_id string, sample_id string, value_text string")
    samples = spark.createDataFrame([("D", s, i) for i, s in enumerate(order)], "dataset_id string, sample_id string, position int")
    labels = spark.createDataFrame([("D", label)], "dataset_id string, label string")
    return {r.check_id for r in matrix.validate_counts(entries, samples, labels).collect()}


def test_matrix_rules(spark):
    good = [("g1", ("1", "2")), ("g2", ("30", "4000"))]
    assert matrix_checks(spark, good) == {"BULK_COUNT_MATRIX_VALID"}
    assert matrix_checks(spark, good, ("s2", "s1")) == {"BULK_SAMPLE_ORDER_MISMATCH"}
    assert "BULK_SAMPLE_COLUMNS_MISMATCH" in matrix_checks(spark, good, ("s1", "s3"))
    assert matrix_checks(spark, good, label="x_tpm.tsv") == {"NORMALIZED_BULK_MATRIX_SUSPECTED"}
    assert matrix_checks(spark, [("g1", ("1.5", "2")), ("g2", ("3", "4"))]) == {"NON_INTEGER_BULK_COUNTS", "NORMALIZED_BULK_MATRIX_SUSPECTED"}
    assert {"NEGATIVE_BULK_COUNTS", "NON_NUMERIC_BULK_COUNTS", "DUPLICATE_BULK_GENE_IDS", "BLANK_BULK_GENE_IDS"} <= matrix_checks(spark, [("g1", ("-1", "x")), ("g1", ("3", "4")), (" ", ("3", "4"))])
    assert matrix_checks(spark, [*good, ("z", ("0", "0"))]) == {"ALL_ZERO_BULK_GENES", "BULK_COUNT_MATRIX_VALID"}


def design_inputs(spark, rows, formula):
    samples = spark.createDataFrame([("D", f"s{i}", "true", "confirmed", g, b, a) for i, (g, b, a) in enumerate(rows)], "dataset_id string, sample_id string, include string, review_status string, group string, batch string, age string")
    contrasts = spark.createDataFrame([("C", "A", "bulk", "case", "control", "NA", "NA", formula, "false", "1", "true")], ", ".join(f"{c} string" for c in TABLES["contrasts"].columns[:-1]))
    plan = spark.createDataFrame([("A", "D", "true")], "analysis_id string, dataset_id string, include string")
    return {r.check_id: r for r in design.validate_design(samples, contrasts, plan, 0.2).collect()}


def test_design_rank(spark):
    good = design_inputs(spark, [("case", "x", "30"), ("case", "y", "40"), ("control", "x", "35"), ("control", "y", "50")], "~ group + batch + age")
    assert set(good) == {"DESIGN_MATRIX_FULL_RANK"} and good["DESIGN_MATRIX_FULL_RANK"].n_columns == "4"
    tied = design_inputs(spark, [("case", "x", "1"), ("case", "x", "2"), ("control", "y", "3"), ("control", "y", "5")], "~ group + batch")
    assert tied["DESIGN_MATRIX_NOT_FULL_RANK"]["rank"] == "2" and tied["DESIGN_MATRIX_NOT_FULL_RANK"].n_columns == "3"
    gaps = design_inputs(spark, [("case", "NA", "1"), ("case", "x", "2"), ("control", "y", "3"), ("control", "x", "5")], "~ group + batch")
    assert {"SEVERE_MISSING_COVARIATE", "DESIGN_ROWS_DROPPED"} <= set(gaps)
    assert "DESIGN_FORMULA_INVALID" in design_inputs(spark, [("case", "x", "1"), ("control", "y", "2")], "~ group + moon")
    assert "ZERO_VARIANCE_COVARIATE" in design_inputs(spark, [("case", "x", "1"), ("control", "x", "2")], "~ group + batch")


def test_references_and_fixture_headers(spark):
    branch = spark.createDataFrame([("D", "fastq"), ("M", "matrix")], "dataset_id string, entry_branch string")
    refs = spark.createDataFrame([("species", "human"), ("genome_build", "unknown"), ("gtf", "a.gtf")], "field string, value string")
    present = spark.createDataFrame([("b.gtf",)], "path string")
    got = [r.check_id for r in manifest.validate_references(branch, refs, present, "salmon_tximport").collect()]
    assert sorted(set(got)) == ["BULK_REFERENCE_METADATA_MISSING", "BULK_REFERENCE_PATH_MISSING", "BULK_REFERENCE_PATH_NOT_FOUND"] and len(got) == 3 + 3 + 1
    assert "UNSUPPORTED_BULK_QUANTIFICATION_METHOD" in {r.check_id for r in manifest.validate_references(branch, refs, present, "other").collect()}
    assert manifest.missing_columns(refs, ("field", "group"), "manifest", "MISSING_REQUIRED_MANIFEST_COLUMN").count() == 1
    assert manifest.validate_manifest(None, present, spark).first().check_id == "REVIEWED_MANIFEST_MISSING"


def test_authority_files(spark, tmp_path):
    columns = TABLES["dataset_plan"].columns
    path = tmp_path / "plan.tsv"
    path.write_text("\t".join(columns) + "\nA\tD\ttrue\tdiscovery\tNA\tjoint_model\tNA\tNA\n\t\t\t\t\t\t\t\nA\tD\n")
    lines = tables.numbered_lines(spark, str(path)).select("line", "text")
    assert {(r.check_id, r.line) for r in authority.header_rules(lines, "dataset_plan").collect()} == {("BLANK_ROW", 3), ("COLUMN_COUNT_MISMATCH", 4)}
    assert tables.read_authority(spark, str(path), "dataset_plan").count() == 1
    assert tables.read_authority(spark, str(tmp_path / "none.tsv"), "dataset_plan").count() == 0
    before = spark.createDataFrame([("a", "1"), ("b", "2")], "table string, sha256 string")
    after = spark.createDataFrame([("a", "1"), ("b", "3")], "table string, sha256 string")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "table string")
    assert {r.check_id for r in authority.file_rules(before, after, expected).collect()} == {"MISSING_AUTHORITY_FILE", "AUTHORITY_FILE_MUTATED"}


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("".join(f"row {i}\n" for i in range(1, 5001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = tables.numbered_lines(spark, str(path))
        assert df.where(F.concat(F.lit("row "), "line") != F.col("text")).count() == 0 and df.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_read_files(spark, tmp_path):
    (tmp_path / "ok.fastq").write_text("@a\nAC\n+\nII\n@b\nAC\n+\nII\n")
    (tmp_path / "bad.fastq").write_text("@a\nAC\n+\n")
    got = {r.file.rsplit("/", 1)[1]: r for r in files.fastq_integrity(spark, str(tmp_path / "*.fastq")).collect()}
    assert got["ok.fastq"].integrity == "pass" and got["ok.fastq"].records == 2 and got["bad.fastq"].integrity == "fail"
    (tmp_path / "m.tsv").write_text("gene,s1,s1\ng1,1,2\n")
    assert matrices.matrix_columns(spark, str(tmp_path / "m.tsv")).first().copies == 2
    (tmp_path / "w.tsv").write_text("gene\ts1\ts2\ng1\t1\tx\n")
    assert {(r.sample_id, r.value_text) for r in matrices.read_count_matrix(spark, str(tmp_path / "w.tsv")).collect()} == {("s1", "1"), ("s2", "x")}
    (tmp_path / "a.gmt").write_text("S\td\tg1\tg2\tg1\n")
    assert matrices.read_gmt(spark, str(tmp_path / "a.gmt")).count() == 2
    inv = files.inventory_files(spark, str(tmp_path))
    assert inv.count() == 3 and inv.where("length(sha256) = 64").count() == 3


def test_mining_only_suggests(spark):
    samples = spark.createDataFrame([("GSM1", "GSE1", "Patient biopsy", "blood", '["condition: lupus", "tissue: skin"]'), ("GSM2", "GSE1", "x", "NA", '{"a": ["condition: a", "condition: b"]}')], "gsm_accession string, gse_accession string, title string, source_name string, characteristics_ch1_raw string")
    runs = spark.createDataFrame([("GSE1", "GSM1", "SRX1", r, "RNA-Seq", "T", "NA") for r in ("SRR1", "SRR2")] + [("GSE1", "GSM9", "SRX9", "SRR9", "RNA-Seq", "T", "PAIRED")], "gse_accession string, gsm_accession string, srx_accession string, srr_accession string, library_strategy string, library_source string, library_layout string")
    rules = {"case_candidate_terms": ["patient"], "control_candidate_terms": ["healthy"], "technical_replicate_terms": ["rep"], "scrna_terms": ["scrna"], "snrna_terms": ["nucleus"], "condition_keys": ["condition"], "tissue_keys": ["tissue"], "batch_keys": ["batch"]}
    rows, conflicts, lost = mining.suggest_manifest(samples, runs, None, rules)
    first = rows.where("gsm_id = 'GSM1'").collect()
    assert len(first) == 2 and {r.suggested_group for r in first} == {"case_candidate"} and {r.suggested_tissue for r in first} == {"skin"} and {r.group for r in first} == {""} and {r.review_status for r in first} == {"pending"}
    assert rows.where("gsm_id = 'GSM2'").first().suggested_condition == "conflict"
    assert {"MULTIPLE_SRR_FOR_GSM", "MISSING_LIBRARY_LAYOUT", "CONFLICTING_CONDITION_VALUES", "MISSING_GROUP_EVIDENCE"} == {r.conflict_type for r in conflicts.collect()}
    assert {(r.gsm_id, r.reason) for r in lost.collect()} == {("GSM9", "SRA_RUN_WITHOUT_GEO_SAMPLE"), ("GSM2", "GEO_SAMPLE_WITHOUT_MAPPED_SRR")}


def test_event_log_and_requests(spark):
    log = spark.createDataFrame([(1, 1, 1, "queued"), (1, 2, 2, "validating"), (1, 3, 3, "completed"), (1, 4, 4, "running"), (2, 1, 5, "queued")], "job_id int, ts int, event_id int, status string")
    bad = eventlog.transition_audit(log).collect()
    assert {(r.previous_status, r.status, r.after_terminal) for r in bad} == {("validating", "completed", False), ("completed", "running", True)}
    asks = spark.createDataFrame([(1, {"mode": "dry_run"}), (2, {"Mode": "run", "api_key": "x", "allow_network": "true", "note": "use SNAKEMAKE"})], "request_id int, fields map<string,string>")
    got = {r.request_id: r.rejection_reasons for r in eventlog.dry_run_reasons(asks).collect()}
    assert got == {1: [], 2: ["REAL_EXECUTION_NOT_ALLOWED", "NETWORK_ACCESS_NOT_ALLOWED", "SNAKEMAKE_NOT_ALLOWED", "SECRET_FIELD_NOT_ALLOWED"]}


def test_audit_folds_raw_and_suggested(spark):
    df = spark.createDataFrame([("S1", "case", "raw", "sug", "confirmed", "true")], "sample_id string, group string, group_raw string, group_suggested string, review_status string, include string")
    rows = {r.field: r for r in audit.audit_trail({"m": df}, "v").collect()}
    assert set(rows) == {"sample_id", "group", "review_status", "include"} and (rows["group"].original_value, rows["group"].suggested_value, rows["group"].final_user_value) == ("raw", "sug", "case")
    assert audit.exclusions({"m": df}).count() == 0


def test_order_within_long_and_null_keys(spark):
    rows = [("a" if i % 5 else None, (i * 7919) % 3000, f"s{i % 4}") for i in range(3000)]
    want, last, place = {}, {}, {}
    for k, i, s in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        place[k] = place.get(k, 0) + 1
        want[k, i] = (last.get(k), place[k])
        last[k] = s
    df = spark.createDataFrame(rows, "k string, i int, s string")
    before = {(r.k, r.i): r.previous and r.previous.s for r in ordered.previous_row(df, ["k"], ["i"], ["s"]).collect()}
    places = {(r.k, r.i): r.place for r in ordered.numbered(df, ["k"], ["i"]).collect()}
    assert {key: (before[key], places[key]) for key in want} == want and len(before) == len(places) == 3000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordered.ranged(df, ["k"], ["i"])
        assert cut.where("k = 'a'").select("_range").distinct().count() > 4
        again = {(r.k, r.i): r.place for r in ordered.numbered(df, ["k"], ["i"]).collect()}
        moved = {(r.k, r.i): r.previous and r.previous.s for r in ordered.previous_row(df, ["k"], ["i"], ["s"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert again == places and moved == before


def test_order_of_empty_and_tied_rows(spark):
    none = spark.createDataFrame([], "k string, i int, s string")
    assert ordered.previous_row(none, ["k"], ["i"], ["s"]).count() == ordered.numbered(none, ["k"], ["i"]).count() == 0
    tied = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("a", None, None)], "k string, i int, s string")
    got = {r.s: r.previous for r in ordered.previous_row(tied, ["k"], ["i"], ["s"]).collect()}
    assert got[None] is None and got["x"].s is None and got["y"].s == "x"


def test_matrix_with_repeated_dotted_names_and_ragged_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text('gene,"S,1",S.2,S.2\ng1,1,2,3\ng2,4\ng3,1,2,3,4\ng4,5,6,7\n')
    path = str(tmp_path / "m.csv")
    got = sorted((r.gene_id, r.sample_id, r.value_text) for r in matrices.read_count_matrix(spark, path).where("gene_id IN ('g1', 'g4')").collect())
    assert got == [("g1", "S,1", "1"), ("g1", "S.2", "2"), ("g1", "S.2", "3"), ("g4", "S,1", "5"), ("g4", "S.2", "6"), ("g4", "S.2", "7")]
    assert {(r.problem, r.text) for r in matrices.matrix_problems(spark, path).collect()} == {("malformed_row", "g2,4"), ("malformed_row", "g3,1,2,3,4"), ("repeated_column", "S.2")}
    about = matrices.inspect_matrix(spark, path).first()
    assert (about.row_count, about.malformed_rows, about.genes, about.total, about.count_type) == (4, 2, 2, 24.0, "raw_integer_counts")
    (tmp_path / "e.csv").write_text("gene,S1\n")
    bare = matrices.inspect_matrix(spark, str(tmp_path / "e.csv")).first()
    assert (bare.row_count, bare.malformed_rows, bare.genes) == (0, 0, None)


def test_faults_of_a_long_cell_table(spark, tmp_path):
    head = "\t".join(matrices.CELL_COLUMNS)
    lines = ["c1 D S P g B G1 3", "c1 D S P g T G2 4", "c2 D S NA g B G1 1.5", "c3 D S P null B G1 -3", "c4 D S P g B G1 x"]
    (tmp_path / "c.tsv").write_text("\n".join([head, *[x.replace(" ", "\t") for x in lines]]) + "\n")
    path = str(tmp_path / "c.tsv")
    assert sorted((r.problem, r.cell_id) for r in matrices.cell_problems(spark, path).collect()) == [
        ("fractional_count", "c2"), ("missing_group", "c3"), ("missing_subject", "c2"), ("negative_count", "c3"), ("not_a_number", "c4"), ("several_identities", "c1")]
    assert sorted((r.cell_id, r["count"]) for r in matrices.read_cell_counts(spark, path).where("count IS NOT NULL").collect()) == [("c1", 3), ("c1", 4), ("c3", -3)]


def test_supplementary_counts_are_those_of_the_rows(spark):
    from countloom.operators import joins
    from pyspark.sql import functions as F

    samples = spark.createDataFrame([("g1", "a", "x"), ("g2", "a", None), ("g3", "b", "y"), (None, None, "z")], "gsm_id string, gse_id string, size string")
    files = spark.createDataFrame([("g1", "a", "u"), ("g9", "a", "u"), ("NA", "a", "u"), (None, "a", "v"), ("NA", "c", "w"), ("NA", None, "w")], "gsm_id string, gse_id string, url string")
    rows = joins.join_supplementary(samples, files).groupBy("gse_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("size") == "NA").alias("unmatched"))
    assert sorted(map(str, joins.supplementary_counts(samples, files, "size").collect())) == sorted(map(str, rows.collect()))


def test_lines_of_a_file_never_meet_in_one_task(spark, tmp_path):
    (tmp_path / "m.mtx").write_text("%%MatrixMarket\n3 2 4\n1 1 5\n2 1 7\n3 2 x\n9 2 1\n")
    (tmp_path / "f.txt").write_text("G1\nG2\nG3\n")
    (tmp_path / "b.txt").write_text("S1\nS2\n")
    paths = [str(tmp_path / n) for n in ("m.mtx", "f.txt", "b.txt")]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for lines in (matrices.mtx_entries(spark, paths[0]), matrices.listed_names(spark, paths[1], "row", "name"), matrices.normalize_feature_counts(spark, paths[0])):
            assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
        rows = matrices.read_mtx(spark, *paths).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, (("S1", "G1", 5.0), ("S1", "G2", 7.0), ("S2", "G3", None), ("S2", None, 1.0))))
