"""Joins with explicit match checks; nothing is repaired, mismatches become rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.functions.missing import col, is_missing, is_true, or_na, present
from countloom.functions.text import match_globs, strip_version
from countloom.operators.ordered import numbered


def match_samples(expected: DataFrame, observed: DataFrame, keys: Sequence[str] = ("dataset_id", "sample_id")) -> DataFrame:
    """Full outer match of reviewed samples and matrix columns, one status each."""
    keys = list(keys)
    left = expected.select(*keys).distinct().withColumn("_e", F.lit(1))
    right = observed.select(*keys).distinct().withColumn("_o", F.lit(1))
    status = (
        F.when(F.col("_o").isNull(), F.lit("missing_in_matrix"))
        .when(F.col("_e").isNull(), F.lit("extra_in_matrix"))
        .otherwise(F.lit("matched"))
    )
    return left.join(right, keys, "full_outer").select(*keys, status.alias("match_status"))


def check_order(expected: DataFrame, observed: DataFrame, by: str = "dataset_id") -> DataFrame:
    """Same samples in another order?  Positions are compared by join, never collected.

    Both tables hold (by, sample_id, position); positions need only be sortable, ties
    stand by sample.  A dataset's samples are numbered over many tasks.
    """
    def placed(df: DataFrame, name: str) -> DataFrame:
        return numbered(df.select(by, "sample_id", "position"), [by], ["position", "sample_id"], name).drop("position")

    both = placed(expected, "_a").join(placed(observed, "_b"), [by, "sample_id"])
    moved = F.count_if(F.col("_a") != F.col("_b"))
    return both.groupBy(by).agg(moved.alias("moved"), (moved == 0).alias("same_order"))


def merge_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-sample tables stacked; check the result with ``gene_space``."""
    return reduce(lambda a, b: a.unionByName(b), parts)


stack_datasets = merge_counts


def gene_space(counts: DataFrame) -> DataFrame:
    """Genes missing from some sample, or listed twice, per dataset."""
    samples = counts.select("dataset_id", "sample_id").distinct().groupBy("dataset_id").agg(F.count(F.lit(1)).alias("sample_count"))
    once = counts.groupBy("dataset_id", "gene_id", "sample_id").agg(F.count(F.lit(1)).alias("_copies"))
    gene = once.groupBy("dataset_id", "gene_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("_copies").alias("_rows"))
    return gene.join(samples, "dataset_id").groupBy("dataset_id", "sample_count").agg(
        F.count(F.lit(1)).alias("genes"),
        F.count_if(F.col("_n") == F.col("sample_count")).alias("complete_genes"),
        F.count_if(F.col("_n") != F.col("sample_count")).alias("incomplete_genes"),
        F.count_if(F.col("_rows") > F.col("_n")).alias("duplicated_genes"),
    )


def shared_gene_space(counts: DataFrame) -> DataFrame:
    """Do all datasets list the same genes?  A joint matrix needs them identical."""
    listed = counts.select("dataset_id", "gene_id").distinct()
    datasets = listed.agg(F.count_distinct("dataset_id").alias("_all"))
    spread = listed.groupBy("gene_id").agg(F.count(F.lit(1)).alias("_in"))
    whole = F.col("_in") == F.col("_all")
    return listed.join(spread, "gene_id").crossJoin(F.broadcast(datasets)).groupBy("dataset_id").agg(  # one row
        F.count_if(whole).alias("shared_genes"), F.count_if(~whole).alias("unshared_genes"), F.bool_and(whole).alias("identical")
    )


def join_runs(samples: DataFrame, runs: DataFrame, key: str = "srx_id") -> tuple[DataFrame, DataFrame]:
    """(samples with every run kept, unmapped on either side).

    A sample without a run gets one row with ``srr_id`` NA.
    """
    rest = [c for c in runs.columns if c != key]
    usable = runs.where(present(key))
    joined = samples.join(usable, key, "left").select(*samples.columns, *[or_na(c).alias(c) for c in rest])
    lost_runs = usable.join(samples.select(key).where(present(key)).distinct(), key, "left_anti").select(
        F.lit("SRA_RUN_WITHOUT_GEO_SAMPLE").alias("reason"), F.lit("NA").alias("gsm_id"), F.col("srr_id"), F.col(key)
    )
    bare = samples.join(usable.select(key).distinct(), key, "left_anti").select(
        F.lit("GEO_SAMPLE_WITHOUT_MAPPED_SRR").alias("reason"), "gsm_id", F.lit("NA").alias("srr_id"), or_na(key).alias(key)
    )
    return joined, lost_runs.unionByName(bare)


def join_supplementary(samples: DataFrame, files: DataFrame) -> DataFrame:
    """Files matched by sample accession when they have one, by series otherwise."""
    rest = [c for c in samples.columns if c not in ("gsm_id", "gse_id")]
    names = [c for c in files.columns if c not in ("gsm_id", "gse_id")]
    by_sample = files.where(present("gsm_id")).join(samples.select("gsm_id", *rest), "gsm_id", "left").select("gsm_id", "gse_id", *names, *rest)
    by_series = files.where(is_missing("gsm_id")).join(samples.select("gse_id", *rest), "gse_id", "left").select(
        or_na("gsm_id").alias("gsm_id"), "gse_id", *names, *rest
    )
    both = by_sample.unionByName(by_series)
    return both.select("gsm_id", "gse_id", *names, *[or_na(c).alias(c) for c in rest])


def supplementary_counts(samples: DataFrame, files: DataFrame, field: str) -> DataFrame:
    """Per series the rows of ``join_supplementary`` and those whose ``field`` is missing.

    A file without a sample accession meets every sample of its series: those rows are
    counted from the sizes of both sides and never made.
    """
    def missing(of: str):
        return F.count_if(or_na(of) == "NA")

    named = join_supplementary(samples, files.where(present("gsm_id"))).groupBy("gse_id").agg(F.count(F.lit(1)).alias("n"), missing(field).alias("unmatched"))
    series = samples.groupBy("gse_id").agg(F.count(F.lit(1)).alias("_all"), missing(field).alias("_bare"))
    loose = files.where(is_missing("gsm_id")).groupBy("gse_id").agg(F.count(F.lit(1)).alias("_files")).join(series, "gse_id", "left")
    each = [(F.col("_files") * F.coalesce(c, F.lit(1))).alias(n) for c, n in (("_all", "n"), ("_bare", "unmatched"))]
    return named.unionByName(loose.select("gse_id", *each)).groupBy("gse_id").agg(F.sum("n").alias("n"), F.sum("unmatched").alias("unmatched"))


def require_compatible(grid: DataFrame, table: DataFrame, flag: str) -> DataFrame:
    """Required (analysis, dataset, contrast) rows that are missing or not ``true``."""
    keys = [c for c in ("analysis_id", "dataset_id", "contrast_id") if c in grid.columns]
    one = table.groupBy(*keys).agg(F.min(flag).alias("_flag"), F.min("incompatibility_reason").alias("_why"))
    joined = grid.join(one, keys, "left")
    return joined.where(F.col("_flag").isNull() | (F.col("_flag") != "true")).select(
        *keys, F.coalesce("_why", F.lit("missing")).alias("reason")
    )


def expand_contrasts(plan: DataFrame, contrasts: DataFrame) -> DataFrame:
    """Included plan rows times the enabled bulk contrasts of their analysis.

    An analysis without one keeps a single NA/case/control row.
    """
    enabled = contrasts.where(is_true("enabled") & (F.col("data_scope") == "bulk")).select(
        "analysis_id", "contrast_id", "numerator", "denominator"
    )
    rows = plan.where(is_true("include")).join(enabled, "analysis_id", "left")
    return rows.withColumns(
        {
            "contrast_id": F.coalesce("contrast_id", F.lit("NA")),
            "numerator": F.coalesce("numerator", F.lit("case")),
            "denominator": F.coalesce("denominator", F.lit("control")),
        }
    )


def map_genes(df: DataFrame, mapping: DataFrame, versions: bool = True, gene: str = "gene_id") -> DataFrame:
    """Rows with canonical ids; every candidate of an ambiguous id is kept and marked.

    The original id is tried, then the id without version.  The mapping is
    reduced per original id first, so rows of ``df`` are joined once.
    """
    resolved = resolve_genes(df.select(F.col(gene).cast("string").alias("original_gene_id")), mapping, versions)
    base = df.withColumn("_original", F.col(gene).cast("string")).drop(*[c for c in resolved.columns if c in df.columns])
    return base.join(resolved.withColumnRenamed("original_gene_id", "_original"), "_original").withColumnRenamed("_original", "original_gene_id")


def resolve_genes(genes: DataFrame, mapping: DataFrame, versions: bool = True) -> DataFrame:
    """Every canonical id of each ``original_gene_id`` with its symbol, source and status; the id itself where none is known."""
    ids = genes.select("original_gene_id").distinct().where(col("original_gene_id") != "")
    bare = strip_version("original_gene_id") if versions else F.col("original_gene_id")
    keyed = ids.select("original_gene_id", F.explode(F.array_distinct(F.array("original_gene_id", bare))).alias("_key"))
    known = mapping.select(
        F.trim("original_gene_id").alias("_key"),
        F.trim("canonical_gene_id").alias("canonical_gene_id"),
        or_na("gene_symbol").alias("gene_symbol"),
        *[
            (F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(d)).otherwise(F.col(c)) if c in mapping.columns else F.lit(d)).alias(c)
            for c, d in (("mapping_source", "mapping_file"), ("mapping_status", "mapped"), ("duplicate_resolution_method", "explicit_mapping"))
        ],
    ).where((F.col("_key") != "") & (F.col("canonical_gene_id") != ""))
    found = keyed.join(known, "_key").groupBy("original_gene_id", "canonical_gene_id", "gene_symbol", "mapping_source").agg(
        F.max("mapping_status").alias("mapping_status"), F.max("duplicate_resolution_method").alias("duplicate_resolution_method")
    )
    tally = found.groupBy("original_gene_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_distinct("canonical_gene_id").alias("_canonical")
    )
    several = F.col("_canonical") > 1
    usable = found.join(tally, "original_gene_id").where(several | (F.col("_rows") == 1)).select(
        "original_gene_id", "canonical_gene_id", "gene_symbol", "mapping_source",
        F.when(several, F.lit("ambiguous_one_to_many")).otherwise(F.col("mapping_status")).alias("mapping_status"),
        F.when(several, F.lit("unresolved_one_to_many")).otherwise(F.col("duplicate_resolution_method")).alias("duplicate_resolution_method"),
    )
    identity = {
        "canonical_gene_id": strip_version("original_gene_id") if versions else F.col("original_gene_id"),
        "gene_symbol": F.lit("NA"), "mapping_source": F.lit("identity"), "mapping_status": F.lit("identity"),
        "duplicate_resolution_method": F.lit("identity"),
    }
    return ids.join(usable, "original_gene_id", "left").withColumns({c: F.coalesce(F.col(c), d) for c, d in identity.items()})


def fill_cell_types(df: DataFrame, known: DataFrame, key: str = "canonical_gene_id") -> DataFrame:
    """Known cell types a gene was not seen in, one row each, marked as missing.

    ``known`` is the reviewed ontology's distinct types: a small fixed list, so it
    is turned into one array and exploded beside each gene.
    """
    types = known.agg(F.array_sort(F.collect_set("cell_type")).alias("_types"))
    seen = df.groupBy(key).agg(F.collect_set("cell_type").alias("_seen"))
    absent = seen.crossJoin(F.broadcast(types)).select(key, F.explode(F.array_except("_types", "_seen")).alias("cell_type"))  # one row
    return df.withColumn("missing_cell_type", F.lit(False)).unionByName(
        absent.withColumn("missing_cell_type", F.lit(True)), allowMissingColumns=True
    )


def verify_files(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Declared downloads against files found: existence, checksum, read integrity."""
    found = observed.select("path", F.col("sha256").alias("_sha"), F.col("integrity").alias("_ok"))
    joined = declared.join(found, "path", "left")
    status = (
        F.when(F.col("_sha").isNull(), F.lit("missing_file"))
        .when(present("sha256") & (F.col("sha256") != F.col("_sha")), F.lit("checksum_mismatch"))
        .when(F.col("_ok") == "fail", F.lit("fastq_integrity_failed"))
        .otherwise(F.lit("verified"))
    )
    return joined.select(*declared.columns, F.col("_sha").alias("observed_sha256"), status.alias("verification_status"))


def select_by_glob(files: DataFrame, patterns: Sequence[str], max_bytes: int) -> DataFrame:
    """Selection status only; nothing is transferred."""
    allowed = match_globs(F.concat_ws(" ", or_na("file_name"), or_na("url")), patterns)
    status = (
        F.when(~allowed, F.lit("skipped_not_allowlisted"))
        .when(F.col("size_bytes") > max_bytes, F.lit("skipped_size_limit"))
        .otherwise(F.lit("selected"))
    )
    return files.withColumn("selection_status", status)


def with_default(df: DataFrame, name: str, value: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(value))
