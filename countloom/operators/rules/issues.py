"""The issue row, and what is done with many of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.functions.missing import is_true, or_na
from countloom.session import reuse

# Columns of an issue row and the order of severities.
ISSUE_FIELDS = (
    "severity", "scope", "check_id", "analysis_id", "dataset_id", "sample_id", "subject_id",
    "contrast_id", "status", "message", "suggested_action", "details",
)
IDS = ("analysis_id", "dataset_id", "sample_id", "subject_id", "contrast_id")
SEVERITIES = ("critical", "error", "warning", "info")
LIST_CHUNK = 1000


def _lit(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def issue(
    df: DataFrame, severity: str | Column, scope: str, check_id: str | Column, message: str | Column, action: str,
    details: Column | None = None, status: str = "fail", **ids: str | Column,
) -> DataFrame:
    """One issue per row of ``df``; ids are column names or Columns, NA when not given."""
    def identity(name: str) -> Column:
        value = ids.get(name)
        return F.lit("NA") if value is None else or_na(value)

    return df.select(
        _lit(severity).alias("severity"), F.lit(scope).alias("scope"), _lit(check_id).alias("check_id"),
        *[identity(n).alias(n) for n in IDS],
        F.lit(status).alias("status"), _lit(message).alias("message"), F.lit(action).alias("suggested_action"),
        (F.lit("{}") if details is None else F.to_json(details)).alias("details"),
    )


def passed(df: DataFrame, scope: str, check_id: str, message: str | Column, **ids: str | Column) -> DataFrame:
    return issue(df, "info", scope, check_id, message, "No action required.", status="pass", **ids)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def when_empty(df: DataFrame) -> DataFrame:
    """One row when the table has none, no row otherwise."""
    return df.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0)


def deduplicate(issues: DataFrame) -> DataFrame:
    return issues.dropDuplicates(list(ISSUE_FIELDS))


def severity_rank(severity: str = "severity") -> Column:
    rank = F.lit(99)
    for place, name in enumerate(SEVERITIES):
        rank = F.when(F.col(severity) == name, F.lit(place)).otherwise(rank)
    return rank


def sort_issues(issues: DataFrame) -> DataFrame:
    return issues.orderBy(severity_rank(), "analysis_id", "dataset_id", "sample_id", "check_id")


def severity_counts(issues: DataFrame) -> DataFrame:
    """Issues per severity, zeros shown."""
    one = issues.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    return one.unpivot([], list(SEVERITIES), "severity", "issue_count")


def blocking(issues: DataFrame) -> DataFrame:
    return issues.where((F.col("status") == "fail") & F.col("severity").isin("critical", "error"))


def listed(pairs: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Distinct items per key as sorted arrays of about a thousand at most.

    A small group gives one row; a huge one gives several, so no single cell or
    task ever holds an unbounded list and nothing is left out.
    """
    keys = list(keys)
    distinct = pairs.select(*keys, item).distinct()
    sizes = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"))
    chunk = F.pmod(F.xxhash64(item), F.ceil(F.col("n_items") / LIST_CHUNK))
    placed = distinct.join(sizes, keys).withColumn("_chunk", chunk)
    return placed.groupBy(*keys, "n_items", "_chunk").agg(F.array_sort(F.collect_list(item)).alias("items")).drop("_chunk")


def gate(issues: DataFrame, plan: DataFrame) -> DataFrame:
    """Per analysis of the plan: blocked by a critical issue, or by an error that reaches it.

    An error reaches its own analysis, else every included analysis of its
    datasets (``;`` list), else all.
    """
    analyses = plan.select("analysis_id").distinct()
    failed = reuse(issues.where(F.col("status") == "fail").select("severity", "check_id", "analysis_id", "dataset_id"))
    critical = failed.agg(F.count_if(F.col("severity") == "critical").alias("critical_issues"))
    errors = failed.where(F.col("severity") == "error")
    own = errors.where(F.col("analysis_id") != "NA").select("analysis_id", "check_id")
    spread = errors.where((F.col("analysis_id") == "NA") & (F.col("dataset_id") != "NA")).select(
        F.explode(F.split("dataset_id", ";")).alias("dataset_id"), "check_id"
    ).distinct()
    through = spread.join(plan.where(is_true("include")).select("analysis_id", "dataset_id"), "dataset_id").select("analysis_id", "check_id")
    wide = errors.where((F.col("analysis_id") == "NA") & (F.col("dataset_id") == "NA")).agg(F.count(F.lit(1)).alias("unscoped_errors"))
    hits = own.unionByName(through).groupBy("analysis_id").agg(
        F.count(F.lit(1)).alias("error_issues"), F.array_sort(F.collect_set("check_id")).alias("error_checks")
    )
    joined = analyses.join(hits, "analysis_id", "left").crossJoin(F.broadcast(critical)).crossJoin(F.broadcast(wide))  # single rows
    reached = F.coalesce(F.col("error_issues"), F.lit(0)) > 0
    return joined.select(
        "analysis_id",
        "critical_issues",
        F.coalesce("error_issues", F.lit(0)).alias("error_issues"),
        F.concat_ws(";", "error_checks").alias("error_checks"),
        ((F.col("critical_issues") > 0) | reached | (F.col("unscoped_errors") > 0)).alias("blocked"),
    )


def require_open(issues: DataFrame, plan: DataFrame, analysis_id: str) -> None:
    """Stop the run when the gate is closed for this analysis."""
    row = gate(issues, plan).where(F.col("analysis_id") == analysis_id).first()
    if row is not None and row["blocked"]:
        raise RuntimeError(f"analysis {analysis_id} is blocked: {row['critical_issues']} critical issues, errors {row['error_checks']}")


def number_rows(df: DataFrame, order: Sequence[str], by: Sequence[str]) -> DataFrame:
    return df.withColumn("line", F.row_number().over(W.partitionBy(*by).orderBy(*order)) + 1)
