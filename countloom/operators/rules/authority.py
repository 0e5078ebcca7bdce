"""Schema and cross-table rules on the four reviewed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.operators.ranking import duplicates
from countloom.operators.rules.issues import union
from countloom.schemas import TABLES

FIELDS = ("check_id", "table", "line", "field", "value", "message")


def _row(df: DataFrame, check: str, table: str, line, field, value, message: str) -> DataFrame:
    lit = lambda v: v if not isinstance(v, (str, int)) else F.lit(v)
    return df.select(F.lit(check).alias("check_id"), F.lit(table).alias("table"), lit(line).cast("bigint").alias("line"), lit(field).alias("field"),
                     F.coalesce(lit(value).cast("string"), F.lit("")).alias("value"), F.lit(message).alias("message"))


def header_rules(lines: DataFrame, table: str) -> DataFrame:
    """On raw text lines (line, text): empty file, header, blank rows, row width."""
    width, names = len(TABLES[table].columns), "\t".join(TABLES[table].columns)
    cells = F.split("text", "\t", -1)
    blank = F.regexp_replace("text", "\t", "") == ""
    head = lines.where(F.col("line") == 1).withColumn("_fits", F.regexp_replace("text", "^\\uFEFF", "") == names)
    # Rows below a wrong header are not judged: their columns mean something else.
    fits = head.agg(F.bool_and("_fits").alias("_ok")).where("_ok")
    body = lines.where(F.col("line") > 1).crossJoin(F.broadcast(fits))  # one row or none
    none = lines.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return union([
        _row(none, "EMPTY_FILE", table, 1, "<header>", "", "the table has no header"),
        _row(head.where(~F.col("_fits")), "HEADER_MISMATCH", table, 1, "<header>", F.col("text"), "the header is not the expected one"),
        _row(body.where(blank), "BLANK_ROW", table, F.col("line"), "<row>", "", "blank rows are not allowed"),
        _row(body.where(~blank & (F.size(cells) != width)), "COLUMN_COUNT_MISMATCH", table, F.col("line"), "<row>", F.size(cells), "the row has another number of columns"),
    ])


def value_rules(df: DataFrame, table: str, line: str = "line") -> DataFrame:
    """Whitespace, booleans, integers, allowed words and conditional rules, per cell."""
    spec = TABLES[table]
    long = df.select(F.col(line).alias("line"), F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in spec.columns])).alias("_c")).select("line", "_c.field", "_c.value")
    parts = [
        _row(long.where(F.col("value") != F.trim("value")), "SURROUNDING_WHITESPACE", table, F.col("line"), F.col("field"), F.col("value"), "blanks around the value"),
        _row(long.where(F.col("field").isin(*spec.booleans) & ~F.col("value").isin("true", "false")), "INVALID_BOOLEAN", table, F.col("line"), F.col("field"), F.col("value"), "only true or false"),
        _row(long.where(F.col("field").isin(*spec.integers) & ~F.col("value").rlike("^[0-9]+$")), "INVALID_INTEGER", table, F.col("line"), F.col("field"), F.col("value"), "only a whole number"),
    ]
    broken = [_row(long.where((F.col("field") == c) & ~F.col("value").isin(*words)), "SCHEMA_VIOLATION", table, F.col("line"), F.col("field"), F.col("value"), "not an allowed word") for c, words in spec.words.items()]
    broken += [_row(long.where((F.col("field") == c) & F.col("value").isin("", "NA")), "SCHEMA_VIOLATION", table, F.col("line"), F.col("field"), F.col("value"), "a value is required") for c in spec.required]
    broken += [_row(long.where((F.col("field") == c) & (F.col("value") == "")), "SCHEMA_VIOLATION", table, F.col("line"), F.col("field"), F.col("value"), "a value is required") for c in spec.filled]
    broken += [_row(df.where(rule), "SCHEMA_VIOLATION", table, F.col(line), name, "", "the row breaks a conditional rule") for name, rule in spec.row_rules.items()]
    return union([*parts, *broken])


def cross_rules(tables: Mapping[str, DataFrame], line: str = "line") -> DataFrame:
    """Duplicate keys and ids that no other table knows."""
    samples, contrasts, plan, ontology = (tables[t] for t in ("sample_manifest", "contrasts", "dataset_plan", "celltype_ontology"))
    parts = []
    for table, df, keys, check in (
        ("sample_manifest", samples, ["sample_id"], "DUPLICATE_SAMPLE_ID"), ("contrasts", contrasts, ["contrast_id"], "DUPLICATE_CONTRAST_ID"),
        ("dataset_plan", plan, ["analysis_id", "dataset_id"], "DUPLICATE_DATASET_PLAN"), ("celltype_ontology", ontology, ["dataset_id", "author_label"], "DUPLICATE_AUTHOR_LABEL"),
    ):
        parts.append(_row(duplicates(df, keys, line), check, table, F.col(line), ",".join(keys), F.concat_ws("|", *keys), "the key was used before"))
    planned = plan.select("dataset_id").distinct()
    any_plan = plan.agg(F.count(F.lit(1)).alias("_p")).where(F.col("_p") > 0)
    known = planned.union(samples.select("dataset_id")).distinct()
    lost = samples.join(planned, "dataset_id", "left_anti").crossJoin(F.broadcast(any_plan))  # one row
    parts += [
        _row(contrasts.where(F.col("numerator") == F.col("denominator")), "IDENTICAL_CONTRAST_GROUPS", "contrasts", F.col(line), "numerator,denominator", F.col("numerator"), "the two groups are one"),
        _row(contrasts.join(plan.select("analysis_id").distinct(), "analysis_id", "left_anti"), "UNKNOWN_ANALYSIS_ID", "contrasts", F.col(line), "analysis_id", F.col("analysis_id"), "the plan has no such analysis"),
        _row(lost, "UNKNOWN_DATASET_ID", "sample_manifest", F.col(line), "dataset_id", F.col("dataset_id"), "the plan has no such dataset"),
        _row(ontology.join(known, "dataset_id", "left_anti"), "UNKNOWN_ONTOLOGY_DATASET", "celltype_ontology", F.col(line), "dataset_id", F.col("dataset_id"), "no other table has the dataset"),
    ]
    return union(parts)


def file_rules(before: DataFrame, after: DataFrame, expected: DataFrame) -> DataFrame:
    """Files that are missing, or that changed while they were being checked."""
    gone = expected.join(before.select("table").distinct(), "table", "left_anti")
    changed = before.select("table", F.col("sha256").alias("_was")).join(after.select("table", "sha256"), "table").where(F.col("_was") != F.col("sha256"))
    return union([
        gone.select(F.lit("MISSING_AUTHORITY_FILE").alias("check_id"), "table", F.lit(0).cast("bigint").alias("line"), F.lit("<file>").alias("field"), F.lit("").alias("value"), F.lit("the reviewed file does not exist").alias("message")),
        changed.select(F.lit("AUTHORITY_FILE_MUTATED").alias("check_id"), "table", F.lit(0).cast("bigint").alias("line"), F.lit("<file>").alias("field"), F.col("sha256").alias("value"), F.lit("the file changed during validation").alias("message")),
    ])
