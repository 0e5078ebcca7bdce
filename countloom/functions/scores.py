"""Small numeric scores used by quality control and evidence integration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from countloom.functions.missing import col, finite

# Flags that cap confidence, whatever the score.
LIMITING_FLAGS = (
    "ambiguous_one_to_many",
    "bulk_pseudobulk_opposite_direction",
    "single_gse_support",
    "validation_failed",
)


def p_score(p: str | Column) -> Column:
    """-log10(p)/10 held in [0, 1]; missing p scores 0."""
    value = finite(p)
    raw = -F.log10(F.greatest(value, F.lit(1e-300))) / 10.0
    # greatest and least skip nulls, so a missing p must be caught first.
    return F.when(value.isNull(), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))


def sign(value: str | Column) -> Column:
    return F.coalesce(F.signum(finite(value)), F.lit(0.0)).cast("int")


def direction(first: str | Column, second: str | Column) -> Column:
    a, b = sign(first), sign(second)
    return (
        F.when((a == 0) | (b == 0), F.lit("not_comparable"))
        .when(a == b, F.lit("same"))
        .otherwise(F.lit("opposite"))
    )


def evidence_level(total: str | Column) -> Column:
    value = col(total)
    return (
        F.when(value >= 0.75, F.lit("high"))
        .when(value >= 0.5, F.lit("moderate"))
        .when(value >= 0.25, F.lit("low"))
        .otherwise(F.lit("limited"))
    )


def confidence(level: str | Column, limitations: Column) -> Column:
    flags = F.array(*[F.lit(f) for f in LIMITING_FLAGS])
    return F.when(F.arrays_overlap(limitations, flags), F.lit("limited")).otherwise(col(level))


def percent(part: str | Column, whole: str | Column) -> Column:
    return F.when(col(whole) > 0, 100.0 * col(part) / col(whole)).otherwise(F.lit(0.0))


def complexity(genes: str | Column, counts: str | Column) -> Column:
    """log10(genes+1) / log10(counts+1); 0 for an empty cell."""
    return F.when(
        col(counts) > 0, F.log10(col(genes) + 1) / F.log10(col(counts) + 1)
    ).otherwise(F.lit(0.0))


def significant_digits(value: Column, digits: int = 8) -> Column:
    """Number text with so many significant digits and no trailing zeros."""
    text = F.format_string(f"%.{digits}g", value)
    bare = F.regexp_replace(text, r"(\.[0-9]*?)0+(e|$)", "$1$2")
    return F.regexp_replace(bare, r"\.(e|$)", "$1")


def interval_text(low: Column, high: Column) -> Column:
    return F.concat_ws(";", significant_digits(low), significant_digits(high))
