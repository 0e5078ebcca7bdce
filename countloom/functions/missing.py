"""Missing values, strict booleans and numbers read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five spellings of "no value" in reviewed tables.
MISSING_VALUES = ("", "NA", "N/A", "null", "None")


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_missing(value: str | Column, strip: bool = False) -> Column:
    """True for null and the five sentinels; ``strip`` trims the text first."""
    text = col(value)
    text = F.trim(text) if strip else text
    return text.isNull() | text.isin(*MISSING_VALUES)


def present(value: str | Column) -> Column:
    return ~is_missing(value)


def null_if_missing(value: str | Column) -> Column:
    return F.when(present(value), col(value))


def or_na(value: str | Column) -> Column:
    """Text with null and empty shown as ``NA``."""
    text = col(value).cast("string")
    return F.when(text.isNull() | (text == ""), F.lit("NA")).otherwise(text)


def as_bool(value: str | Column) -> Column:
    """Lower-case ``true``/``false`` only; every other spelling is unknown (null)."""
    text = col(value).cast("string")
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def is_true(value: str | Column) -> Column:
    return F.coalesce(as_bool(value), F.lit(False))


def bool_text(value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit(False)), F.lit("true")).otherwise(F.lit("false"))


def finite(value: str | Column) -> Column:
    """NaN and infinities become null, so they never sort first or compare equal."""
    number = col(value).cast("double")
    return F.when(
        ~F.isnan(number) & (number < F.lit(float("inf"))) & (number > F.lit(float("-inf"))),
        number,
    )


def to_number(value: str | Column) -> Column:
    """Number read from text; null when the text is not a finite number."""
    text = F.trim(col(value).cast("string"))
    return finite(text.try_cast("double"))


def is_integral(value: str | Column) -> Column:
    """Integer within the usual float tolerance (absolute 1e-8, relative 1e-5)."""
    number = col(value).cast("double")
    nearest = F.rint(number)
    return F.abs(number - nearest) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(nearest)
