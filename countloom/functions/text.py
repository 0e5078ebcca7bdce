"""Predicates and scalars on text columns."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from countloom.functions.missing import col, is_missing

# Type words that mark single-cell data, and the barcode shape.
SINGLE_CELL_WORDS = ("scrna", "snrna", "single_cell", "single-cell")
BARCODE_PATTERN = r"^[ACGTN]{12,}(?:-[0-9]+)?$"


def is_bulk(data_type: str | Column) -> Column:
    text = F.lower(F.coalesce(col(data_type), F.lit("")))
    return text.contains("bulk") & ~text.contains("pseudobulk")


def is_single_cell(data_type: str | Column) -> Column:
    text = F.lower(F.coalesce(col(data_type), F.lit("")))
    return text.rlike("|".join(re.escape(word) for word in SINGLE_CELL_WORDS))


def strip_version(gene_id: str | Column) -> Column:
    """``ENSG1.12`` -> ``ENSG1``: drops one trailing ``.digits``."""
    return F.regexp_replace(col(gene_id), r"\.[0-9]+$", "")


def safe_name(value: str | Column) -> Column:
    return F.regexp_replace(col(value), r"[^A-Za-z0-9._-]", "_")


def starts_with_any(value: str | Column, prefixes: Sequence[str]) -> Column:
    if not prefixes:
        return F.lit(False)
    return col(value).rlike("^(?:" + "|".join(re.escape(p) for p in prefixes) + ")")


def gene_mask(symbol: str | Column, gene_id: str | Column, prefixes: Sequence[str]) -> Column:
    """Symbol or id starts with one of the prefixes."""
    return F.coalesce(starts_with_any(symbol, prefixes), F.lit(False)) | F.coalesce(
        starts_with_any(gene_id, prefixes), F.lit(False)
    )


def looks_like_barcode(value: str | Column) -> Column:
    return col(value).rlike(BARCODE_PATTERN)


def term_pattern(term: str) -> str:
    """The term as a whole word: no ``[a-z0-9]`` touches it on either side."""
    return r"(?<![a-z0-9])" + re.escape(term.lower()) + r"(?![a-z0-9])"


def has_term(text: str | Column, term: str) -> Column:
    return F.lower(F.coalesce(col(text), F.lit(""))).rlike(term_pattern(term))


def match_terms(text: str | Column, terms: Sequence[str]) -> Column:
    """Sorted array of the distinct terms found in the text."""
    lowered = F.lower(F.coalesce(col(text), F.lit("")))
    found = [F.when(lowered.rlike(term_pattern(t)), F.lit(t)) for t in sorted(set(terms))]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def match_globs(text: str | Column, patterns: Sequence[str]) -> Column:
    """Shell-style patterns; they become one regular expression on the driver."""
    if not patterns:
        return F.lit(False)
    joined = "|".join(fnmatch.translate(p.lower()).replace(r"\Z", "$").replace(r"\z", "$") for p in patterns)
    return F.lower(F.coalesce(col(text), F.lit(""))).rlike("^(?:" + joined + ")")


def split_ids(value: str | Column) -> Column:
    """Ids split on ``;`` and ``,``, trimmed, missing ones left out."""
    parts = F.transform(F.split(F.coalesce(col(value), F.lit("")), "[;,]"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: ~is_missing(x))


def key_value(text: str | Column) -> tuple[Column, Column]:
    """Split on the first colon; text without one has no key."""
    whole = col(text)
    has_colon = F.contains(whole, F.lit(":"))
    key = F.when(has_colon, F.lower(F.trim(F.substring_index(whole, ":", 1)))).otherwise(F.lit(""))
    rest = F.when(has_colon, F.trim(F.regexp_replace(whole, r"^[^:]*:", ""))).otherwise(F.trim(whole))
    return key, rest


def distinct_matches(text: Column, pattern: str) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))))


def url_file_name(url: str | Column) -> Column:
    """Last path segment, percent-decoded; query and fragment dropped."""
    path = F.regexp_replace(F.regexp_replace(col(url), r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.try_url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def url_scheme(url: str | Column) -> Column:
    return F.lower(F.regexp_extract(col(url), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def joined_or(values: Column, empty: str) -> Column:
    """Array joined by ``;``, or a fixed word when it is empty."""
    return F.when(F.size(values) > 0, F.concat_ws(";", values)).otherwise(F.lit(empty))


def kept(*pairs: tuple[Column, str]) -> Column:
    """Array of the labels whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for cond, label in pairs]))
