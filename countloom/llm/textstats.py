"""Counts over whole texts as plain column expressions, shared by the quality operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent words per language, the axes of the word histogram.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "on", "with"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "que"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del"),
}

#: Character classes beside lower-case letters and blanks, in the order they are counted.
CLASSES = {
    "upper": r"\p{Lu}+",
    "stop": r"[.,;:'\"()?\-]+",
    "shout": r"!+",
    "symbol": r"[#*$%&|<>]+",
    "digit": r"\p{Nd}+",
}
CLASS_NAMES = ("lower", "blank", *CLASSES, "other")


def blanked(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_blanked``: the text (null: empty) with every blank character made a space."""
    out = F.coalesce(F.col(text), F.lit(""))
    for c in BLANKS[1:]:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return df.withColumn("_blanked", out)


def class_counts(df: DataFrame) -> DataFrame:
    """Adds ``_len`` and ``_c_<class>``; needs ``_blanked``.

    Runs of lower-case letters and blanks go first, in one pass with few matches;
    the other classes only see the little that is left.
    """
    df = df.withColumn("_left", F.regexp_replace("_blanked", r"[\p{Ll} ]+", ""))
    df = df.withColumns(
        {
            "_len": F.length("_blanked"),
            "_c_blank": F.length("_blanked") - F.length(F.replace("_blanked", F.lit(" "), F.lit(""))),
            "_symbols": F.length("_left") - F.length(F.translate("_left", SYMBOLS, "")),
        }
    )
    df = df.withColumn("_c_lower", F.col("_len") - F.length("_left") - F.col("_c_blank"))
    for name, pattern in CLASSES.items():
        df = df.withColumn("_rest", F.regexp_replace("_left", pattern, ""))
        df = df.withColumn(f"_c_{name}", F.length("_left") - F.length("_rest"))
        df = df.withColumn("_left", F.col("_rest"))
    return df.withColumn("_c_other", F.length("_left")).drop("_left", "_rest")


def words_of(df: DataFrame) -> DataFrame:
    """Adds ``_words``: the runs of other than blanks, none for a blank text; needs ``_blanked``."""
    return df.withColumn("_words", F.array_remove(F.split("_blanked", " "), ""))


def found_words(words: Sequence[str]) -> Column:
    """The occurrences of ``words`` in ``_blanked``, each as written here and between blanks."""
    return F.regexp_extract_all("_blanked", F.lit(f"(?<![^ ])({'|'.join(words)})(?![^ ])"), F.lit(1))


def line_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_lines`` and ``_dup_lines``: lines with a word, and those equal to an earlier one."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = df.withColumn("_with_word", lines)
    return df.withColumns(
        {"_lines": F.size("_with_word"), "_dup_lines": F.size("_with_word") - F.size(F.array_distinct("_with_word"))}
    ).drop("_with_word")


def repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``_repeat``: words inside 3-word windows that the text holds twice or more; needs ``_words``.

    A window is compared by the 64-bit hash of its words.  Texts whose hashes all
    differ are done.  For the others hash and position share one long, so one
    primitive sort puts equal windows side by side; the position takes the low
    bits that the text's own length needs.
    """
    n = F.size("_words")
    none = F.array().cast("array<bigint>")
    hashes = F.expr("transform(_words, (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2)))")
    df = df.withColumn("_all", F.when(n >= 3, hashes).otherwise(none))
    df = df.withColumn("_hash", F.slice("_all", F.lit(1), F.greatest(n - 2, F.lit(0)))).drop("_all")
    df = df.withColumn("_some", F.size(F.array_distinct("_hash")) < F.size("_hash"))
    df = df.withColumn("_bits", F.ceil(F.log2(n + 1)).cast("int"))
    packed = F.expr("transform(_hash, (h, i) -> shiftleft(h, _bits) | i)")
    df = df.withColumn("_sorted", F.when(F.col("_some"), F.sort_array(packed)).otherwise(none)).drop("_hash")
    df = df.withColumn(
        "_twice",
        F.expr(
            "filter(_sorted, (x, k) -> "
            "coalesce(shiftright(x, _bits) = shiftright(get(_sorted, k + 1), _bits), false) or "
            "coalesce(shiftright(x, _bits) = shiftright(get(_sorted, k - 1), _bits), false))"
        ),
    ).drop("_sorted")
    df = df.withColumn(
        "_at", F.sort_array(F.expr("transform(_twice, x -> x & (shiftleft(1L, _bits) - 1))"))
    ).drop("_twice")
    spread = F.expr(
        "aggregate(transform(_at, (p, k) -> least(3L, coalesce(get(_at, k + 1) - p, 3L))), 0L, (s, x) -> s + x)"
    )
    return df.withColumn("_repeat", spread).drop("_at", "_bits", "_some")


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def settled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; later filters on ``columns`` use the values instead of working them out once more.

    A filter is otherwise moved below the projections and takes a copy of each
    expression along, loops over words included.  One-element arrays hold it off.
    """
    rest = [c for c in df.columns if c not in columns]
    held = F.explode(F.array(F.struct(*[F.col(c) for c in columns]))).alias("_held")
    return df.select(*rest, held).select(*rest, *[F.col(f"_held.{c}").alias(c) for c in columns])
