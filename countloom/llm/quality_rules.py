"""Quality rules: base limits, then distance of a text's histograms from its language.

Each text gets a histogram of character classes and one of common words.  The
reference of a language is the mean histogram over all its documents.  A text is
turned away when the Jensen-Shannon distance to the reference of its language is
above a limit; texts too short for a histogram to mean anything skip that test.
Everything is built from columns: one pass for the references (at most one row
per known language and one for all), one map-only pass for the verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm.textstats import (
    CLASS_NAMES,
    COMMON,
    blanked,
    class_counts,
    found_words,
    line_counts,
    repeat_words,
    settled,
    words_of,
)

#: Shares are summed as whole millionths, so the sums do not depend on the order of the rows.
UNIT = 1_000_000
ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept",
)
MIN_CHARS, MIN_WORDS = 200, 120
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.26, 0.21


def _histograms(df: DataFrame, lang: str) -> DataFrame:
    """Adds ``_lang`` (a known language or ``*``) and both histograms as arrays of counts.

    Only the words of the text's own language are looked for, so an unknown
    language has no word histogram.
    """
    df = class_counts(df)
    known = F.lower(F.trim(F.col(lang)))
    df = df.withColumn("_lang", F.when(known.isin(*COMMON), known).otherwise(F.lit("*")))
    hits = F.array().cast("array<string>")
    for code, words in COMMON.items():
        hits = F.when(F.col("_lang") == code, found_words(words)).otherwise(hits)
    df = df.withColumns(
        {
            "_chars": F.array(*[F.col(f"_c_{c}").cast("bigint") for c in CLASS_NAMES]),
            "_hits": hits,
            "_n": F.size("_words"),
        }
    )
    common = F.lit(None).cast("array<bigint>")
    for code, words in COMMON.items():
        counts = [(F.size("_hits") - F.size(F.array_remove("_hits", w))).cast("bigint") for w in words]
        other = (F.col("_n") - F.size("_hits")).cast("bigint")
        common = F.when(F.col("_lang") == code, F.array(*counts, other)).otherwise(common)
    df = df.withColumn("_common", common)
    return df.drop("_hits", *[f"_c_{c}" for c in CLASS_NAMES if c != "blank"])


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, dict[str, list[float]]]:
    """Mean histograms over all documents of each known language, and ``*`` over all.

    Brings at most five rows to the driver, whatever the input: the languages are
    those of the fixed word lists.  An empty table gives no reference.
    """
    df = blanked(docs.select(F.col(text).alias("_text"), F.col(lang).alias("_language")), "_text")
    df = _histograms(words_of(df), "_language")
    width = {code: len(words) + 1 for code, words in COMMON.items()}
    shares = [F.floor(F.try_divide(F.when(F.col("_n") > 0, F.col("_chars")[i]) * UNIT, F.col("_len"))) for i in range(len(CLASS_NAMES))]
    shares += [F.floor(F.try_divide(F.get("_common", F.lit(i)) * UNIT, F.col("_n"))) for i in range(max(width.values()))]
    sums = df.groupBy("_lang").agg(*[F.sum(s).alias(f"s{i}") for i, s in enumerate(shares)]).collect()
    totals = {row["_lang"]: [row[f"s{i}"] or 0 for i in range(len(shares))] for row in sums}
    if totals:
        totals["*"] = [sum(column) for column in zip(*totals.values())]
    cut = len(CLASS_NAMES)

    def shares_of(values: list[int]) -> list[float]:
        return [v / sum(values) for v in values] if sum(values) else []

    return {
        code: {"chars": shares_of(v[:cut]), "common": shares_of(v[cut : cut + width[code]]) if code in width else []}
        for code, v in totals.items()
    }


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a count array from shares; null where either is missing."""
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def term(p: Column, q: Column) -> Column:
        mid = (p + q) / 2.0
        mine = F.when(p > 0, p * F.log2(p / mid)).otherwise(F.lit(0.0))
        return mine + F.when(q > 0, q * F.log2(q / mid)).otherwise(F.lit(0.0))

    terms = F.zip_with(F.transform(counts, lambda c: c / total), reference, term)
    summed = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), summed / 2.0)))


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_words: int = 50,
    min_chars_for_distance: int = MIN_CHARS,
    min_words_for_distance: int = MIN_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` with their counts and verdict; one row out per row in.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, class_distance, word_distance (double, null where the text is too
    short) and kept.  Null and blank texts count as no words and fail.  A null or
    unknown language is held against the histogram of all languages.  Repeated
    rows each get a row.  Columns of ``docs`` with one of the added names are
    replaced; names starting with ``_`` are reserved.
    """
    known = references(docs, text, lang)
    df = blanked(docs.withColumns({"_text": F.col(text), "_language": F.col(lang)}), "_text")
    df = words_of(df)
    df = line_counts(repeat_words(_histograms(df, "_language")), "_text")
    missing = F.lit(None).cast("array<double>")
    classes, words = missing, missing
    for code, kinds in known.items():
        here = F.col("_lang") == code
        if kinds["chars"]:
            classes = F.when(here, F.array(*[F.lit(v) for v in kinds["chars"]])).otherwise(classes)
        if kinds["common"]:
            words = F.when(here, F.array(*[F.lit(v) for v in kinds["common"]])).otherwise(words)
    df = df.withColumns({"_class_ref": classes, "_word_ref": words})
    n = F.col("_n").cast("bigint")
    df = df.withColumns(
        {
            "n_words": n,
            "word_chars": (F.col("_len") - F.col("_c_blank")).cast("bigint"),
            "n_symbols": F.col("_symbols").cast("bigint"),
            "n_dup_lines": F.col("_dup_lines").cast("bigint"),
            "n_repeat_words": F.col("_repeat"),
            "class_distance": F.when(F.col("_len") >= min_chars_for_distance, distance(F.col("_chars"), F.col("_class_ref"))),
            "word_distance": F.when(n >= min_words_for_distance, distance(F.col("_common"), F.col("_word_ref"))),
        }
    )
    df = df.withColumns(
        {
            "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance
    )
    df = df.withColumn("kept", ~F.col("base_failed") & fits)
    df = df.drop(*[c for c in df.columns if c.startswith("_")])
    return settled(df, ADDED)
