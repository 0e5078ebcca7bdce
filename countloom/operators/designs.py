"""Design matrices of model formulas: term expansion, coding, rank and estimability of many designs at once.

A formula is a sum of terms; a term is a product of factors.  ``a * b`` stands for
``a + b + a:b``, ``C(x)`` makes a number a factor, ``- 1`` or ``0`` drops the
intercept.  A term spans all subsets of its factors, so only the subsets that no
earlier term spans get columns, each coded against the first level; that is the
smallest set of columns with the span of the formula.

Every design of every family is coded into one long sparse table of rows and
columns.  What leaves Spark's aggregates is one columns x columns product per
family, which one task reduces by pivoted elimination.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from countloom.functions.missing import is_missing, to_number
from countloom.operators.pairwise import gram

#: Fixed value: the covariate that is a number when all its values are.
NUMERIC = ("age",)
TOKEN = re.compile(r"\s*(C\(\s*[A-Za-z_]\w*\s*\)|[A-Za-z_]\w*|[01]|[-+:*()~])")
TOLERANCE = 1e-9

Terms = list[tuple[str, ...]]


def expand(formula: str | None) -> Terms | None:
    """Terms in order of their first mention, the empty one for the intercept; None where the formula makes no sense."""
    text, at, tokens = (formula or "").strip(), 0, []
    while at < len(text):
        found = TOKEN.match(text, at)
        if not found:
            return None
        tokens.append(re.sub(r"\s+", "", found.group(1)))
        at = found.end()
    if tokens.count("~") > 1 or ("~" in tokens and tokens[0] != "~"):
        return None
    tokens = tokens[1:] if tokens[:1] == ["~"] else tokens
    place = 0

    def take(*wanted: str) -> str | None:
        nonlocal place
        if place < len(tokens) and tokens[place] in wanted:
            place += 1
            return tokens[place - 1]
        return None

    def atom() -> Terms:
        nonlocal place
        if take("("):
            inner = total()
            if not take(")"):
                raise ValueError
            return inner
        if place >= len(tokens) or tokens[place] in {"+", "-", ":", "*", ")", "~"}:
            raise ValueError
        place += 1
        word = tokens[place - 1]
        return [()] if word == "1" else [("0",)] if word == "0" else [(word,)]

    def joined(a: Terms, b: Terms) -> Terms:
        return [tuple(dict.fromkeys(x + y)) for x in a for y in b]

    def product() -> Terms:
        out = atom()
        while take(":"):
            out = joined(out, atom())
        return out

    def crossing() -> Terms:
        out = product()
        while take("*"):
            other = product()
            out = out + other + joined(out, other)
        return out

    def total() -> Terms:
        sign = take("+", "-") or "+"
        out: Terms = []
        while True:
            part = crossing()
            if sign == "-":
                gone = {frozenset(t) for t in part}
                out = [("0",)] + [t for t in out if frozenset(t) not in gone] if frozenset() in gone else [t for t in out if frozenset(t) not in gone]
            else:
                out += [t for t in part if t not in out]
            sign = take("+", "-")
            if not sign:
                return out

    try:
        terms = total() if tokens else []
    except ValueError:
        return None
    if place < len(tokens) or any("0" in t and len(t) > 1 for t in terms):
        return None
    terms = ([] if ("0",) in terms else [()]) + [t for t in terms if t not in ((), ("0",))]
    kept: dict[frozenset, tuple[str, ...]] = {}
    for t in terms:
        kept.setdefault(frozenset(t), t)
    # Lower orders come first, as a product may only add to what its factors span.
    return sorted(kept.values(), key=len)


def new_parts(terms: Sequence[Sequence[str]], numeric: Sequence[str]) -> Terms:
    """The subsets of factors that need columns: a term keeps its numbers and adds the subsets of its other factors not spanned before."""
    spanned: set[frozenset] = set()
    out: Terms = []
    for term in terms:
        numbers, factors = [f for f in term if f in numeric], [f for f in term if f not in numeric]
        for size in range(len(factors) + 1):
            for some in combinations(factors, size):
                part = frozenset([*numbers, *some])
                if part not in spanned:
                    spanned.add(part)
                    out.append(tuple([*some, *numbers]))
    return out


@pandas_udf(ArrayType(ArrayType(StringType())))
def formula_terms(formula: pd.Series) -> pd.Series:
    """Terms of each formula; null where it makes no sense."""
    made = [expand(f) for f in formula]
    return pd.Series([None if t is None else [list(x) for x in t] for t in made], dtype=object)


@pandas_udf(ArrayType(ArrayType(StringType())))
def _parts(terms: pd.Series, numeric: pd.Series) -> pd.Series:
    return pd.Series([[list(p) for p in new_parts([list(t) for t in ts], list(ns))] for ts, ns in zip(terms, numeric)], dtype=object)


def variable_of(factor: Column) -> Column:
    """The column a factor reads: what stands inside C(), else itself."""
    return F.regexp_replace(factor, r"^C\((.*)\)$", "$1")


def variables_of(terms: Column) -> Column:
    return F.array_distinct(F.transform(F.flatten(terms), variable_of))


def eliminate(matrix: np.ndarray) -> tuple[int, list[int]]:
    """Rank of a Gram matrix and the columns of its pivots: each turn takes the column with the largest rest."""
    scale = np.sqrt(np.clip(np.diag(matrix), 1e-300, None))
    rest, pivots = matrix / np.outer(scale, scale), []
    while len(pivots) < len(rest):
        at = int(np.argmax(np.diag(rest)))
        if rest[at, at] <= TOLERANCE:
            break
        rest = rest - np.outer(rest[:, at], rest[at, :]) / rest[at, at]
        rest[at, :] = rest[:, at] = 0.0
        pivots.append(at)
    return len(pivots), sorted(pivots)


def _ranks(keys: list[str], tested: str):
    def reduce(pairs: pd.DataFrame) -> pd.DataFrame:
        names = {n: i for i, n in enumerate(sorted(set(pairs["col_i"]) | set(pairs["col_j"])))}
        matrix = np.zeros((len(names), len(names)))
        i, j = pairs["col_i"].map(names).to_numpy(), pairs["col_j"].map(names).to_numpy()
        matrix[i, j] = matrix[j, i] = pairs["dot"].to_numpy()
        rank = eliminate(matrix)[0]
        # A factor's own columns are estimable when no other column can stand in for them.
        mine = [k for n, k in names.items() if n.startswith(f"{tested}=") and ":" not in n]
        others = [k for k in range(len(names)) if k not in mine]
        left = eliminate(matrix[np.ix_(others, others)])[0] if others else 0
        row = {k: [pairs[k].iloc[0]] for k in keys} | {"rank": [rank], "estimable": [bool(mine) and rank - left == len(mine)]}
        return pd.DataFrame(row)

    return reduce


def fit_designs(rows: DataFrame, keys: Sequence[str], row: str = "row", values: str = "values", terms: str = "terms", tested: str = "group") -> DataFrame:
    """keys, n_samples, n_rows, n_columns, rank, full_rank, estimable: one row per family of ``keys``.

    ``rows`` has a row id (unique in its family), a map of values as text and the
    family's terms.  Rows that lack a value of the design are left out of n_rows.
    A number (``age`` where every value parses, unless inside C()) is one column;
    other factors have their levels less one.  ``estimable`` says whether the
    columns of ``tested`` add as many dimensions as they are.  A family without a
    usable row has zeros and is not of full rank.  Nulls in ``keys`` are a value of their own.
    """
    keys = list(keys)
    spark_keys = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")).alias(k) for k in keys]
    base = rows.select(*spark_keys, F.col(row).cast("string").alias("_row"), F.col(values).alias("_values"), F.col(terms).alias("_terms"))
    needed = variables_of(F.col("_terms"))
    usable = F.forall(needed, lambda v: ~is_missing(F.try_element_at(F.col("_values"), v)))
    base = base.withColumn("_usable", usable)
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"), F.count_if("_usable").alias("n_rows"), F.first("_terms").alias("_terms"))
    good = base.where("_usable")
    factors = good.select(*keys, "_values", F.explode(F.array_distinct(F.flatten("_terms"))).alias("_factor"))
    value = F.try_element_at(F.col("_values"), variable_of(F.col("_factor")))
    levels = factors.groupBy(*keys, "_factor").agg(
        F.count_distinct(value).alias("_k"), F.min(value).alias("_base"), (F.count(to_number(value)) == F.count(F.lit(1))).alias("_number")
    )
    levels = levels.withColumn("_number", F.col("_number") & F.col("_factor").isin(*NUMERIC))
    about = levels.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_factor", "_base"))).alias("_bases"),
        F.map_from_entries(F.collect_list(F.struct("_factor", F.when(F.col("_number"), 1).otherwise(F.col("_k") - 1)))).alias("_widths"),
        F.collect_list(F.when(F.col("_number"), F.col("_factor"))).alias("_numbers"),
    )
    none = F.array().cast("array<string>")
    plans = sizes.join(about, keys, "left").withColumn("_parts", _parts("_terms", F.coalesce("_numbers", none)))
    width = lambda f: F.coalesce(F.try_element_at(F.col("_widths"), f), F.lit(0)).cast("bigint")
    product = lambda p: F.aggregate(p, F.lit(1).cast("bigint"), lambda n, f: n * width(f))
    plans = plans.withColumn("n_columns", F.aggregate(F.transform("_parts", product), F.lit(0).cast("bigint"), lambda a, b: a + b))
    # One row per design: the rows stay where they are instead of meeting by design in one task.
    coded = good.select(*keys, "_row", "_values").join(F.broadcast(plans.select(*keys, "_parts", "_bases", "_numbers")), keys)
    coded = coded.select(*keys, "_row", "_values", "_bases", "_numbers", F.explode("_parts").alias("_part"))
    held = lambda f: F.try_element_at(F.col("_values"), variable_of(f))
    is_number = lambda f: F.array_contains("_numbers", f)
    shown = F.forall("_part", lambda f: is_number(f) | (held(f) != F.try_element_at(F.col("_bases"), f)))
    amount = F.aggregate("_part", F.lit(1.0), lambda x, f: x * F.when(is_number(f), to_number(held(f))).otherwise(F.lit(1.0)))
    name = F.array_join(F.transform("_part", lambda f: F.when(is_number(f), f).otherwise(F.concat_ws("=", f, held(f)))), ":")
    cells = coded.where(shown).select(*keys, "_row", F.when(F.size("_part") == 0, F.lit("Intercept")).otherwise(name).alias("_column"), amount.alias("_x"))
    products = gram(cells, keys, "_row", "_column", "_x")
    schema = ", ".join([*[f"`{k}` string" for k in keys], "rank int", "estimable boolean"])
    ranks = products.groupBy(*keys).applyInPandas(_ranks(keys, tested), schema)
    out = plans.join(ranks, keys, "left")
    rank = F.coalesce("rank", F.lit(0))
    return out.select(
        *[F.when(F.col(k) != "\x00", F.col(k)).alias(k) for k in keys], "n_samples", "n_rows", F.col("n_columns").cast("int").alias("n_columns"),
        rank.alias("rank"), ((rank == F.col("n_columns")) & (F.col("n_rows") > 0)).alias("full_rank"), F.coalesce("estimable", F.lit(False)).alias("estimable"),
    )
