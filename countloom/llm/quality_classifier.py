"""Quality classifier: Bradley-Terry scores learned from preference pairs.

A pair says that one text is preferred to another.  The score is linear in the
features of a text and is fitted by logistic loss on the feature differences of
the pairs (no intercept, as only differences count).  The cut between good and
bad is a quantile of the learned scores; the published score maps the latent one
to 0..1 so that the cut falls on the threshold of the caller.

Fitting uses every labelled row unless the caller bounds their number; scoring is
a map-only expression over every whole text.  Texts never cross a shuffle: their
features are taken where they are read, and only those meet the labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm.ship import ship
from countloom.llm.store import running, stored
from countloom.llm.textstats import CLASS_NAMES, COMMON, blanked, class_counts, found_words, line_counts, settled, share, words_of
from countloom.operators.ranking import quantiles

ROUNDS = 6
FEATURES = (
    *[f"f_{c}" for c in CLASS_NAMES],
    "f_common", "f_no_common", "f_word_length", "f_long_words", "f_dup_lines", "f_line_words", "f_words",
    "f_distinct", "f_stutter",
)


@dataclass(frozen=True)
class Model:
    """Weights of the features, the latent cut and the published score at the cut."""

    weights: tuple[float, ...]
    cut: float
    scale: float
    threshold: float


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the feature columns; null and blank texts get zeros.  Reads the text alone, never ids or labels."""
    every = sorted({w for words in COMMON.values() for w in words})
    df = words_of(blanked(df.withColumn("_text", F.col(text)), "_text"))
    df = line_counts(class_counts(df), "_text").withColumn("_hits", F.size(found_words(every)))
    df = df.withColumn("_again", F.regexp_count("_blanked", F.lit(r"(?<![^ ])([^ ]+) +(?=\1(?![^ ]))")))
    n = F.size("_words").cast("double")
    chars = F.col("_len").cast("double")
    letters = F.col("_len") - F.col("_c_blank")
    common = share(F.col("_hits"), n)
    df = df.withColumns(
        {
            **{f"f_{c}": F.sqrt(share(F.col(f"_c_{c}"), chars)) for c in CLASS_NAMES},
            "f_common": F.least(common, F.lit(0.4)),
            "f_no_common": F.greatest(F.lit(0.0), F.lit(0.1) - common) * 5,
            "f_word_length": F.least(share(letters, n), F.lit(20.0)) / 10,
            "f_long_words": F.greatest(F.lit(0.0), F.least(share(letters, n), F.lit(20.0)) - 6.5) / 10,
            "f_dup_lines": share(F.col("_dup_lines"), F.col("_lines")),
            "f_line_words": F.log1p(share(n, F.col("_lines"))) / 5,
            "f_distinct": share(F.size(F.array_distinct("_words")), n),
            "f_stutter": F.sqrt(share(F.col("_again"), n)),
            "f_words": F.least(F.log1p(n), F.lit(7.0)) / 7,
        }
    )
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def latent(weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for name, weight in zip(FEATURES, weights):
        total = total + F.col(name) * F.lit(float(weight))
    return total


def preference_pairs(rows: DataFrame, label: str, good: int, bad: int, rounds: int = ROUNDS) -> DataFrame:
    """``_x``: feature differences, preferred minus other: every row of the larger class meets
    ``rounds`` rows of the smaller one, dealt in turn, so pairs grow with the rows, not their square.
    """
    big, small = (1, 0) if good >= bad else (0, 1)
    m = min(good, bad)
    deals = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_k")
    # Both sides grow with the labelled rows, so neither is sent whole to every executor.
    left = rows.where(F.col(label) == big).select("_seat", F.array(*FEATURES).alias("_a"), deals)
    left = left.withColumn("_other", F.pmod(F.col("_seat") + F.col("_k") * F.lit(max(1, m // rounds)), F.lit(m)))
    right = rows.where(F.col(label) == small).select(F.col("_seat").alias("_other"), F.array(*FEATURES).alias("_b"))
    toward = 1.0 if big == 1 else -1.0
    return left.join(right.hint("merge"), "_other").select(F.zip_with("_a", "_b", lambda x, y: (x - y) * toward).alias("_x"))


def pair_weights(pairs: DataFrame, reg: float, tolerance: float = 1e-9) -> tuple[float, ...]:
    """Minimum of the mean of ln(1 + exp(-w x)) over the pairs plus reg / 2 times the squared weights in units of the features' spread.

    Newton's method on sums of 17 x 17: each pass adds, over all pairs, loss, gradient
    and second derivatives.  A step that does not lower the loss is halved; it ends when
    the gradient is within the tolerance or no step lowers the loss any more.
    """
    size = len(FEATURES)

    def summed(weights: np.ndarray) -> np.ndarray:
        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((size + 1, size + 1))
            squares = np.zeros(size)
            for batch in batches:
                if len(batch):
                    x = np.stack(batch["_x"].to_list())
                    z = np.clip(x @ weights, -500.0, 500.0)
                    p = 1.0 / (1.0 + np.exp(z))
                    total[:size, :size] += (x * (p * (1 - p))[:, None]).T @ x
                    total[:size, size] -= p @ x
                    total[size, :size] += (x * x).sum(axis=0)
                    total[size, size] += np.logaddexp(0.0, -z).sum()
                    squares[0] += len(x)
            yield pd.DataFrame({"i": np.arange((size + 1) ** 2 + 1), "v": np.append(total.ravel(), squares[0])})

        out = np.zeros((size + 1) ** 2 + 1)
        for r in pairs.mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out[:-1].reshape(size + 1, size + 1) / max(out[-1], 1.0)

    weights = np.zeros(size)
    now = summed(weights)
    ridge = reg * np.maximum(now[size, :size], 1e-12)
    whole = lambda m, w: m[size, size] + (ridge * w * w).sum() / 2
    while True:
        gradient = now[:size, size] + ridge * weights
        if np.abs(gradient / np.sqrt(ridge / reg)).max() <= tolerance:
            break
        step = np.linalg.solve(now[:size, :size] + np.diag(ridge), gradient)
        for _ in range(40):
            then = summed(weights - step)
            if whole(then, weights - step) < whole(now, weights):
                break
            step = step / 2
        else:
            break
        weights, now = weights - step, then
    return tuple(float(w) for w in weights)


def _whole_weights(good: int, good_kept: int, bad: int, bad_kept: int) -> tuple[int, int]:
    """Whole numbers in the ratio good / good_kept to bad / bad_kept, rounded when they would be very large."""
    one, two = good * bad_kept, bad * good_kept
    both = math.gcd(one, two)
    one, two = one // both, two // both
    shrink = max(1.0, max(one, two) / 1e12)
    return max(1, round(one / shrink)), max(1, round(two / shrink))


def _bounded(known: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` labelled ids of each kind, those of the smallest md5."""
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    spot = F.conv(F.substring(F.md5(F.col("_id").cast("string")), 1, 8), 16, 10).cast("double") / float(2**32)
    quota = F.lit(0.0)
    for kind, n in counts.items():
        quota = F.when(F.col("_label") == kind, min(1.0, max_rows / n)).otherwise(quota)
    return known.where(spot < quota)


def described(docs: DataFrame, learned: DataFrame, id_col: str, text: str | None) -> DataFrame:
    """(id, label, features) of the documents of ``learned`` (_id, _label); without ``text``, ``docs`` has the features."""
    rows = docs if text is None else features(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")))
    rows = rows.select(F.col("id" if text is not None else id_col).alias("id"), *FEATURES)
    known = learned.select(F.col("_id").alias("id"), F.col("_label").alias("label"))
    return rows.join(known.hint("merge"), "id")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", text: str | None = "text",
        threshold: float = 0.3, max_rows: int | None = None, reg: float = 1e-4) -> Model:
    """Learn from all labelled rows, or from at most about ``max_rows`` of each kind.

    ``text=None`` says that ``docs`` holds the columns of ``features`` already.
    The cut is that of all labelled rows: it uses their true share of bad ones and
    weighs the rows of a bounded kind up to it, so the bound does not move it.
    A bound keeps the rows with the smallest md5 of the id, so reruns agree.
    Rows without a label or id, and labels without a document, teach nothing;
    an id labelled both ways is left out.  Without labelled documents of both kinds
    (an empty table among others) the model is constant: 1 if no bad one is known, else 0.
    Seats are dealt over many tasks, and the quantiles are exact without one task that sorts.
    """
    ship(docs.sparkSession)
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        .where(F.col("_low") == F.col("_high"))
        .select("_id", F.col("_low").alias("_label"))
    )
    learned = known if max_rows is None else _bounded(known, max_rows)
    rows = stored(described(docs, learned, id_col, text), "labelled")
    rows = running(rows, [F.md5(F.col("id").cast("string")), F.col("id")], {"seat": F.lit(1)}, by=["label"])
    rows = stored(rows.withColumnsRenamed({"seat_before": "_seat", "label": "_y"}), "seats")
    kept = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not kept.get(0) or not kept.get(1):
        # No pair can be formed: every text gets the score 1 if no bad row is known, else 0.
        return Model((0.0,) * len(FEATURES), 1.0 if kept.get(0) else -1.0, 1e3, threshold)
    weights = pair_weights(stored(preference_pairs(rows, "_y", kept[1], kept[0]), "pairs"), reg)
    scored = rows.select(latent(weights).alias("s"), "_y")
    # The latent quantile at the share of bad rows among all labelled rows, each row of a bounded kind standing for as
    # many as its kind was thinned by; sides are the medians of each kind.
    whole = kept
    if max_rows is not None:
        every = docs.select(F.col(id_col).alias("_id")).join(known, "_id").groupBy("_label").agg(F.count(F.lit(1)).alias("n"))
        whole = {r["_label"]: r["n"] for r in every.collect()}
    bad = whole[0] / (whole[0] + whole[1])
    good_times, bad_times = _whole_weights(whole[1], kept[1], whole[0], kept[0])
    times = F.when(F.col("_y") == 1, F.lit(good_times)).otherwise(F.lit(bad_times)).cast("long")
    cut = quantiles(scored.withColumn("_times", times), "s", [], {"cut": bad}, "_times").first()["cut"]
    sides = {r["_y"]: r["m"] for r in quantiles(scored, "s", ["_y"], {"m": 0.5}).collect()}
    spread = max(1e-6, abs(sides[1] - sides[0]) / 2)
    return Model(weights, float(cut), 3.0 / spread, threshold)


def score(docs: DataFrame, model: Model, text: str | None = "text") -> DataFrame:
    """Adds ``score`` (0 to 1; exactly ``threshold`` at the cut) and ``predicted`` to every row.

    Null and empty texts are scored like any other, from zero features.  Columns
    of ``docs`` called score or predicted are replaced.  ``text=None`` says that
    ``docs`` holds the columns of ``features`` already; they are not returned.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted") and (text is not None or c not in FEATURES)]
    at = math.log(model.threshold / (1.0 - model.threshold))
    raw = (latent(model.weights) - F.lit(model.cut)) * F.lit(model.scale) + F.lit(at)
    bounded = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), raw))
    columns = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)]
    df = docs.select(*columns, *FEATURES) if text is None else features(docs.select(*columns, F.col(text).alias("t_")), "t_")
    value = F.round(1.0 / (1.0 + F.exp(-bounded)), 9)
    df = df.withColumn("score", value).withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))
    df = settled(df.drop(*FEATURES), ("score", "predicted"))
    return df.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], "score", "predicted")
