"""Toxic passages: maximum-scoring segments over token log-odds, judged by extreme-value statistics.

A token's score is its log-odds of standing in a toxic rather than a clean text,
under a Dirichlet prior that follows the whole sample, less a margin of its
standard errors, less a drift that makes the mean score of clean text negative.
Words seen too seldom take the score of their longest known beginning.  All
maximal scoring segments of a text are found in one pass (the stack algorithm of
Ruzzo and Tompa), so each passage ends where its sum stops growing.

A segment of sum S in a text of n tokens is as surprising as K n exp(-lambda S)
expected ones in clean text (Karlin and Altschul): lambda solves
sum p exp(lambda s) = 1 over the scores of clean tokens, K is fitted to the best
segments of clean texts that the tokens were not learned from.  Segments with an
expectation below ``significance`` are returned; the evidence of a text joins the
sums of its best r segments by their joint tail, for the r that surprises most.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from countloom.llm.ship import ship
from countloom.llm.store import stored

MAX_ROWS = 20_000
#: Size of the Dirichlet prior as a share of a kind's own tokens, standard errors taken off, and cost of a neutral token.
PRIOR, MARGIN, DRIFT = 0.05, 2.0, 0.05
#: A word with fewer texts than this takes the score of its beginning; beginnings have 4 to 7 letters.
KNOWN, BEGINNINGS = 5, (7, 6, 5, 4)
SIGNIFICANCE = 0.01
#: Largest number of scored tokens that is broadcast; the sample bounds it far below.
MAX_TOKENS = 4_000_000
CACHE = 500_000
TOKEN = re.compile(r"[^\W\d_]+")
RESULT = "evidence double, n_tokens bigint, segments array<struct<start: bigint, stop: bigint, score: double, expected: double>>"


@dataclass(frozen=True)
class Model:
    """Token scores, extreme-value parameters, and the evidence that is published as ``threshold``."""

    scores: dict[str, float]
    drift: float
    rate: float
    size: float
    cut: float
    slope: float
    threshold: float


def kinds(text: str | None) -> set[str]:
    """The distinct tokens of a text, and the beginnings of its longer ones, each marked by a closing hyphen."""
    words = set(TOKEN.findall((text or "").lower()))
    return words | {w[:k] + "-" for w in words for k in BEGINNINGS if len(w) > k}


def token_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts that hold each token, by kind, summed over the batch."""
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(batch["text"], batch["label"]):
            (toxic if label else clean).update(kinds(text))
        names = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"token": names, "a": [toxic[t] for t in names], "b": [clean[t] for t in names]})


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, sum), by position; neither end can be moved to gain, and none overlap.

    Only positive positions are visited; the negative ones in between count through the running sum.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    spots = np.flatnonzero(scores > 0)
    stack: list[tuple[int, int, float, float, int]] = []  # from, to, sum before, sum after, nearest entry that starts lower
    for i, low, high in zip(spots.tolist(), total[spots].tolist(), total[spots + 1].tolist()):
        start, stop = i, i + 1
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            # The entry starts lower and ends lower: joined with what lies between, it scores more than either.
            start, low = stack[j][0], stack[j][2]
            before = stack[j][4]
            del stack[j:]
            j = before
        stack.append((start, stop, low, high, j))
    return [(a, b, y - x) for a, b, x, y, _ in stack]


class Scorer:
    """Token scores with a bounded cache for the words looked up by their beginnings."""

    def __init__(self, scores: dict[str, float], drift: float) -> None:
        self.known, self.drift, self.cache = scores, drift, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = TOKEN.findall((text or "").lower())
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache = self.cache
        for word in set(words).difference(cache):
            cache[word] = self.look_up(word) - self.drift
        return np.fromiter(map(cache.__getitem__, words), dtype=np.float64, count=len(words))

    def look_up(self, word: str) -> float:
        if word in self.known:
            return self.known[word]
        for k in BEGINNINGS:
            if len(word) > k and (found := self.known.get(word[:k] + "-")) is not None:
                return found
        return 0.0


def evidence(found: list[tuple[int, int, float]], n: int, rate: float, size: float) -> float:
    """-ln of the joint tail of the best r segment sums, for the r that makes it largest; 0 without a segment."""
    best, joint = 0.0, 0.0
    shift = math.log(max(size * n, 1e-300))
    for r, total in enumerate(sorted((s for _, _, s in found), reverse=True), 1):
        joint += rate * total - shift
        if joint <= 0:
            break
        # Karlin and Altschul: exp(-T) T^(r-1) / (r! (r-1)!) for the sum T of r normalised scores; r choices cost 2^r.
        tail = joint - (r - 1) * math.log(joint) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(2)
        if joint > r - 1:
            best = max(best, tail)
    return best


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, label: str, text: str, max_rows: int) -> DataFrame:
    """text and label of at most about ``max_rows`` labelled rows of each kind, every distinct text once."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        .where(F.col("_low") == F.col("_high"))
        .select("_id", F.col("_low").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    spot = F.conv(F.substring(F.md5(F.col("_id").cast("string")), 1, 8), 16, 10).cast("double") / float(2**32)
    quota = F.lit(0.0)
    for kind, n in counts.items():
        quota = F.when(F.col("label") == kind, min(1.0, max_rows / n)).otherwise(quota)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(known.where(spot < quota)), "_id")
    # Copies of one text under several labels teach nothing; else one of them does.
    rows = rows.groupBy("text").agg(F.min("label").alias("label"), F.max("label").alias("_high"))
    rows = rows.where(F.col("label") == F.col("_high")).select("text", "label")
    return rows.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(5)).cast("int"))


def token_scores(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Score of each token that KNOWN texts hold or whose margin leaves anything; others fall back on their beginning.

    ``counts`` has token, a, b (toxic and clean texts with it), ``toxic`` and
    ``clean`` the sums of a and of b.  The prior of a kind is PRIOR of its size, spread like
    the whole sample, as log-odds then start from none.
    """
    a, b, every = F.col("a").cast("double"), F.col("b").cast("double"), (F.col("a") + F.col("b")) / float(max(toxic + clean, 1))
    pa, pb = every * (PRIOR * toxic) + 0.01, every * (PRIOR * clean) + 0.01
    ya, yb = a + pa, b + pb
    odds = F.log(ya / (toxic * (1 + PRIOR) + 1 - ya)) - F.log(yb / (clean * (1 + PRIOR) + 1 - yb))
    wide = F.sqrt(1 / ya + 1 / yb)
    held = F.when(odds > 0, F.greatest(odds - MARGIN * wide, F.lit(0.0))).otherwise(F.least(odds + MARGIN * wide, F.lit(0.0)))
    rows = counts.where(F.col("a") + F.col("b") >= KNOWN).select("token", F.round(held, 6).alias("s"))
    number = rows.count()
    if number > MAX_TOKENS:
        raise ValueError(f"{number} scored tokens, above {MAX_TOKENS}: take a smaller sample")
    return {r["token"]: r["s"] for r in rows.toLocalIterator()}


def extreme_values(scores: dict[float, int], best: list[tuple[int, float]]) -> tuple[float, float]:
    """(lambda, K): the root of sum p exp(lambda s) = 1, and K from the mean of lambda S - ln n over clean texts.

    ``scores`` counts the token scores of clean text, ``best`` holds tokens and
    best sum of clean texts.  Clean text without any positive score gets one such
    token of the score 1, so both exist.
    """
    values = np.array([*scores, 1.0])
    share = np.array([*scores.values(), 1.0])
    share = share / share.sum()
    if share @ values >= 0:
        values = values - (share @ values) - 0.01
    low, high = 0.0, 1.0
    tail = lambda x: share @ np.exp(np.minimum(x * values, 700.0)) - 1.0
    while tail(high) < 0:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) < 0 else (low, middle)
    rate = high
    # K is at most 1.  A Gumbel variable with location (ln K n) / lambda has its mean 0.5772 / lambda higher.
    shifted = [rate * s - math.log(n) for n, s in best if n > 0 and s > 0]
    size = math.exp(min(max(float(np.mean(shifted)) - 0.5772156649, -30.0), 0.0)) if shifted else math.exp(-5.0)
    return rate, size


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "toxic", text: str = "text",
        threshold: float = 0.7, max_rows: int = MAX_ROWS) -> Model:
    """Learn from at most about ``max_rows`` labelled rows of each kind (a documented bound), the ones of smallest md5.

    Four fifths of the distinct texts give the token scores, the others the
    extreme-value parameters and the cut, the evidence above which precision and
    recall have the largest harmonic mean.  Without labelled texts of both kinds every text gets the same
    low score.  Ids labelled both ways and labels without a document teach nothing.
    """
    ship(docs.sparkSession)
    rows = stored(_sample(docs, labels, id_col, label, text, max_rows), "toxic_sample")
    learn = rows.where("part > 0").select("text", "label")
    counts = learn.mapInPandas(token_counts, "token string, a long, b long").groupBy("token")
    counts = stored(counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "toxic_tokens")
    sums = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not sums["a"] or not sums["b"]:
        return Model({}, DRIFT, 1.0, 1.0, 1.0, 1.0, threshold)
    scores = token_scores(counts, sums["a"], sums["b"])
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    # The drift must outweigh what clean tokens gain on average.
    held = rows.where("part = 0").select("text", "label")
    gained = held.where("label = 0").mapInPandas(_score_counts(shared), "score double, n long")
    gained = {r["score"]: r["n"] for r in gained.groupBy("score").agg(F.sum("n").alias("n")).collect()}
    mean = sum(s * n for s, n in gained.items()) / max(sum(gained.values()), 1)
    drift = DRIFT + max(0.0, mean)
    shifted: dict[float, int] = {s - drift: n for s, n in gained.items()}
    rate, size = extreme_values(shifted, [])
    raw = Model(scores, drift, rate, size, 0.0, 1.0, threshold)
    judged = held.select("label", _judge(shared, raw)(F.col("text")).alias("r"))
    best = F.coalesce(F.array_max(F.transform("r.segments", lambda s: s["score"])), F.lit(0.0))
    judged = stored(judged.select("label", F.col("r.n_tokens").alias("n"), best.alias("s")), "toxic_held")
    # One row per held-out text of the bounded sample.
    rate, size = extreme_values(shifted, [(r["n"], r["s"]) for r in judged.where("label = 0").collect()])
    raw = Model(scores, drift, rate, size, 0.0, 1.0, threshold)
    held_evidence = held.select("label", _judge(shared, raw)(F.col("text")).getField("evidence").alias("e")).collect()
    shared.destroy()
    cut, slope = _cut([(r["e"], r["label"]) for r in held_evidence])
    return Model(scores, drift, rate, size, cut, slope, threshold)


def _cut(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """The evidence above which precision and recall have the largest harmonic mean, and the slope of the published score."""
    total = Counter(y for _, y in rows)
    if not total[0] or not total[1]:
        return 5.0, 1.0
    steps: dict[float, list[int]] = {}
    for e, y in rows:
        steps.setdefault(e, [0, 0])[y] += 1
    best, at, above = -1.0, 5.0, [total[0], total[1]]
    edges = sorted(steps)
    for low, high in zip(edges, [*edges[1:], edges[-1] + 2.0]):
        above = [above[k] - steps[low][k] for k in (0, 1)]
        worth = 2 * above[1] / (above[0] + above[1] + total[1])
        if worth > best:
            best, at = worth, (low + high) / 2
    return max(at, 1e-6), 4.0 / max(at, 1.0)


def _score_counts(shared: Broadcast):
    """Counts of the token scores of the texts of a batch."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value, 0.0)
        for batch in batches:
            found = Counter()
            for text in batch["text"]:
                values, times = np.unique(scorer(text), return_counts=True)
                found.update(dict(zip(values.tolist(), times.tolist())))
            yield pd.DataFrame({"score": list(found), "n": list(found.values())})

    return count


#: The scorer of a worker's current model, by a name that no other model has.
_scorers: dict[str, Scorer] = {}


def _judge(shared: Broadcast, model: Model, significance: float = SIGNIFICANCE):
    """Evidence, tokens and significant segments of each text."""
    drift, rate, size, number = model.drift, model.rate, model.size, uuid.uuid4().hex

    def judge(texts: pd.Series) -> pd.DataFrame:
        if number not in _scorers:
            _scorers.clear()
            _scorers[number] = Scorer(shared.value, drift)
        scorer = _scorers[number]
        out = []
        for text in texts:
            scores = scorer(text)
            n = len(scores)
            found = segments(scores) if n and scores.max() > 0 else []
            shown = [
                {"start": a, "stop": b, "score": round(s, 6), "expected": min(size * n * math.exp(-min(rate * s, 700.0)), float(n))}
                for a, b, s in found
            ]
            shown = [s for s in shown if s["expected"] < significance] if significance else shown
            out.append((round(evidence(found, n, rate, size), 9), n, shown))
        return pd.DataFrame(out, columns=["evidence", "n_tokens", "segments"])

    return pandas_udf(judge, RESULT)


def score(docs: DataFrame, model: Model, text: str = "text", significance: float = SIGNIFICANCE) -> DataFrame:
    """Adds ``score`` (0 to 1, exactly ``threshold`` at the cut), ``predicted`` and ``segments`` to every row.

    ``segments`` lists every significant passage: first token, token after the
    last, sum, and how many such passages clean text of this length would show by chance;
    tokens are runs of letters of the lower-cased text.  Null and empty texts have
    none and the lowest score.  Columns of these names are replaced; repeated rows stay.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.scores)
    names = ("score", "predicted", "segments")
    judged = _judge(shared, model, significance)(F.col(text)).alias("_judged")
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c not in names], judged)
    at = math.log(model.threshold / (1.0 - model.threshold))
    raw = (F.col("_judged.evidence") - model.cut) * model.slope + at
    value = F.round(1.0 / (1.0 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), raw)))), 9)
    rows = rows.withColumn("score", value)
    return rows.withColumns(
        {"predicted": (F.col("score") >= model.threshold).cast("int"), "segments": F.col("_judged.segments")}
    ).drop("_judged")
