"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1.  Each source has a weight schedule, linear
between knots; its integral is the source's cumulative demand, scaled so that
the whole run asks for exactly the source's target.  The documents of a source
form a stream in a fixed shuffled order, repeated as often as the target needs.
A document takes the stretch of the stream that lies below the target, and its
training position is the time at which demand reaches that stretch: the inverse
of the cumulative demand.  Documents of all sources are then range-sorted by
position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm.store import running, stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 2
#: Weight schedules as (time, weight) knots, dealt to the sources in turn: early, level and late.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
)


def targets(sources: DataFrame, weights: Sequence[float], share: float, repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to (source, source_size) rows.

    Sources rank by code point, null last, and take the weights in turn.  The
    mix is ``share`` of all sizes; no target is above ``repeats`` times its
    source's size.  Handing the excess on by weight until none is left comes to
    min(limit, rate * weight) with one common rate, and that rate follows from
    running sums over the sources in the order of limit / weight.
    """
    ranked = running(
        sources.withColumn("null_", F.col("source").isNull()),
        [F.col("null_"), F.col("source")],
        {"rank": F.lit(1).cast("bigint")},
    )
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.select(
        "source",
        "source_size",
        F.col("rank_before").alias("rank"),
        kinds[(F.col("rank_before") % len(weights)).cast("int")].alias("weight"),
        (F.col("source_size") * repeats).alias("limit_"),
    )
    ranked = stored(ranked, "sources")
    sums = ranked.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("w")).first()
    total, weight = (sums["all"] or 0) * share, sums["w"] or 1.0
    ordered = running(
        ranked, [F.col("limit_") / F.col("weight"), F.col("rank")], {"full": F.col("limit_"), "w": F.col("weight")}
    )
    # The rate if exactly the sources before this one are full; the first that it does not fill decides.
    rate = (F.lit(total) - F.col("full_before")) / (F.lit(weight) - F.col("w_before"))
    fits = ordered.withColumn("rate_", rate).where(F.col("rate_") * F.col("weight") <= F.col("limit_"))
    level = fits.agg(F.min(F.struct(F.col("limit_") / F.col("weight"), "rank", "rate_")).alias("m")).first()["m"]
    reach = F.lit(level["rate_"]) * F.col("weight") if level else F.col("limit_").cast("double")
    target = F.least(F.col("limit_").cast("double"), reach)
    return ranked.select("source", "source_size", "rank", "weight", target.alias("target"))


def position(done: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """The time at which a share ``done`` (0 to 1) of a source's demand is reached.

    The weight between knots is a line, so cumulative demand is a parabola there
    and its inverse the root of a quadratic.
    """
    pieces, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        grown = (w0 + w1) / 2 * (t1 - t0)
        pieces.append((area, grown, t0, t1, w0, w1))
        area += grown
    out = F.lit(float(schedule[-1][0]))
    for start, grown, t0, t1, w0, w1 in reversed(pieces):
        asked = F.greatest(F.lit(0.0), done * area - start)
        slope = (w1 - w0) / (t1 - t0)
        # The stable root: 2c / (b + sqrt(b^2 + 2 a c)).
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + asked * (2 * slope)))
        here = F.lit(t0) + F.when(root + w0 > 0, asked * 2.0 / (root + w0)).otherwise(F.lit(0.0))
        out = F.when(done * area <= start + grown, F.least(F.lit(t1), here)).otherwise(out)
    return out


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] = (),
    repeats: int = MAX_REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, taken, passes, position and positions.

    ``size`` counts words (null text: 0).  ``taken`` is how many words the mix
    takes, repeats counted; at most ``repeats`` times the size.  Within a source
    the takes add up to the target but for its fraction of a word: the last
    document of the last pass may be taken in part.  ``positions`` are when the
    passes reach the document, one for each pass that takes of it, ``position`` the
    first of them (null when nothing is taken) and ``passes`` their number.  Columns named in ``keep`` come along.  Documents are
    shuffled by the md5 of the id, rows equal in id by their text's hash, so reruns
    agree.  A null source is a source of its own; empty texts are never taken; an
    empty table gives no rows.
    """
    slim = docs.select(
        F.col(id_col).alias("id_"),
        F.col(source).alias("source_"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint").alias("size_"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("spot_"),
        F.xxhash64(F.col(text)).alias("tie_"),
        *[F.col(c).alias(f"keep{i}_") for i, c in enumerate(keep)],
    )
    slim = stored(slim, "sizes")
    sizes = slim.groupBy(F.col("source_").alias("source")).agg(F.sum("size_").alias("source_size"))
    goal = stored(targets(sizes, weights, share, repeats), "targets")
    stream = running(slim, [F.col("spot_"), F.col("tie_")], {"size": F.col("size_")}, by=["source_"])
    joined = stream.join(goal, F.col("source_").eqNullSafe(F.col("source")))
    words = F.floor("target").cast("bigint")
    takes, firsts = [], []
    for k in range(repeats):
        start = F.col("source_size") * k + F.col("size_before")
        take = F.least(F.col("size_"), F.greatest(F.lit(0).cast("bigint"), words - start))
        takes.append(take)
        firsts.append(F.when(take > 0, start))

    def at(done: Column) -> Column:
        when = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            when = F.when(F.col("rank") % len(schedules) == i, position(done, schedule)).otherwise(when)
        return F.round(when, 9)

    starts = F.filter(F.array(*firsts), lambda s: s.isNotNull())
    taken, passes = F.lit(0).cast("bigint"), F.lit(0)
    for take in takes:
        taken, passes = taken + take, passes + F.when(take > 0, 1).otherwise(0)
    joined = joined.withColumns({"taken_": taken, "passes_": passes, "done_": F.transform(starts, lambda s: s / F.col("target"))})
    joined = joined.withColumn("at_", F.transform("done_", at))
    return joined.select(
        F.col("id_").alias(id_col),
        F.col("source_").alias(source),
        F.col("size_").alias("size"),
        "source_size",
        "target",
        F.col("taken_").alias("taken"),
        F.col("passes_").alias("passes"),
        F.get("at_", F.lit(0)).alias("position"),
        F.col("at_").alias("positions"),
        *[F.col(f"keep{i}_").alias(c) for i, c in enumerate(keep)],
    )


def in_training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Range-sort by position, then id: partition after partition is the training order; rows never taken come last."""
    keys = [F.col("position").asc_nulls_last(), F.col(id_col)]
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
