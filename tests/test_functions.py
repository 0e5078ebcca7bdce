"""Special functions, text helpers and rankings against plain Python."""

import math
import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from countloom.functions import missing, scores, special, text
from countloom.operators import ranking


def test_normal_tail_and_quantile(spark):
    xs = [0.0, 0.3, 0.5, 1.0, 2.5, 3.9, 4.1, 8.0, 37.0, -1.2, -5.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", special.norm_sf("x").alias("y")).collect():
        assert math.isclose(r.y, 0.5 * math.erfc(r.x / math.sqrt(2)), rel_tol=1e-12)
    ps = [1e-300, 1e-20, 1e-5, 0.01, 0.3, 0.5, 0.7, 0.99]
    for r in spark.createDataFrame([(p,) for p in ps], "p double").select("p", special.norm_isf("p").alias("y")).collect():
        assert abs(r.y + statistics.NormalDist().inv_cdf(r.p)) < 1e-9 * max(1, abs(r.y))


def _chi2(x, k):
    a, h = k / 2, x / 2
    term, total, n = h**a * math.exp(-h) / math.gamma(a + 1), 0.0, 0
    while n < 300:
        total, n = total + term, n + 1
        term *= h / (a + n)
    return 1 - total


def test_chi2_beta_and_hypergeometric(spark):
    rows = [(x, k) for x in (0.5, 2.0, 11.0) for k in (1, 2, 3, 4, 9)]
    for r in spark.createDataFrame(rows, "x double, k int").select("x", "k", special.chi2_sf("x", "k").alias("y")).collect():
        assert abs(r.y - _chi2(r.x, r.k)) < 1e-11
    assert abs(spark.range(1).select(special.beta_cdf_int(F.lit(0.3), F.lit(2), F.lit(5)).alias("y")).first().y - 0.47178) < 1e-9
    rows = [(k, m, n, d) for m, n, d in ((100, 10, 20), (12, 5, 9)) for k in range(6)]
    for r in spark.createDataFrame(rows, "k long, m long, marked long, drawn long").select("*", special.hypergeom_sf("k", "m", "marked", "drawn").alias("y")).collect():
        exact = sum(math.comb(r.marked, j) * math.comb(r.m - r.marked, r.drawn - j) for j in range(r.k, min(r.marked, r.drawn) + 1) if r.drawn >= j) / math.comb(r.m, r.drawn)
        assert abs(r.y - exact) < 1e-9


def _bh(p):
    p = np.asarray(p)
    order = np.argsort(p)
    adjusted = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1].clip(max=1)
    out = np.empty(len(p))
    out[order] = adjusted
    return out


def test_rankings_match_brute_force_on_skewed_ties(spark):
    random.seed(4)
    rows = [("a" if i % 3 else "b", random.choice([1.0, 1.0, 0.5, random.random(), random.random() ** 9]), i) for i in range(400)] + [("a", None, 999)]
    df = spark.createDataFrame(rows, "f string, p double, i int")
    split = {r.i: r.padj for r in ranking.bh_adjust(df, "p", ["f"]).collect()}
    plain = {r.i: r.padj for r in ranking.bh_adjust(df, "p", ["f"], small=True).collect()}
    moved = {r.i: r.padj for r in ranking.bh_adjust(df.repartition(7), "p", ["f"]).collect()}
    assert split[999] is None and len(split) == len(rows)
    for family in "ab":
        mine = [(r[2], r[1]) for r in rows if r[0] == family and r[1] is not None]
        for (i, _), expected in zip(mine, _bh([p for _, p in mine])):
            assert abs(split[i] - expected) < 1e-12 and abs(plain[i] - expected) < 1e-12 and moved[i] == split[i]
    for r in ranking.quantiles(df, "p", ["f"], {"m": 0.5, "q": 0.1}).collect():
        values = [x[1] for x in rows if x[0] == r.f and x[1] is not None]
        assert abs(r.m - np.median(values)) < 1e-12 and abs(r.q - np.quantile(values, 0.1)) < 1e-12
    known = df.where("p is not null")
    ranks = ranking.normalized_rank(known, ["f"], "p", "i").collect()
    assert len({(r.f, r.normalized_rank) for r in ranks}) == 400
    by_rank = sorted((r for r in ranks if r.f == "a"), key=lambda r: r.normalized_rank)
    assert [r.p for r in by_rank] == sorted(r.p for r in by_rank)
    for r in ranking.avg_rank(known, "p", ["f"]).collect():
        values = [x[1] for x in rows if x[0] == r.f and x[1] is not None]
        below, same = sum(v < r.p for v in values), sum(v == r.p for v in values)
        assert r.rank == below + (same + 1) / 2


def test_missing_booleans_and_numbers(spark):
    df = spark.createDataFrame([(x,) for x in ("", "NA", "N/A", "null", "None", " NA", "x", None)], "t string")
    assert [r.m for r in df.select(missing.is_missing("t").alias("m")).collect()] == [True] * 5 + [False, False, True]
    df = spark.createDataFrame([("true",), ("True",), ("false",), ("1",)], "t string")
    assert [r.b for r in df.select(missing.as_bool("t").alias("b")).collect()] == [True, None, False, None]
    df = spark.createDataFrame([("1e3",), ("NaN",), ("inf",), ("x",), (" 2 ",)], "t string")
    assert [r.n for r in df.select(missing.to_number("t").alias("n")).collect()] == [1000.0, None, None, None, 2.0]


def test_text_helpers(spark):
    df = spark.createDataFrame([("ENSG1.12", "Case-1 of control2", "a: b:c", "http://h/x/y%20z.tar.gz?q=1#f")], "g string, t string, k string, u string")
    key, value = text.key_value("k")
    r = df.select(text.strip_version("g").alias("g"), text.match_terms("t", ["case", "control"]).alias("m"), key.alias("k"), value.alias("v"), text.url_file_name("u").alias("u"), text.safe_name("t").alias("s")).first()
    assert (r.g, r.m, r.k, r.v, r.u, r.s) == ("ENSG1", ["case"], "a", "b:c", "y z.tar.gz", "Case-1_of_control2")


def test_scores(spark):
    df = spark.createDataFrame([(1e-5,), (None,), (0.0,), (1.0,)], "p double")
    assert [r.s for r in df.select(scores.p_score("p").alias("s")).collect()] == [0.5, 0.0, 1.0, 0.0]
    r = spark.range(1).select(scores.direction(F.lit(1.0), F.lit(-2.0)).alias("a"), scores.direction(F.lit(0.0), F.lit(1.0)).alias("b"), scores.evidence_level(F.lit(0.5)).alias("c")).first()
    assert (r.a, r.b, r.c) == ("opposite", "not_comparable", "moderate")
