"""Toxic segments, periodic runs and whitening against brute force, on odd rows and on empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from countloom.llm import bm25, periodic, queries, toxicity, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every stretch of period q that cannot be made longer, with no shorter period, six words and four periods at least."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q):
                part = words[i : i + n]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_all_periods():
    draw = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(4):
            words = [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randint(0, 50))]
            for _ in range(draw.randint(0, 3)):
                at, some = draw.randrange(len(words) + 1), draw.randint(1, 8)
                words[at:at] = words[at : at + some] * draw.randint(2, 7)
            texts.append([str(w) for w in words])
        found = periodic.runs_of_texts(texts)
        assert found == [plain_runs(t) for t in texts]
        for text, runs in zip(texts, found):
            assert sorted(periodic.runs_of([int(w) for w in text]), key=lambda r: (r[0], r[2])) == runs


def test_runs_of_fibonacci_and_long_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic.runs_of(b, min_length=2, min_exponent=2) and not plain_runs(b)
    assert periodic.runs_of([1, 2, 3] * 20_000) == [(0, 60_000, 3)]
    draw = random.Random(7)
    half = [draw.randrange(3000) for _ in range(3000)]
    assert periodic.runs_of(half * 4 + [-5]) == [(0, 12_000, 3000)]
    assert not periodic.windows(np.array(half * 2), np.zeros(6000, dtype=int))


def periodic_rows(rows):
    """The contract of the query in plain Python."""
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        h, n = (zlib.crc32(str(i).encode()), len(words)) if i is not None else (1, len(words))
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = plain_runs(words)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append(
            (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
             digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(w for k, w in enumerate(words) if k not in gone)))
        )
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_periodic_query_on_a_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"] or "") < 6000]
    made = queries.op12_periodic_runs(spark, SF).collect()
    wanted = periodic_rows(rows)
    ids = {r[0] for r in wanted}
    assert len(made) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert order(r for r in made if r["doc_id"] in ids) == order(wanted)
    assert any(r["n_runs"] for r in made)


def test_periodic_odd_rows(spark, odd_docs):
    made = periodic.find_runs(odd_docs.withColumn("runs", F.lit("x"))).collect()
    assert len(made) == 11
    for r in made:
        words = WORD.findall(r["text"] or "")
        if len(words) < 1000:
            assert [tuple(x) for x in r["runs"]] == plain_runs(words)
        if not r["runs"]:
            assert r["collapsed"] == " ".join(words)
    tails = periodic.repeated_tail(odd_docs).collect()
    assert len(tails) == 11 and all(len(t["text"].split(" ")) == max(1, len(t["text"].split())) for t in tails)
    assert periodic.find_runs(odd_docs.limit(0)).count() == 0 and periodic.repeated_tail(odd_docs.limit(0)).count() == 0


def best_segments(s):
    """The largest sum first, then both sides of it in the same way; the shorter one of equal sums."""

    def parts(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += s[j]
                if total > 0 and (best is None or total > best[0] or (total == best[0] and j + 1 - i < best[2] - best[1])):
                    best = (total, i, j + 1)
        return parts(a, best[1]) + [(best[1], best[2], best[0])] + parts(best[2], b) if best else []

    return parts(0, len(s))


def test_segments_equal_recursive_maxima():
    draw = random.Random(2)
    for _ in range(800):
        s = [draw.choice([-3, -2, -1.5, -1, -0.5, 0.5, 1, 2, 2.25, 4]) for _ in range(draw.randint(0, 25))]
        got, want = toxicity.segments(np.array(s, dtype=float)), best_segments(s)
        assert sorted(x[2] for x in got) == sorted(x[2] for x in want)
    assert toxicity.segments(np.array([-1.0, 4.0, -1.0, 3.0, -9.0, 1.0])) == [(1, 4, 6.0), (5, 6, 1.0)]


def test_extreme_values_and_evidence():
    rate, size = toxicity.extreme_values({-1.0: 900_000, 1.0: 100_000}, [])
    assert abs(rate - np.log(9.0)) < 1e-3 and size > 0
    one = toxicity.evidence([(0, 1, 6.0)], 100, 1.0, 0.1)
    assert abs(one - (6.0 - np.log(10.0))) < 1e-9
    assert toxicity.evidence([(0, 1, 6.0), (4, 5, 6.0)], 100, 1.0, 0.1) > one
    assert toxicity.evidence([(0, 1, 6.0)], 10_000, 1.0, 0.1) < one and toxicity.evidence([], 5, 1.0, 0.1) == 0.0


def toxic_tables(spark, n=240):
    draw = random.Random(4)
    prose = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = []
    for i in range(n):
        words = [draw.choice(prose) for _ in range(draw.randint(40, 120))]
        if i % 4 == 0:
            at = draw.randrange(len(words))
            words[at:at] = [draw.choice(["scoundrel", "rotter", "cadlike", "knave"]) for _ in range(4)]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 3 != 1"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in truth if i % 3 == 1]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    bad = next(i for i in held if truth[i] and got[i]["segments"])
    words = toxicity.TOKEN.findall(got[bad]["text"].lower())
    segment = max(got[bad]["segments"], key=lambda s: s["score"])
    assert {"scoundrel", "rotter", "cadlike", "knave"} >= set(words[segment["start"] : segment["stop"]])


def test_toxicity_odd_rows(spark, odd_docs):
    docs, labels = toxic_tables(spark)
    model = toxicity.fit(docs, labels)
    made = toxicity.score(odd_docs, model).collect()
    assert len(made) == 11 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in made)
    assert toxicity.score(odd_docs.limit(0), model).count() == 0
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.where("doc_id < 0")):
        constant = toxicity.fit(docs, some)
        assert {r["predicted"] for r in toxicity.score(docs, constant).collect()} == {0}
    both = labels.withColumn("toxic", 1 - F.col("toxic"))
    assert not toxicity.fit(docs, labels.union(both)).scores
    assert not toxicity.fit(odd_docs.limit(0), labels).scores


def scatter(x):
    c = x - x.mean(axis=0)
    return c.T @ c


@pytest.mark.parametrize("kind", ["plain", "equal columns", "repeated rows", "few rows"])
def test_spectra_equal_the_scatter_matrix(kind):
    draw = np.random.default_rng(3)
    for _ in range(40):
        d = int(draw.integers(1, 12))
        x = np.floor(64 * draw.normal(size=(int(draw.integers(2, 6 if kind == "few rows" else 40)), d)) * 10.0 ** draw.uniform(-2, 1, size=d))
        if kind == "equal columns":
            x[:, -1] = x[:, 0]
        if kind == "repeated rows":
            x = np.repeat(x, 3, axis=0)
        one, two = whitening.Spectrum(d), whitening.Spectrum(d)
        for i, v in enumerate(x):
            (one if i % 2 else two).add(v)
        one.join(two)
        want = scatter(x)
        assert np.abs(one.vectors.T @ one.vectors - np.eye(d)).max() < 1e-11
        assert np.abs((one.vectors * one.values) @ one.vectors.T - want).max() <= 1e-10 * max(1.0, np.abs(want).max())


def test_secular_roots():
    d, z = np.array([1.0, 2.0, 2.0 + 1e-9, 50.0]), np.array([0.5, 0.1, 0.7, 0.5])
    z /= np.sqrt(z @ z)
    pole, offset = whitening.secular_roots(d, z, 3.0)
    assert np.allclose(np.sort(d[pole] + offset), np.linalg.eigvalsh(np.diag(d) + 3.0 * np.outer(z, z)), atol=1e-12)


def test_whitening_query(spark):
    rows = queries.op13_embedding_whitening(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.floor(64 * np.stack(table["embedding"]).astype(np.float64)) + 1_000_000
    n, v = len(x), scatter(x) / len(x)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want = (x - x.mean(axis=0)) @ vectors / np.sqrt(values)
    got = rows.sort_values(["vec_id", "component"])
    assert len(got) == 32 * n and set(got["n"]) == {n} and got["identity_error"].max() <= 1e-4
    place = table.sort_values("vec_id").index
    assert np.allclose(np.abs(got["whitened"].to_numpy().reshape(n, 32)), np.abs(want[place]), atol=1e-7)
    assert np.allclose(got["explained"].to_numpy()[:32], values / np.trace(v), rtol=1e-9)
    exact = {i: sum((n * int(a) - int(t)) ** 2 for a, t in zip(r, x.sum(axis=0))) for i, r in zip(table["vec_id"], x)}
    assert all(exact[i] == y for i, y in zip(got["vec_id"], got["deviation"]))


def test_whitening_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, n string, whitened int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0], "a", 1), (1, [1.0, 2.0, 3.0], "a", 1), (None, [0.5, -2.0, 3.0], None, None), (3, None, "", 0), (4, [1.0, None, 2.0], "", 0),
            (5, [nan, 1.0, 1.0], "", 0), (6, [inf, 1.0, 1.0], "", 0), (7, [1.0, 2.0], "", 0), (8, [], "", 0)]
    made = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert [r["n"] for r in made] == [3, 3, 3] and {len(r["whitened"]) for r in made} == {1}
    assert made[0]["identity_error"] < 1e-9 and sum(r["whitened"][0] for r in made) < 1e-9
    same = whitening.whiten(spark.createDataFrame(rows[:2], schema)).collect()
    assert [list(r["whitened"]) for r in same] == [[], []] and same[0]["identity_error"] is None and same[0]["deviation"] == 0
    assert whitening.whiten(spark.createDataFrame(rows[3:6], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    large = [(i, [float(i % 7) * 1e9, 1.0 + i], "", 0) for i in range(50)]
    x = np.array([[int(64 * a) for a in r[1]] for r in large], dtype=object)
    want = {i: sum((50 * a - s) ** 2 for a, s in zip(r, x.sum(axis=0))) for i, r in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(large, schema)).collect()} == want


def test_many_spectra_join_in_packs(spark):
    draw = np.random.default_rng(1)
    x = np.floor(64 * draw.normal(size=(120, 5)))
    table = spark.createDataFrame([(v.astype(int).tolist(),) for v in x], "_x array<long>").repartition(37)
    total = whitening.combine(whitening.spectra(table), fan=3)
    assert total.n == 120 and np.allclose((total.vectors * total.values) @ total.vectors.T, scatter(x))


def test_license_query_without_id(spark, odd_docs, tmp_path):
    odd_docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    ids = [r["doc_id"] for r in queries.op4_license_scan(spark, str(tmp_path)).collect()]
    assert None in ids and {1, 2, 4, 5, 6, 7, 8, 9, 10} <= set(ids)


def test_bm25_shards_return_only_rows_that_reach_the_floor():
    """With the k-th score of other shards as a floor, a shard adds few rows, and the best stay the same."""
    draw = random.Random(3)
    texts = [" ".join(f"w{min(draw.randint(0, 400), draw.randint(0, 400))}" for _ in range(draw.randint(1, 60))) for _ in range(800)]
    rows = pd.DataFrame({"id": range(800), "text": texts})
    shards = [bm25.Shard(next(bm25.build_shard(rows[rows["id"] % 8 == i].assign(shard=i)).itertuples()), 30.0) for i in range(8)]
    terms = [np.unique(bm25.term_hashes(t)) for t in texts[:40]]
    idf = [1 + (t % 7) / 3.0 for t in terms]
    asked = np.concatenate(terms), np.concatenate(idf), np.array([len(t) for t in terms])
    found = [s.best(*asked, np.zeros(40), 5) for s in shards]
    query, ids, scores = (np.concatenate(x) for x in zip(*found))
    top = bm25.first_of_each(query, ids, scores, 5)
    assert len(query) == 8 * 40 * 5 and (query[top] == np.repeat(np.arange(40), 5)).all()
    floors = scores[top][4::5] - 1e-9
    again = [s.best(*asked, floors, 5) for s in shards]
    query, ids, scores = (np.concatenate(x) for x in zip(*again))
    assert len(query) < 1.1 * 40 * 5
    kept = bm25.first_of_each(query, ids, scores, 5)
    assert (ids[kept] == np.concatenate([f[1] for f in found])[top]).all()


def test_bm25_shares_look_ups_and_keeps_scores_that_single_precision_cannot_tell_apart():
    """Terms of all queries are looked up once; sums in single precision only rule rows out, so nearly equal rows keep their order."""
    rng = np.random.default_rng(3)
    words = [[f"{lang}{i}" for i in range(60)] for lang in "ab"]
    texts = [" ".join(rng.choice(words[i % 2], rng.integers(1, 40))) for i in range(300)]
    # Long rows that differ in their length by one word of thousands.
    texts += ["a1 a2 a3 " + "z " * (20_000 + i) for i in range(30)]
    rows = pd.DataFrame({"id": range(330), "text": texts, "shard": 0})
    shard = bm25.Shard(next(bm25.build_shard(rows).itertuples()), 30.0)
    asked = [np.unique(bm25.term_hashes(t)) for t in [*texts[:60], "a1 a2 a3", "nowhere", ""]]
    terms, sizes = np.concatenate(asked), np.array([len(t) for t in asked])
    idf = 1.0 + (terms % 97).astype(float) / 97
    counts = [dict(zip(*np.unique(bm25.term_hashes(t), return_counts=True))) for t in texts]
    starts = np.cumsum(sizes) - sizes
    for k in (3, 40):
        want = []
        for q, (start, size) in enumerate(zip(starts, sizes)):
            scores = []
            for i, have in enumerate(counts):
                norm = bm25.K1 * (1 - bm25.B + bm25.B * sum(have.values()) / 30.0)
                score = sum(idf[j] * have[terms[j]] * (bm25.K1 + 1) / (have[terms[j]] + norm) for j in range(start, start + size) if terms[j] in have)
                if score > 0:
                    scores.append((-round(score, 9), i))
            want += [(q, i) for _, i in sorted(scores)[:k]]
        distinct = np.unique(terms, return_inverse=True)
        query, ids, scores = shard.best(terms, idf, sizes, np.zeros(len(sizes)), k, distinct)
        at = bm25.first_of_each(query, ids, scores, k)
        assert list(zip(query[at], ids[at])) == want
        # With the k-th scores as floors the same rows come back.
        floors = np.zeros(len(sizes))
        for q in range(len(sizes)):
            if (query == q).sum() == k:
                floors[q] = scores[query == q].min() - 1e-9
        again = shard.best(terms, idf, sizes, floors, k)
        at = bm25.first_of_each(*again, k)
        assert list(zip(again[0][at], again[1][at])) == want
