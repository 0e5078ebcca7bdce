"""Each operator against a brute-force version on small tables, and on odd rows and empty tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from countloom.llm import bm25, bpe, hilbert, licenses, mixing, ngram_join, quality_classifier, quality_rules, token_counts, vocab
from countloom.llm.host_reputation import filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def content(name):
    with open(P.path(name), "rb") as f:
        return f.read()


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_counts(spark, odd_docs):
    texts = ["a b c a b c a b", "x\nx\n\nx y", "# $ a | <b> é É 漢", "a a a a a", "\x0b a\x0c b\r c "]
    extra = spark.createDataFrame([(100 + i, t, "en", "a", 0, "", "", "") for i, t in enumerate(texts)], odd_docs.schema)
    rows = quality_rules.quality_rules(odd_docs.unionByName(extra)).collect()
    assert len(rows) == 16
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == plain_rules(r["text"]), r["text"]
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.quality_rules(odd_docs.limit(0)).count() == 0


def test_bpe_tree_equals_library():
    data = content("word_bpe_49k.json")
    assert vocab.agrees(data)
    codec = bpe.Codec(data, True)
    draw, leaf, long_word = random.Random(5), bpe.LEAF, bpe.LONG_WORD
    bits = ["the", "'s", "'re", "'", "!!", "é", "Σ", "İ", "a", " ", "  ", "\n", "12", "<|endoftext|>", "ß", "漢字", "'ll", "x" * 30]
    try:
        bpe.LONG_WORD = 8
        for turn in range(600):
            text = "".join(draw.choice(bits) for _ in range(60)) if turn % 2 else draw.choice(["a", "ab", "=-"]) * 90
            bpe.LEAF = draw.choice([3, 7, 16])
            ids = []
            rows = list(codec.cut(text))
            for segment in dict.fromkeys(r[0] for r in rows):
                some = [r for r in rows if r[0] == segment]
                if some[0][2] >= 0:
                    ids.append(some[0][2])
                else:
                    parts = [codec.leaf(t, low) for _, low, _, t in some]
                    ids += [i for word in codec.tree(parts, "".join(r[3] for r in some)).ids for i in word]
            assert ids == codec.library.encode(text, add_special_tokens=False).ids, text
    finally:
        bpe.LEAF, bpe.LONG_WORD = leaf, long_word


def test_bpe_and_counts_on_odd_rows(odd_docs):
    words, letters = vocab.tokenizer(content("word_bpe_49k.json")), vocab.tokenizer(content("byte_bpe_50k.json"))
    texts = Counter((r["doc_id"], r["text"]) for r in odd_docs.collect())
    made = bpe.encode_decode(odd_docs, P.path("word_bpe_49k.json")).collect()
    expected = Counter()
    for (i, t), n in texts.items():
        ids = words.encode(t or "", add_special_tokens=False).ids
        expected[(i, tuple(ids), words.decode(ids, skip_special_tokens=False))] += n
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in made) == expected
    counts = token_counts.token_counts(odd_docs, P.path("byte_bpe_50k.json")).collect()
    want = Counter({(i, len((t or "").encode()), len(letters.encode(t or "", add_special_tokens=False).ids)): 0 for i, t in texts})
    for (i, t), n in texts.items():
        want[(i, len((t or "").encode()), len(letters.encode(t or "", add_special_tokens=False).ids))] += n
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in counts) == want


def test_token_counts_do_not_depend_on_the_table(odd_docs, monkeypatch):
    found, rows = token_counts.frequent, []
    for size in (0, 5, token_counts.TABLE_SIZE):
        monkeypatch.setattr(token_counts, "frequent", lambda *args, size=size: found(*args)[:size])
        rows.append(Counter(token_counts.token_counts(odd_docs, P.path("byte_bpe_50k.json")).collect()))
    assert rows[0] == rows[1] == rows[2] and sum(rows[0].values()) == 11


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_hilbert_shards(odd_docs, law):
    table = hilbert.curve_table(2, 3)
    cells = sorted(range(64), key=table.__getitem__)
    assert sorted(table) == list(range(64))
    assert all(abs((a >> 3) - (b >> 3)) + abs((a & 7) - (b & 7)) == 1 for a, b in zip(cells, cells[1:]))
    rows = hilbert.hilbert_shards(odd_docs, 3, law).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    if law == "rows":
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert hilbert.hilbert_shards(odd_docs.limit(0), 3, law).count() == 0


def test_mixing(odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 11 and all(r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["source"], r["source_size"], r["target"]), []).append(r["taken"])
    assert all(sum(t) == int(k[2]) for k, t in by.items())
    sizes, order = {k[0]: k[1] for k in by}, sorted((k[0] for k in by), key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, left, full = {}, 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        share = (left - sum(2 * sizes[s] for s in full)) / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if share * weights[s] > 2 * sizes[s]}
        if not over:
            want = {s: 2 * sizes[s] if s in full else share * weights[s] for s in order}
            break
        full |= over
    assert all(abs(k[2] - want[k[0]]) < 1e-6 for k in by)
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_mixing_places_every_pass(odd_docs):
    """Positions against a walk along each source's stream, word for word of the target."""
    rows = mixing.mix(odd_docs).collect()
    steps = [i / 200_000 for i in range(200_001)]
    order = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    for source in order:
        knots = mixing.SCHEDULES[order.index(source) % 3]
        weight = lambda t: next(w0 + (w1 - w0) * (t - t0) / (t1 - t0) for (t0, w0), (t1, w1) in zip(knots, knots[1:]) if t <= t1)
        demand, total = [0.0], 0.0
        for a, b in zip(steps, steps[1:]):
            total += (weight(a) + weight(b)) / 2 * (b - a)
            demand.append(total)
        mine = [r for r in rows if r["source"] == source]
        assert all(len(r["positions"]) == r["passes"] and r["positions"] == sorted(r["positions"]) for r in mine)
        # In order of position, takes follow each other along the demand.
        events = sorted((p, i, k) for i, r in enumerate(mine) for k, p in enumerate(r["positions"]))
        done, target = 0, mine[0]["target"]
        for p, i, k in events:
            at = demand[min(len(steps) - 1, round(p * 200_000))] / total
            assert abs(at - done / target) < 1e-4
            size, taken = mine[i]["size"], mine[i]["taken"]
            done += min(size, taken - size * k)
        assert done == int(target)


def test_near_duplicates(spark, odd_docs):
    draw = random.Random(2)
    base = [f"w{draw.randint(0, 400)}" for _ in range(150)]
    rows, words = [], list(base)
    for i in range(40):  # a chain of edits: neighbours are close, ends are not
        rows.append((i, " ".join(words)))
        words[draw.randrange(150)] = f"v{i}"
    rows += [(100 + i, " ".join(f"z{draw.randint(0, 9999)}" for _ in range(80))) for i in range(10)]
    made = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    mine = {r["doc_id"]: r["class_id"] for r in made.collect()}
    sets = {i: set(ngram_join.shingles(t, 5).tolist()) for i, t in rows}
    label = {i: i for i, _ in rows}
    for _ in rows:
        for i in sets:
            for j in sets:
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert mine == label
    odd = ngram_join.near_duplicates(odd_docs).collect()
    found = {r["doc_id"]: r["class_id"] for r in odd}
    assert len(odd) == 11 and found[2] == found[1] == 1 and found[7] == found[6] == found[5] == 5
    assert ngram_join.one_of_each(odd_docs).count() == 7
    assert ngram_join.near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 20])
def test_link_counts_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", block)
    draw, rows = random.Random(8), []
    for group, size in enumerate([70, 40, 9, 3, 2, 1]):  # mutually near, then a chain, then small groups
        words = [f"g{group}w{draw.randint(0, 400)}" for _ in range(150)]
        for i in range(size):
            some = words if group == 1 else list(words)
            some[draw.randrange(150)] = f"v{i}"
            rows.append((len(rows), " ".join(some)))
    rows += [(len(rows), rows[0][1]), (len(rows) + 1, ""), (len(rows) + 2, " ")]
    made = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["n_links"] for r in made.collect()}
    sets = {t: set(ngram_join.shingles(t, 5).tolist()) for _, t in rows}
    near = lambda x, y: x != y and sets[x] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])
    assert got == {i: sum(bool(near(t, u)) for u in sets) for i, t in rows}


@pytest.mark.parametrize("piece", [1, 5, 1 << 20])
def test_shingles_equal_plain_sets(monkeypatch, piece):
    monkeypatch.setattr(ngram_join, "PIECE", piece)
    draw, seen = random.Random(1), {}
    for _ in range(400):
        text = "".join(draw.choice(["a", "b", "é", "漢", " ", "\n", "\x0b", " ", "A", "x1"]) for _ in range(draw.randint(0, 60)))
        words = WORD.findall(text.lower())
        size = min(5, len(words))
        assert len(ngram_join.shingles(text, 5)) == len({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else ())
        for word, value in zip(words, ngram_join.word_hashes(text.lower()), strict=True):
            assert seen.setdefault(word, int(value)) == int(value)
    assert len(set(seen.values())) == len(seen)


def test_suspects_equal_all_pairs_of_a_block():
    draw, rows = random.Random(3), []
    for band in range(6):
        for i in range(draw.choice([2, 3, 30])):
            rows.append((band, 0, 0, b"%d-%d" % (band, i), draw.choice([9, 10, 40]), draw.getrandbits(4), draw.getrandbits(40) - 2**39, b"%d" % draw.randint(0, 3)))
    table = pd.DataFrame(rows, columns=["band", "one", "two", "key", "n", "bits_a", "bits_b", "label"])
    most, want = ngram_join._most_bits(0.8, 60), set()
    for p in rows:
        for q in rows:
            apart = sum(((p[c] ^ q[c]) & (2**64 - 1)).bit_count() for c in (5, 6))
            if p[0] == q[0] and p[7] != q[7] and apart <= most and min(p[4], q[4]) >= 0.8 * max(p[4], q[4]) - 1e-9:
                want.add(p[3])
    for step in (1, 7, 1000):
        batches = [table.iloc[i : i + step] for i in range(0, len(table), step)]
        found = pd.concat(list(ngram_join._suspects(0.8, 60)(iter(batches))))
        assert want and sorted(found["key"]) == sorted(want)


def test_classifier_ranks_held_out_rows(spark):
    draw = random.Random(4)
    good = [" ".join(draw.choice(["the", "of", "river", "stone", "walks", "and"]) for _ in range(80)) + "." for _ in range(60)]
    bad = [" ".join(draw.choice(["BUY!!", "##", "$$$", "now***"]) for _ in range(80)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels.where("doc_id % 3 != 0"))
    rows = quality_classifier.score(docs.where("doc_id % 3 = 0"), model).collect()
    assert all(r["predicted"] == (r["doc_id"] < 60) and 0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.score(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), model).count() == 2


def test_classifier_cut_keeps_the_share_of_all_labels(spark):
    draw = random.Random(9)
    words = [["the", "of", "river", "stone", "walks", "and"], ["BUY!!", "##", "$$$", "now***"]]
    mixed = lambda odd: " ".join(draw.choice(words[draw.random() < odd]) for _ in range(80))
    rows = [(i, mixed(draw.uniform(0.0, 0.6)), 1) for i in range(540)] + [(540 + i, mixed(draw.uniform(0.3, 0.9)), 0) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000 + i, 0) for i in range(20)], "doc_id long, quality int")
    shares = []
    for most in (10_000, 120):  # all labelled rows, then the good ones thinned to about a fifth
        model = quality_classifier.fit(docs, labels, max_rows=most)
        shares.append(sum(1 - r["predicted"] for r in quality_classifier.score(docs, model).collect()) / len(rows))
    assert abs(shares[0] - 0.1) < 0.01 and abs(shares[1] - 0.1) < 0.05


def test_quality_classifier_moves_features_not_texts(spark):
    rows = [(i, ("the cat and the dog of a house " if i % 3 else f"x{i} #$ zz@@ ") * (3 + i % 5)) for i in range(90)]
    docs = spark.createDataFrame([*rows, (None, "the end"), (200, None)], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 0).otherwise(1).alias("quality"))
    learned = labels.selectExpr("doc_id _id", "quality _label").where("_id is not null")
    plan = quality_classifier.described(docs, learned, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("regexp")  # features are made below the join
    made = quality_classifier.features(docs).drop("text")
    one, two = quality_classifier.fit(docs, labels), quality_classifier.fit(made, labels, text=None)
    assert np.allclose(one.weights, two.weights, atol=1e-6) and abs(one.cut - two.cut) < 1e-6
    first = quality_classifier.score(docs, one).drop("text").collect()
    again = quality_classifier.score(made, one, text=None)
    assert again.columns == ["doc_id", "score", "predicted"] and sorted(map(str, again.collect())) == sorted(map(str, first))


def test_quality_classifier_learns_from_every_label(spark):
    """More good rows than the bound of old (20,000 of a kind): one more labelled row is one more learned row."""
    kinds = F.when(F.col("id") % 8 == 0, F.lit("# $ & | <a> 12 34")).otherwise(F.lit("the house and the garden of it"))
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat(kinds, F.lit(" w"), F.col("id") % 97).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 8 == 0, 0).otherwise(1).alias("quality"))
    sizes = []

    def counted(rows, label, good, bad):
        sizes.append((good, bad, rows.select("_seat").distinct().count()))
        return pairs(rows, label, good, bad)

    pairs, quality_classifier.preference_pairs = quality_classifier.preference_pairs, counted
    try:
        quality_classifier.fit(docs, labels)
    finally:
        quality_classifier.preference_pairs = pairs
    assert sizes == [(21_000, 3_000, 21_000)]


def test_url_rules_and_reputation(spark):
    urls = ["HTTP://www.Example.com/en/1?x", "http://example.com/en/2", "http://a.net/fr/", "http://com", None, "no-url", "x://ok.org/a#b", "x://bad.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    seen = spark.createDataFrame([("bad.org", 1)] * 60 + [("ok.org", 0)] * 60, "host string, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, seen).collect()}
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1] == ("example.com", "/en/2", "example.com/en/", "block")
    assert got[2] == ("a.net", "/fr/", "net/fr/", "block")
    assert got[3] == ("com", "", None, "allow") and got[4] == got[5] == ("", "", None, "allow")
    assert got[6] == ("ok.org", "/a", None, "allow") and got[7] == ("bad.org", "/", None, "block")


def test_unseen_hosts_take_the_prior_above(spark):
    """A host without outcomes is judged by its registered domain, else its suffix, else all."""
    seen = [(f"s{i}.spam.co.uk", 1) for i in range(30) for _ in range(5)] + [(f"s{i}.fine.co.uk", 0) for i in range(30) for _ in range(5)]
    seen += [(None, 1), ("s0.spam.co.uk", None)]
    outcomes = spark.createDataFrame(seen, "host string, bad int")
    urls = ["x://new.spam.co.uk/", "x://user@new.fine.co.uk:80/", "x://a.other.co.uk/", "x://a.b.zz/", "x:///", None, "x://s0.spam.co.uk/", "x://s0.spam.co.uk/"]
    pages = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(urls)], "page_id long, url string, host string, mean double")
    got = {r["page_id"]: r for r in filter_urls(pages, outcomes).collect()}
    assert [got[i]["bad_level"] for i in range(8)] == ["domain", "domain", "suffix", "top", None, None, "host", "host"]
    assert [got[i]["verdict"] for i in range(8)] == ["block", "allow", "allow", "allow", "allow", "allow", "block", "block"]
    assert got[0]["bad_mean"] > 0.8 > 0.2 > got[1]["bad_mean"] and 0.3 < got[2]["bad_mean"] < 0.7
    none = filter_urls(pages, outcomes.limit(0)).collect()
    assert len(none) == 8 and {r["verdict"] for r in none} == {"allow"}
    assert filter_urls(pages.limit(0), outcomes).count() == 0


def test_bm25_equals_full_scoring(spark):
    draw = random.Random(6)
    texts = {i: " ".join(draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 3) for _ in range(draw.randint(0, 40))) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    queries = docs.where("doc_id % 50 = 0").selectExpr("doc_id query_id", "text query_text")
    rows = bm25.search(docs, queries, 7, shard_rows=40).collect()
    words = {i: t.split() for i, t in texts.items()}
    mean = sum(map(len, words.values())) / len(words)
    df = Counter(w for t in words.values() for w in set(t))
    for q in range(0, 300, 50):
        scores = {}
        for i, t in words.items():
            tf = Counter(t)
            s = sum(np.log(1 + (300 - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / mean)) for w in set(words[q]) if tf[w])
            if s > 0:
                scores[i] = round(s, 9)
        best = sorted(scores, key=lambda i: (-scores[i], i))[:7]
        assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] == best


def test_license_inheritance(spark):
    files = [
        ("r/a/LICENSE", "Released under the MIT License."), ("r/a/b/x", "plain"), ("r/c", "nothing"),
        ("r/a/y", "text " * 50 + "\nLicensed under the Apache License, Version 2.0.\n"), (None, None), ("r/a/b/z", None),
    ]
    got = {r["path"]: (r["license"], r["origin"]) for r in licenses.license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["r/a/b/x"] == got["r/a/b/z"] == ("MIT", "inherited") and got["r/a/y"] == ("Apache-2.0", "own")
    assert got["r/c"] == (None, "none") and got[None] == (None, "none") and got["r/a/LICENSE"] == ("MIT", "own")


def test_licences_in_full_texts_headers_and_long_lines(spark):
    mit = next(t for n, t in licenses.TEXTS if n == "MIT").replace("(c)", "(c) 2024 Some Body\n\n").replace(". ", ".\n")
    filler = " ".join(f"word{i}" for i in range(60))
    files = [
        ("m/LICENSE", mit), ("m/src/x", "plain"), ("n/terms", mit), ("n/x", "plain"), ("s/a", "# SPDX-License-Identifier: MIT\ncode"),
        ("s/b", "// SPDX-License-Identifier: Apache-2.0"), ("s/c", "/* SPDX-License-Identifier: (mpl-2.0 OR Zlib) */"),
        ("l/a", f"{filler} Licensed under the Apache License, Version 2.0."), ("l/b", f"{filler} your driving license is old. {filler}"),
    ]
    got = {r["path"]: (r["license"], r["origin"]) for r in licenses.license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["m/LICENSE"] == got["n/terms"] == got["s/a"] == ("MIT", "own") and got["m/src/x"] == got["n/x"] == ("MIT", "inherited")
    assert got["s/b"] == got["l/a"] == ("Apache-2.0", "own") and got["s/c"] == ("mpl-2.0 OR Zlib", "own") and got["l/b"] == (None, "none")


def test_digest_columns(spark):
    from countloom.llm.queries import op2_bpe_tree

    sf = "/root/testdata/sf0.001"
    library = vocab.tokenizer(content("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op2_bpe_tree(spark, sf).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_classifier_without_both_kinds(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (5, 1)], "doc_id long, quality int")
    for docs, some, want in ((odd_docs, labels.limit(0), 1), (odd_docs, labels, 1), (odd_docs, labels.selectExpr("doc_id", "0 quality"), 0), (odd_docs.limit(0), labels, 1)):
        model = quality_classifier.fit(docs, some)
        assert {r["predicted"] for r in quality_classifier.score(odd_docs, model).collect()} == {want}
        assert quality_classifier.score(odd_docs.limit(0), model).count() == 0


def test_bm25_odd_rows_and_ties(spark, odd_docs):
    queries = spark.createDataFrame([(1, "t7 t9"), (2, None), (None, "t1"), (3, " "), (4, "nothing-like-it")], "query_id long, query_text string")
    rows = bm25.search(odd_docs, queries, 3).collect()
    assert {r["query_id"] for r in rows} == {1}
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [5, 6, 7]
    assert bm25.search(odd_docs.limit(0), queries, 3).count() == 0 and bm25.search(odd_docs, queries.limit(0), 3).count() == 0
    same = spark.createDataFrame([(i, "a b c") for i in range(40)], "doc_id long, text string")
    tied = bm25.search(same, queries.selectExpr("1L query_id", "'a b' query_text").limit(1), 5, shard_rows=7).collect()
    assert sorted(r["doc_id"] for r in tied) == [0, 1, 2, 3, 4]
