"""N-gram Jaccard join: MinHash banding finds pairs, full n-gram sets verify them.

Equal texts are one class from the start.  Each distinct text gets minimum
hashes of its word n-grams; band and row counts are chosen for a target recall
at the threshold.  Texts that share a band hash meet
after one shuffle on it.  Each text of a bucket is first compared with a leader
drawn for the bucket; what is linked by then is one class.  Buckets that still
hold several classes are compared text by text in blocks of bounded size, and
only links that join two classes leave a block, so a group of n near copies
costs about n rows and no link between classes is lost.

Links run inside classes only.  To count them, every pair of distinct texts of a
class is compared by its full sets, once, block against block, and a block pair
returns one number per text.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm.ship import ship
from countloom.llm.store import stored
from countloom.operators.network import connected

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text that are hashed at a time.
PIECE = 1 << 20
#: Odd multiplier of the rolling combination of word hashes.
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Grams hashed at a time: the block of hashes stays in a core's cache.
BLOCK = 512
#: Texts of a bucket that one task compares with as many others, and set columns held at once while it does.
BUCKET_BLOCK, COLUMNS_AT_ONCE = 1024, 4096
#: Grams of a class that one block holds, about.
GRAMS_BLOCK = 1 << 20
#: Standard deviations of the sketch below the threshold's expectation at which a pair is given up.
SLACK = 6.0


def bands_for(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): as many rows as ``max_hashes`` allows while a pair at the threshold is found with probability ``recall``."""
    best = None
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no band and row counts reach the recall with so few hashes")
    return best


@functools.cache
def _letters() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, size=256, dtype=np.uint64)


@functools.lru_cache(4)
def _powers(count: int) -> np.ndarray:
    return np.cumprod(np.full(count, ODD, dtype=np.uint64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word in order: its bytes' table values, weighed by their place in the word.

    Works on pieces of about ``PIECE`` bytes that end at a blank, so long texts stay small.
    """
    data, start, out = text.encode(), 0, []
    while start < len(data):
        cut = BLANK.search(data, start + PIECE)
        end = cut.start() if cut else len(data)
        raw = np.frombuffer(data, dtype=np.uint8, count=end - start, offset=start)
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first = np.flatnonzero(first[inside])
        if len(first):
            letters = _letters()[raw[inside]]
            lengths = np.diff(first, append=len(letters))
            power = 1 << int(lengths.max()).bit_length()
            letters *= _powers(power)[np.arange(len(letters)) - np.repeat(first, lengths)]
            out.append(_mixed(np.add.reduceat(letters, first)))
        start = end
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the lower-cased word n-grams; a text of fewer words is one gram, a blank one none."""
    h = word_hashes(text.lower())
    if not len(h):
        return h
    size = min(n, len(h))
    grams = h[: len(h) - size + 1].copy()
    for i in range(1, size):
        grams = grams * ODD + h[i : len(h) - size + 1 + i]
    grams = np.sort(_mixed(grams))
    return grams[np.append(True, grams[1:] != grams[:-1])]


@functools.cache
def _coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(20240229).integers(1, 2**63, size=(2, count), dtype=np.uint64)
    return made[0] * np.uint64(2) + np.uint64(1), made[1]


def minimum_hashes(grams: np.ndarray, count: int) -> np.ndarray:
    """``count`` minimum hashes (32 bits each) of a set, worked through in blocks so that long texts stay small."""
    a, b = _coefficients(count)
    low = np.full(count, 2**64 - 1, dtype=np.uint64)
    room = np.empty((count, min(BLOCK, len(grams))), dtype=np.uint64)
    for start in range(0, len(grams), BLOCK):
        some = grams[start : start + BLOCK]
        hashed = np.multiply(a[:, None], some[None, :], out=room[:, : len(some)])
        hashed += b[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_hashes(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for row in low[: bands * rows].reshape(bands, rows).T:
        acc = (acc ^ row.astype(np.uint64)) * ODD
        acc ^= acc >> np.uint64(32)
    return acc.view(np.int64)


def _signer(n: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = bands * rows
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for batch in batches:
            sizes, hashes, bits, lengths = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                grams = shingles(text, n)
                sizes.append(len(grams))
                sketch = np.zeros(128, dtype=np.uint64)
                if len(grams):
                    low = minimum_hashes(grams, count)
                    hashes.append(band_hashes(low, bands, rows))
                    sketch[:count] = (low & np.uint32(1)).astype(np.uint64)
                lengths.append(lengths[-1] + (bands if len(grams) else 0))
                bits.append([(sketch[:64] * weights).sum(), (sketch[64:] * weights).sum()])
            packed = np.array(bits, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.int64)
            bands_column = pa.ListArray.from_arrays(pa.array(np.array(lengths, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int32()), pa.array(packed[:, 0]), pa.array(packed[:, 1]), bands_column],
                ["key", "n", "bits_a", "bits_b", "bands"],
            )

    return sign


def _gram_sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                found = [shingles(t, n).view(np.int64) for t in some.column("text").to_pylist()]
                lengths = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate(found) if found else np.empty(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [some.column("key"), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))], ["key", "grams"]
                )

    return sets


def text_key(text: str) -> Column:
    """The key of a text: equal texts share it; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
    recall: float = RECALL, max_hashes: int = MAX_HASHES, counted: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the near-duplicate join.

    ``members``: one row per distinct text: key, rep (smallest id that has the
    text), copies, class_key and class_id (smallest id of the class), n_links
    (how many other distinct texts of the class reach the threshold with it; left
    out without ``counted``).  ``links``: verified links enough to hold the classes
    together, as pairs of keys, and their similarity.  Null and empty texts are equal texts; blank texts have no grams
    and no links.  Repeated rows and ties need no order: everything is a function
    of the text.  Only the named columns are read.
    """
    ship(docs.sparkSession)
    bands, rows = bands_for(threshold, recall, max_hashes)
    texts = docs.select(
        F.col(id_col).alias("id"), text_key(text).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    signed = texts.select("key", "text").mapInArrow(
        _signer(n, bands, rows), "key binary, n int, bits_a long, bits_b long, bands array<long>"
    )
    signed = signed.groupBy("key").agg(*[F.first(c).alias(c) for c in ("n", "bits_a", "bits_b", "bands")])
    signed = stored(signed, "signed")
    entries = signed.select(F.explode("bands").alias("band"), "key", "n", "bits_a", "bits_b")

    # Buckets of one text are done.  In the others the leader is drawn by a hash of key and band, so that a large
    # group meets another leader in every band and falls into few classes at once.
    slim = F.struct(F.xxhash64("key", "band").alias("draw"), "key", "n", "bits_a", "bits_b")
    buckets = entries.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min(slim).alias("lead"))
    met = entries.join(buckets.where(F.col("size") > 1).drop("size"), "band")
    met = stored(met, "buckets")
    likely = _likely(threshold, bands * rows)
    first = met.where(F.col("key") != F.col("lead.key")).where(likely("n", "bits_a", "bits_b", "lead."))
    first = first.select(F.greatest("key", "lead.key").alias("a"), F.least("key", "lead.key").alias("b"))
    pairs = stored(first.distinct(), "pairs")
    wanted = met.select("key").distinct()
    sets = texts.select("key", "text").join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    sets = stored(sets.mapInArrow(_gram_sets(n), "key binary, grams array<long>"), "grams")
    links = stored(_verified(pairs, sets, threshold), "links")
    keys = wanted.withColumnRenamed("key", "node")
    classes = stored(connected(keys, links.select("a", "b"), []), "classes")

    # Buckets whose other texts still hold several classes, block against block: first the sketches pick the texts that
    # could link two classes, then those are compared by their full sets.  Both return texts or class-joining links,
    # never pairs.  The leader has met every text of its bucket already.
    known = met.where(F.col("key") != F.col("lead.key")).select("band", "key", "n", "bits_a", "bits_b").join(classes.select(F.col("node").alias("key"), "label"), "key")
    mixed = known.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    mixed = mixed.where(F.col("low") != F.col("high")).select("band", F.ceil(F.col("size") / BUCKET_BLOCK).cast("int").alias("blocks"))
    rest = _block_pairs(known.join(mixed, "band"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = rest.repartition(parts, "band", "one", "two").sortWithinPartitions("band", "one", "two")
    suspects = rest.mapInPandas(
        _suspects(threshold, bands * rows), "band long, one int, two int, key binary, label binary"
    )
    suspects = stored(suspects, "suspects")
    held = suspects.join(sets, "key").groupBy("band", "one", "two")
    last = held.applyInPandas(_joining_links(threshold), "a binary, b binary, similarity double")
    last = stored(last.groupBy("a", "b").agg(F.max("similarity").alias("similarity")), "links")
    links = links.unionByName(last)
    classes = stored(connected(keys, links.select("a", "b"), []), "classes")

    reps = texts.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    members = reps.join(classes.select(F.col("node").alias("key"), "label"), "key", "left")
    members = stored(members.withColumn("class_key", F.coalesce("label", "key")).drop("label"), "members")
    heads = members.groupBy("class_key").agg(F.min("rep").alias("class_id"))
    members = members.join(heads, "class_key")
    if not counted:
        return members.select("key", "rep", "copies", "class_key", "class_id"), links
    degree = _link_counts(classes.select(F.col("node").alias("key"), "label"), signed.select("key", "n"), sets, threshold)
    members = members.join(degree, "key", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    return members.select("key", "rep", "copies", "class_key", "class_id", "n_links"), links


def _link_counts(classes: DataFrame, sizes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(key, n_links) of the texts that share a class (key, label) with others.

    Two texts alone in a class are linked, or they would not be in it.  Larger
    classes are compared block against block, each pair of texts in one block pair.
    """
    blocks = F.ceil(F.greatest(F.col("texts") / BUCKET_BLOCK, F.col("grams") / GRAMS_BLOCK)).cast("int")
    groups = classes.join(sizes, "key").groupBy("label").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("grams"))
    groups = groups.where(F.col("texts") > 1).select("label", "texts", blocks.alias("blocks"))
    known = classes.join(groups, "label")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    met = known.where(F.col("texts") > 2).withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("label", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "key")
    found = met.join(sets, "key").groupBy("label", "one", "two").applyInPandas(_counted_links(threshold), "key binary, n_links long")
    pairs = known.where(F.col("texts") == 2).select("key", F.lit(1).cast("long").alias("n_links"))
    return stored(found.unionByName(pairs).groupBy("key").agg(F.sum("n_links").alias("n_links")), "degrees")


def _counted_links(threshold: float):
    """(key, links inside the block pair) of every text of a block pair."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        first, second = rows[rows["own"] == rows["one"]], rows[rows["own"] == rows["two"]]
        if not len(first) or not len(second):
            return pd.DataFrame({"key": [], "n_links": []})
        within = bool(rows["one"].iloc[0] == rows["two"].iloc[0])
        one = first["grams"].to_list()
        two = one if within else second["grams"].to_list()
        both = _overlaps(one, two)
        sizes = np.array([len(g) for g in two], dtype=np.float64)
        near = np.empty(both.shape, dtype=bool)
        for i, grams in enumerate(one):
            near[i] = both[i] >= threshold * (len(grams) + sizes - both[i]) - 1e-9
        if within:
            np.fill_diagonal(near, False)
            return pd.DataFrame({"key": first["key"], "n_links": near.sum(axis=1)})
        keys = pd.concat([first["key"], second["key"]], ignore_index=True)
        return pd.DataFrame({"key": keys, "n_links": np.concatenate([near.sum(axis=1), near.sum(axis=0)])})

    return count


def _overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many grams each set of ``one`` shares with each set of ``two``; of a list with itself, the diagonal is too small."""
    if one is two:
        names, times = np.unique(np.concatenate(one), return_counts=True)
        names = names[times > 1]
    else:
        names = np.intersect1d(np.concatenate(one), np.concatenate(two))

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate(sets)
        place = np.searchsorted(names, grams)
        keep = place < len(names)
        keep[keep] = names[place[keep]] == grams[keep]
        owner, place = np.repeat(np.arange(len(sets)), [len(g) for g in sets])[keep], place[keep]
        order = np.argsort(place, kind="stable")
        return owner[order], place[order]

    def columns(owner: np.ndarray, place: np.ndarray, count: int, start: int) -> np.ndarray:
        low, high = np.searchsorted(place, [start, start + COLUMNS_AT_ONCE])
        part = np.zeros((count, min(COLUMNS_AT_ONCE, len(names) - start)), dtype=np.float32)
        part[owner[low:high], place[low:high] - start] = 1.0
        return part

    both = np.zeros((len(one), len(two)), dtype=np.float32)
    of_one = placed(one)
    of_two = of_one if one is two else placed(two)
    for start in range(0, len(names), COLUMNS_AT_ONCE):
        left = columns(*of_one, len(one), start)
        both += left @ (left if one is two else columns(*of_two, len(two), start)).T
    return both


def _block_pairs(entries: DataFrame) -> DataFrame:
    """Each bucket entry once for every pair of blocks that its own block is part of; small buckets are one block."""
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    met = entries.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("band", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "key", "n", "bits_a", "bits_b", "label")


def _suspects(threshold: float, hashes: int):
    """Entries of a block pair that could link to an entry of another class, going by sizes and sketches.

    Rows come sorted by block pair, many pairs to a batch; the last one may go on in the next batch and is held back.
    """
    most = _most_bits(threshold, hashes)
    block = ["band", "one", "two"]

    def numbered(rows: pd.DataFrame) -> np.ndarray:
        of = rows[block].to_numpy()
        return np.append(0, np.cumsum((of[1:] != of[:-1]).any(axis=1)))

    def some(rows: pd.DataFrame, run: np.ndarray) -> pd.DataFrame:
        end = np.searchsorted(run, run, "right")
        label, n = pd.factorize(rows["label"])[0], rows["n"].to_numpy()
        bits_a, bits_b = rows["bits_a"].to_numpy(), rows["bits_b"].to_numpy()
        hit, at, step = np.zeros(len(rows), dtype=bool), np.arange(len(rows)), 0
        # Every entry against the one ``step`` rows further on, for all block pairs of the batch at once.
        while len(at):
            step += 1
            at = at[at + step < end[at]]
            x = at[label[at] != label[at + step]]
            y = x + step
            apart = np.bitwise_count((bits_a[x] ^ bits_a[y]).view(np.uint64)) + np.bitwise_count((bits_b[x] ^ bits_b[y]).view(np.uint64))
            near = (apart <= most) & (np.minimum(n[x], n[y]) >= np.maximum(n[x], n[y]) * threshold - 1e-9)
            hit[x[near]] = True
            hit[y[near]] = True
        return rows.loc[hit, [*block, "key", "label"]]

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            run = numbered(rows)
            done = int(np.searchsorted(run, run[-1]))
            yield some(rows.iloc[:done], run[:done])
            held = rows.iloc[done:].reset_index(drop=True)
        if held is not None:
            yield some(held, numbered(held))

    return pick


def _joining_links(threshold: float):
    """Verified links of a block pair that each join two classes; once joined, two classes need no further link."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key").reset_index(drop=True)
        sizes = np.array([len(g) for g in rows["grams"]], dtype=np.float64)
        grams = np.concatenate(rows["grams"].to_list())
        owner = np.repeat(np.arange(len(rows)), sizes.astype(np.int64))
        names, place, times = np.unique(grams, return_inverse=True, return_counts=True)
        shared = times > 1
        number = np.cumsum(shared) - 1
        keep = shared[place]
        owner, place = owner[keep], number[place[keep]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        both = np.zeros((len(rows), len(rows)), dtype=np.float32)
        for start in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
            low, high = np.searchsorted(place, [start, start + COLUMNS_AT_ONCE])
            part = np.zeros((len(rows), COLUMNS_AT_ONCE), dtype=np.float32)
            part[owner[low:high], place[low:high] - start] = 1.0
            both += part @ part.T
        parent = list(range(len(rows)))
        group = pd.factorize(rows["label"])[0]
        head: dict[int, int] = {}
        for i, g in enumerate(group):
            parent[i] = head.setdefault(g, i)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for i in range(len(rows)):
            union = sizes[i] + sizes - both[i]
            for j in np.flatnonzero((both[i] >= threshold * union - 1e-9) & (group != group[i])):
                x, y = root(i), root(int(j))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a, b = max(i, int(j)), min(i, int(j))
                    out.append((rows["key"][a], rows["key"][b], float(both[i][j] / union[j])))
        return pd.DataFrame(out, columns=["a", "b", "similarity"])

    return settle


def _most_bits(threshold: float, hashes: int) -> int:
    """How many sketch bits may differ at the threshold, slack included."""
    apart = (1 - threshold) / 2
    return math.ceil(hashes * apart + SLACK * math.sqrt(hashes * apart * (1 - apart)))


def _likely(threshold: float, hashes: int):
    """Condition on two sketches: sizes allow the threshold, and differing bits are not above what it lets expect plus slack."""
    most = _most_bits(threshold, hashes)

    def condition(n: str, a: str, b: str, other: str) -> Column:
        x, y = F.col(n), F.col(f"{other}{n}")
        bits = F.bit_count(F.col(a).bitwiseXOR(F.col(f"{other}{a}"))) + F.bit_count(F.col(b).bitwiseXOR(F.col(f"{other}{b}")))
        return (F.least(x, y) >= F.greatest(x, y) * F.lit(threshold) - 1e-9) & (bits <= most)

    return condition


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose full n-gram sets reach the threshold."""
    one = pairs.join(sets.select(F.col("key").alias("b"), F.col("grams").alias("of_b")), "b")
    both = one.join(sets.select(F.col("key").alias("a"), F.col("grams").alias("of_a")), "a")
    shared = both.select("a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("s"), (F.size("of_a") + F.size("of_b")).alias("t"))
    value = F.col("s") / (F.col("t") - F.col("s"))
    return shared.where(F.col("s") >= F.lit(threshold) * (F.col("t") - F.col("s")) - 1e-9).select("a", "b", value.alias("similarity"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links (other distinct texts at the threshold), copies (rows with the same text)."""
    members, _ = jaccard_classes(docs, id_col, text, **settings)
    rows = docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"))
    joined = rows.join(members.select("key", "class_id", "n_links", "copies"), "key")
    return joined.select(F.col("id").alias(id_col), "class_id", "n_links", "copies")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the row with the smallest id (one of them, if rows repeat)."""
    members, _ = jaccard_classes(docs, id_col, text, counted=False, **settings)
    keepers = members.where(F.col("rep").eqNullSafe(F.col("class_id"))).groupBy("class_key").agg(
        F.min("key").alias("_key"), F.first("class_id").alias("_rep")
    )
    keyed = docs.withColumn("_key", text_key(text))
    stay = keyed.join(keepers.select("_key", "_rep"), "_key").where(F.col(id_col).eqNullSafe(F.col("_rep")))
    return stay.dropDuplicates(["_key"]).drop("_key", "_rep")
