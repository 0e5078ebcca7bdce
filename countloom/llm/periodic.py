"""Periodic runs of words: a suffix automaton read online, its suffix links kept in a link-cut tree.

The automaton of the words read so far holds each different factor once, and the
path from the newest state to the root holds all suffixes.  The tree paints every
state with the last word at which its factors ended; a path falls into few
segments of one colour.  When word i is appended, its path is walked segment by
segment and repainted with i.  A segment that was painted d words earlier and
whose longest factor has L >= d words says that the L words before i and those
before i - d are equal: the squares of period d that end at i.  The longest such
stretch has L + d words; if word i + 1 does not go on with the period, it is a
run.  No shorter period fits it, since its last L words would then have been
painted later than i - d.

Only stretches that can hold a run go through the automaton: inside a run of
period q, the five-word windows from word q + 5 of the run on have all been seen
at most q words earlier, so whatever lacks such a chain of near recurrences holds
none (``windows``).  The bound is exact; hashes of windows can only add stretches.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from countloom.llm.ship import ship

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words of a window whose recurrences are looked for: the shortest run, six words of period 1, repeats five.
GRAM = 5
#: Words that are searched for recurrences at a time.
CHUNK = 200_000
#: Multiplier of the window hashes; any odd number would do.
FACTOR = 0x9E3779B97F4A7C15
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RESULT = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def runs_of(words: list[int], after: int = -1, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the numbers ``words``; ``after`` is the number that follows them, -1 for none.

    Takes time in n log n turns of the tree and about a hundred bytes a word.
    """
    n = len(words)
    size = 2 * n + 2
    blank = array("i", [-1]) * size
    first_word, first_to, link, up, left, right = (array("i", blank) for _ in range(6))
    length, colour = array("i", bytes(4 * size)), array("i", blank)
    more: dict[int, dict[int, int]] = {}
    out: list[tuple[int, int, int]] = []

    def splay(x: int) -> None:
        """Makes x the root of its segment's tree, and the keeper of its colour."""
        p = up[x]
        while p >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            if inner:
                if (left[g] == p) == (left[p] == x):
                    turn(p, g)
                else:
                    turn(x, p)
                    p = g
            turn(x, p)
            p = up[x]

    def turn(x: int, p: int) -> None:
        g = up[p]
        if g >= 0 and left[g] == p:
            left[g] = x
        elif g >= 0 and right[g] == p:
            right[g] = x
        else:
            colour[x] = colour[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b >= 0:
            up[b] = p
        up[p], up[x] = x, g

    states, last = 1, 0
    for i in range(n):
        w = words[i]
        new = states
        states += 1
        length[new] = length[last] + 1
        p, q = last, -1
        # Add the new transition to every suffix that lacks it.
        while p >= 0:
            if first_word[p] == w:
                q = first_to[p]
            elif p in more:
                q = more[p].get(w, -1)
            if q >= 0:
                break
            if first_word[p] < 0:
                first_word[p], first_to[p] = w, new
            else:
                more.setdefault(p, {})[w] = new
            p = link[p]
        if p < 0:
            link[new] = up[new] = 0
        elif length[q] == length[p] + 1:
            link[new] = up[new] = q
        else:
            copy = states
            states += 1
            length[copy] = length[p] + 1
            first_word[copy], first_to[copy] = first_word[q], first_to[q]
            if q in more:
                more[copy] = dict(more[q])
            while p >= 0:
                if first_word[p] == w:
                    if first_to[p] != q:
                        break
                    first_to[p] = copy
                else:
                    if more[p].get(w) != q:
                        break
                    more[p][w] = copy
                p = link[p]
            link[copy], link[q] = link[q], copy
            link[new] = up[new] = copy
            # The copy stands right above q: same segment, same colour.
            splay(q)
            above = left[q]
            left[copy] = above
            if above >= 0:
                up[above] = copy
            left[q], up[copy] = copy, q
        last = new
        # Walk the segments from the new state to the root, read them and paint the whole path.
        follows = words[i + 1] if i + 1 < n else after
        x, below = new, -1
        while x >= 0:
            splay(x)
            if x != new:
                d, longest = i - colour[x], length[x]
                if longest >= d and colour[x] >= 0:
                    whole = longest + d
                    if whole >= min_length and whole >= min_exponent * d and follows != words[i + 1 - d]:
                        out.append((i + 1 - whole, whole, d))
            b = right[x]
            if b >= 0:
                colour[b] = colour[x]
            right[x] = below
            below, x = x, up[x]
        colour[below] = i
        splay(new)
    return out


def windows(ids: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [from, to) of the words ``ids`` of several texts (``owner``, ascending) outside which no run lies.

    A run of period q and n words leaves n - q - 4 neighbouring windows that recur
    within q words, and n >= 4 q: a chain of m recurrences holds periods up to
    (m + 4) / 3 only.  Recurrences farther apart than that go, until none is left to go.
    """
    n = len(ids)
    if n < MIN_LENGTH:
        return []
    hashed = ids.astype(np.uint64)
    key = np.zeros(n - GRAM + 1, dtype=np.uint64)
    for k in range(GRAM):
        key = key * np.uint64(FACTOR) + hashed[k : n - GRAM + 1 + k] + np.uint64(1)
    inside = owner[GRAM - 1 :] == owner[: n - GRAM + 1]
    key = (key + owner[: n - GRAM + 1].astype(np.uint64)) * np.uint64(FACTOR)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    back = np.zeros(len(key), dtype=np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    back[~inside] = 0
    at = np.flatnonzero(back)
    while len(at):
        chain = np.concatenate([[0], np.cumsum((np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]]))])
        bound = (np.bincount(chain) + 4) // 3
        keep = back[at] <= bound[chain]
        if keep.all():
            break
        at = at[keep]
    if not len(at):
        return []
    first = np.flatnonzero(np.append(True, np.diff(chain) > 0))
    ends = at[np.append(first[1:], len(at)) - 1] + GRAM
    starts = np.maximum(at[first] - bound, np.searchsorted(owner, owner[at[first]]))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return merged


def runs_of_texts(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = [len(t) for t in texts]
    names: dict[str, int] = {}
    number = names.setdefault
    ids = np.fromiter((number(w, len(names)) for t in texts for w in t), dtype=np.int64, count=sum(sizes))
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in windows(ids, owner):
        text = owner[a]
        after = int(ids[b]) if b < begin[text + 1] else -1
        low = int(a - begin[text])
        out[text] += [(low + s, length, period) for s, length, period in runs_of(ids[a:b].tolist(), after)]
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that lie in a run after its first period, joined by one space."""
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return " ".join(w for w, k in zip(words, keep) if k)


def runs_frame(texts: pd.Series) -> pd.DataFrame:
    """Runs and collapsed text of each text; the latter is null where no run is found."""
    runs, collapsed = [], []
    held: list[list[str]] = []

    def flush() -> None:
        for words, found in zip(held, runs_of_texts(held)):
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            collapsed.append(collapse(words, found) if found else None)
        held.clear()

    size = 0
    for text in texts:
        words = WORD.findall(text) if text else []
        if held and size + len(words) > CHUNK:
            flush()
            size = 0
        held.append(words)
        size += len(words)
    flush()
    return pd.DataFrame({"runs": runs, "collapsed": collapsed})


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``runs`` (start, length, period; by start, then period) and ``collapsed`` to every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of at
    least six words and four smallest periods that no neighbouring word extends;
    all are returned, however many overlap.  ``collapsed`` holds the words that lie
    in no run after its first period, joined by one space.  Null, empty and blank
    texts have no runs and an empty ``collapsed``; repeated rows stay; columns
    called runs or collapsed are replaced.  A text is worked on by one task, which
    needs about a hundred bytes for each word of its periodic stretches.
    """
    ship(docs.sparkSession)
    find = pandas_udf(runs_frame, RESULT)
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c not in ("runs", "collapsed")], find(F.col(text)).alias("_found"))
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return rows.withColumns(
        {"runs": F.col("_found.runs"), "collapsed": F.coalesce("_found.collapsed", F.trim(plain))}
    ).drop("_found")


def repeated_tail(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Replaces ``text`` by its words joined by one space; every tenth text, by the crc32 of its id, gets a periodic tail.

    With h = crc32(id), g = floor(h / 10) and n words, the words from a = g % n on
    become those at a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)).
    Texts without words become empty; rows without an id keep their words.
    """
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.withColumns({"_w": words, "_h": h}).withColumns({"_n": F.size("_w").cast("bigint"), "_g": F.expr("_h div 10")})
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    tail = F.expr("transform(_w, (w, i) -> CASE WHEN i < _a THEN w ELSE get(_w, CAST(_a + (i - _a) % _p AS INT)) END)")
    made = F.when((F.col("_h") % 10 == 0) & (F.col("_n") > 0), tail).otherwise(F.col("_w"))
    return rows.withColumn(text, F.array_join(made, " ")).drop("_w", "_h", "_n", "_g", "_a", "_p")


def longest(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period.  Null where there is none."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(ranked)
    return F.when(F.size(runs) > 0, F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")))
