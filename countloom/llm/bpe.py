"""BPE encoding and decoding, long texts by tree concatenation.

A long text is halved until its parts are short; the parts are encoded in
parallel tasks and joined again, pair by pair, up the tree.  A cut may fall
anywhere.  Around each join a window is encoded anew and grown until it begins
and ends with what the two sides already have; what lies outside the window then
stands.  Two kinds of window do that:

* across words: pre-tokens are found by scanning forward, so the left side holds
  up to the last few characters before the cut, and once the window's scan meets
  the start of a pre-token of the right side, both scans go on alike;
* inside a word that no rule splits: tokens of byte-pair encoding stand as soon
  as each neighbouring pair does, so the window needs to agree with one token at
  either end.

Short texts, the bulk, are encoded word by word through a worker's cache.
"""

from __future__ import annotations

import gc
import json
import uuid
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.llm import vocab
from countloom.llm.ship import ship

LEAF = 32_768
CACHE_SIZE = 150_000
#: Words above this length are joined from the tokens of their parts; shorter ones are encoded at once.
LONG_WORD = 512
#: No rule of a splitting pattern looks further ahead than this.
LOOK_AHEAD = 3
ROWS_AT_ONCE = 256

_worker: dict = {}


class Part(NamedTuple):
    """Encoded stretch [low, high) of a text: pre-token spans, the ids of each, and of the last one as if its word went on."""

    low: int
    high: int
    starts: list[int]
    ends: list[int]
    ids: list[tuple[int, ...]]
    open_tail: tuple[int, ...]


class Codec:
    """Encoder and decoder of one word-level BPE file."""

    def __init__(self, content: bytes, quick: bool) -> None:
        self.quick = vocab.quick_encoder(content, r"(?s).+") if quick else None
        spec = json.loads(content)
        bare = {"normalizer": None, "added_tokens": [], "truncation": None, "padding": None}
        letters = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.library = vocab.tokenizer(content)
        self.words = vocab.tokenizer(content, **bare, pre_tokenizer=letters)
        self.splits = vocab.tokenizer(content, **bare, pre_tokenizer=steps[0])
        self.open_words = vocab.tokenizer(
            content, **bare, pre_tokenizer=letters, model=spec["model"] | {"end_of_word_suffix": None}
        )
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.parts, self.special = vocab.special_pattern(content)
        self.tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.spelled = {b: c for c, b in vocab.byte_letters().items()}
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}

    # --- words

    def learn(self, words: list[str]) -> None:
        """Encode the words that the cache lacks: their ids and decoded text."""
        if len(self.known) > CACHE_SIZE:
            self.known.clear()
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if self.quick is not None and all(map(vocab.plain, fresh)):
            mark = vocab.MARK if self.suffix else ""
            found = [tuple(self.quick.encode_ordinary(w + mark)) for w in fresh]
        else:
            found = [tuple(e.ids) for e in self.words.encode_batch_fast(fresh, add_special_tokens=False)]
        for w, ids in zip(fresh, found):
            self.known[w] = ids, self.decode(ids)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Pre-tokens of a normalised text."""
        if vocab.plain(text):
            return [m.span() for m in self.pattern.finditer(text)]
        return [span for _, span in self.splits.pre_tokenizer.pre_tokenize_str(text)]

    def learn_chunks(self, chunks: set[str]) -> None:
        """Chunks between blanks of plain lower-case text; one of letters alone is a word."""
        if len(self.known) > CACHE_SIZE:
            self.known.clear()
        fresh = [c for c in chunks if c not in self.known]
        mixed = [(c, self.pattern.findall(c)) for c in fresh if not c.isalpha()]
        self.learn([c for c in fresh if c.isalpha()] + [w for _, words in mixed for w in words])
        for chunk, words in mixed:
            found = [self.known[w] for w in words]
            self.known[chunk] = tuple(chain.from_iterable([f[0] for f in found])), " ".join([f[1] for f in found])

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))

    def normal(self, text: str) -> str:
        return text.lower() if vocab.plain(text) else self.library.normalizer.normalize_str(text)

    def encode_many(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """Ids and decoded text of each short text."""
        plain = [not any(s in t for s in self.special) and vocab.plain(t) for t in texts]
        pieces = [t.lower().split() if p else () for t, p in zip(texts, plain)]
        self.learn_chunks(set().union(*map(set, pieces)) if pieces else set())
        out = []
        for text, simple, chunks in zip(texts, plain, pieces):
            if simple:
                found = list(map(self.known.__getitem__, chunks))
                out.append((list(chain.from_iterable([f[0] for f in found])), " ".join([f[1] for f in found])))
            else:
                ids = self.library.encode(text, add_special_tokens=False).ids
                out.append((ids, self.decode(ids)))
        return out

    # --- long texts

    def cut(self, text: str) -> Iterator[tuple[int, int, int, str]]:
        """(segment, start, special id or -1, text) of the leaves: segments lie between special strings, leaves halve segments."""
        for i, part in enumerate(self.parts.split(text) if self.parts else (text,)):
            if i % 2:
                yield i, 0, self.special[part], ""
            elif part:
                yield from ((i, low, -1, leaf) for low, leaf in halves(self.normal(part), 0))

    def leaf(self, text: str, low: int) -> Part:
        spans = self.spans(text)
        words = [text[a:b] for a, b in spans]
        self.learn([w for w in words if len(w) <= LONG_WORD])
        ids = [self.known[w][0] if len(w) <= LONG_WORD else self.closed(w) for w in words]
        tail = self.opened(words[-1]) if spans and spans[-1][1] == len(text) else ()
        return Part(low, low + len(text), [low + a for a, _ in spans], [low + b for _, b in spans], ids, tail)

    def closed(self, word: str) -> tuple[int, ...]:
        return tuple(self.words.encode(word, add_special_tokens=False).ids)

    def opened(self, word: str) -> tuple[int, ...]:
        return tuple(self.open_words.encode(word, add_special_tokens=False).ids)

    def join(self, left: Part, right: Part, text: str, base: int) -> Part:
        """The encoding of both stretches together; ``text`` starts at ``base``."""
        cut = right.low
        keep = len(left.starts)
        while keep and (left.ends[keep - 1] >= cut or left.starts[keep - 1] > cut - LOOK_AHEAD):
            keep -= 1
        begin = left.starts[keep] if keep < len(left.starts) else cut
        count = 2
        while True:
            whole = count >= len(right.starts)
            end = right.high if whole else right.ends[count - 1]
            spans = [(begin + a, begin + b) for a, b in self.spans(text[begin - base : end - base])]
            sure = len(spans)
            while not whole and sure and (spans[sure - 1][1] >= end or spans[sure - 1][0] > end - LOOK_AHEAD):
                sure -= 1
            known = {s: j for j, s in enumerate(right.starts[: count + 1])}
            meet = next((i for i in range(sure) if spans[i][0] >= cut and spans[i][0] in known), None)
            if meet is not None or whole:
                break
            count *= 2
        resume = known[spans[meet][0]] if meet is not None else len(right.starts)
        fresh = spans[:meet] if meet is not None else spans
        ids, tail = [], right.open_tail
        for a, b in fresh:
            word = text[a - base : b - base]
            grown = self._grown(left, right, a, b) if b - a > LONG_WORD else None
            ids.append(grown[0] if grown else self._one(word))
            if b == right.high:
                tail = grown[1] if grown else self.opened(word)
        if not right.starts and not fresh:
            tail = ()
        return Part(
            left.low,
            right.high,
            left.starts[:keep] + [a for a, _ in fresh] + right.starts[resume:],
            left.ends[:keep] + [b for _, b in fresh] + right.ends[resume:],
            left.ids[:keep] + ids + right.ids[resume:],
            tail,
        )

    def _one(self, word: str) -> tuple[int, ...]:
        if len(word) > LONG_WORD:
            return self.closed(word)
        self.learn([word])
        return self.known[word][0]

    def _grown(self, left: Part, right: Part, a: int, b: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """(closed, open) ids of a long word that is the last of the left and the first of the right side; None if it is not just that."""
        if not (left.starts and right.starts and left.starts[-1] == a and left.ends[-1] == right.starts[0] == right.low):
            return None
        if right.ends[0] != b:
            return None
        closed = self.join_word(left.open_tail, right.ids[0], True)
        return closed, self.join_word(left.open_tail, right.open_tail, False) if b == right.high else ()

    def join_word(self, left: tuple[int, ...], right: tuple[int, ...], closed: bool) -> tuple[int, ...]:
        """Ids of one word from those of its left part (left open) and its right part, by a growing window."""
        size = 4
        while True:
            i, j = min(size, len(left)), min(size, len(right))
            letters = "".join(map(self.tokens.__getitem__, left[len(left) - i :] + right[:j]))
            ends = closed and j == len(right)
            if ends:
                letters = letters[: len(letters) - len(self.suffix)]
            model = self.words.model if ends else self.open_words.model
            made = tuple(t.id for t in model.tokenize(letters))
            agrees_left = i == len(left) or made[0] == left[len(left) - i]
            agrees_right = j == len(right) or made[-1] == right[j - 1]
            if agrees_left and agrees_right:
                return left[: len(left) - i] + made + right[j:]
            size *= 2

    def tree(self, parts: list[Part], text: str) -> Part:
        """Join neighbouring parts, level by level."""
        base = parts[0].low
        while len(parts) > 1:
            paired = [self.join(a, b, text, base) for a, b in zip(parts[::2], parts[1::2])]
            parts = paired + parts[len(parts) - len(parts) % 2 :]
        return parts[0]


def halves(text: str, low: int) -> Iterator[tuple[int, str]]:
    if len(text) <= LEAF:
        yield low, text
        return
    middle = len(text) // 2
    yield from halves(text[:middle], low)
    yield from halves(text[middle:], low + middle)


def _codec(key: str, content: Broadcast, quick: bool) -> Codec:
    if _worker.get("key") != key:
        _worker.update(key=key, codec=Codec(content.value, quick))
        gc.set_threshold(1_000_000)  # the cache is all live; walking it again and again is most of the time otherwise
    return _worker["codec"]


def _ids_column(rows: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array<int>) and decoded text.

    Ids are those of the tokenizers library for the file at ``path`` without added
    special tokens, truncation or padding; the decoded text is what it decodes
    them to with special tokens kept.  Null and empty texts give no ids and an
    empty string.  Only the two named columns are read; repeated rows each get a
    row, equal long texts are encoded once.
    """
    spark = docs.sparkSession
    ship(spark)
    content, quick = vocab.broadcast_file(spark, path)
    key = uuid.uuid4().hex
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, content, quick)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(start, ROWS_AT_ONCE)
                made = codec.encode_many(some.column("text").to_pylist())
                decoded = pa.array([d for _, d in made], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), _ids_column([i for i, _ in made]), decoded], ["id", "ids", "decoded"]
                )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(key, content, quick)
        for batch in batches:
            for k, t in zip(batch["key"], batch["text"]):
                leaves = list(codec.cut(t))
                yield pd.DataFrame(leaves, columns=["segment", "low", "special", "leaf"]).assign(key=k)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(key, content, quick)
        for batch in batches:
            parts = [codec.leaf(t, low) if s < 0 else None for t, low, s in zip(batch["leaf"], batch["low"], batch["special"])]
            yield batch.assign(
                starts=[p.starts if p else [] for p in parts],
                ends=[p.ends if p else [] for p in parts],
                counts=[list(map(len, p.ids)) if p else [] for p in parts],
                ids=[list(chain.from_iterable(p.ids)) if p else [s] for p, s in zip(parts, batch["special"])],
                tail=[list(p.open_tail) if p else [] for p in parts],
            )

    def assemble(group: pd.DataFrame) -> pd.DataFrame:
        codec = _codec(key, content, quick)
        ids: list[int] = []
        for _, rows in group.sort_values(["segment", "low"]).groupby("segment", sort=True):
            if rows["special"].iloc[0] >= 0:
                ids.append(int(rows["special"].iloc[0]))
                continue
            parts = []
            for r in rows.itertuples():
                at, each = np.cumsum([0, *r.counts]), [int(i) for i in r.ids]
                split = [tuple(each[a:b]) for a, b in zip(at, at[1:])]
                high = int(r.low) + len(r.leaf)
                parts.append(Part(int(r.low), high, list(map(int, r.starts)), list(map(int, r.ends)), split, tuple(map(int, r.tail))))
            ids.extend(chain.from_iterable(codec.tree(parts, "".join(rows["leaf"])).ids))
        return pd.DataFrame({"key": [group["key"].iloc[0]], "ids": [ids], "decoded": [codec.decode(ids)]})

    is_long = F.length("text") > LEAF
    few = rows.where(~is_long).mapInArrow(short, f"id {kind}, ids array<int>, decoded string")
    long_rows = rows.where(is_long).withColumn("key", F.md5("text"))
    leaves = long_rows.select("key", "text").mapInPandas(cut, "segment int, low int, special int, leaf string, key string")
    # One copy of each leaf, spread over the tasks by its own key.
    leaves = leaves.groupBy("key", "segment", "low").agg(F.first("special").alias("special"), F.first("leaf").alias("leaf"))
    encoded = leaves.mapInPandas(
        encode,
        "key string, segment int, low int, special int, leaf string, starts array<int>, ends array<int>, "
        "counts array<int>, ids array<int>, tail array<int>",
    )
    whole = encoded.groupBy("key").applyInPandas(assemble, "key string, ids array<int>, decoded string")
    many = long_rows.select("id", "key").join(whole, "key").select("id", "ids", "decoded")
    return few.unionByName(many).withColumnRenamed("id", id_col)
