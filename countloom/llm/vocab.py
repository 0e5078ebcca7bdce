"""Vocabulary files for tasks: the bytes of one file are broadcast, so no executor needs a path.

A vocabulary has a fixed size of a few megabytes; ``MAX_BYTES`` checks it.
"""

from __future__ import annotations

import hashlib
import json
import multiprocessing
import re

import regex
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_BYTES = 64_000_000

#: Fixed value: the pattern that splits a text before the merges of byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: One broadcast and one check for each application and content; nothing is sent or checked twice.
_files: dict[tuple[str, str], tuple[Broadcast, bool]] = {}


def broadcast_file(spark: SparkSession, path: str) -> tuple[Broadcast, bool]:
    """The broadcast bytes of the file, and whether the quick encoder agrees with it.

    The check builds tokenizers of the whole vocabulary; it runs in a task of one
    row and there in a process of its own, so that neither the driver nor a worker keeps them.
    """
    with open(path, "rb") as f:
        content = f.read(MAX_BYTES + 1)
    if len(content) > MAX_BYTES:
        raise ValueError(f"{path}: above {MAX_BYTES} bytes, too large to broadcast as a vocabulary")
    key = spark.sparkContext.applicationId, hashlib.sha256(content).hexdigest()
    if key not in _files:
        shared = spark.sparkContext.broadcast(content)

        def check(batches):
            for batch in batches:
                yield pd.DataFrame({"fine": [_apart(agrees, shared.value) for _ in batch["id"]]})

        _files[key] = shared, bool(spark.range(1).mapInPandas(check, "fine boolean").first()["fine"])
    return _files[key]


def _apart(work, content: bytes):
    """work(content) in a child process, whose memory goes back when it ends; here if the child gives no answer."""
    context = multiprocessing.get_context("fork")
    mine, other = context.Pipe(duplex=False)
    child = context.Process(target=lambda: other.send(work(content)))
    child.start()
    other.close()
    try:
        return mine.recv()
    except EOFError:
        return work(content)
    finally:
        child.join()


def tokenizer(content: bytes, **changes):
    """A tokenizers.Tokenizer of the file, without truncation and padding; ``changes`` replace top-level entries."""
    from tokenizers import Tokenizer

    if changes:
        content = json.dumps(json.loads(content) | changes).encode()
    made = Tokenizer.from_str(content.decode())
    made.no_truncation()
    made.no_padding()
    return made


def special_pattern(content: bytes):
    """A pattern with one group that splits a text at the added tokens of the file, and their ids by string; None if it has none."""
    added = json.loads(content)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("only plainly matched added tokens are supported")
    ids = {t["content"]: t["id"] for t in added}
    if not ids:
        return None, {}
    by_length = sorted(ids, key=len, reverse=True)
    return regex.compile("(" + "|".join(regex.escape(s) for s in by_length) + ")"), ids


#: Characters outside the plain ones: those have one class in all Unicode versions, are their own NFC form, and hold no
#: blank but space and line feed.
ODD = re.compile("[^\n\x20-\x7e\u00a1-\u024f\u2010-\u2027]")


def plain(text: str) -> bool:
    return ODD.search(text) is None


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, by the rule that made them.

    Bytes that print stand for themselves; the others take the letters from 256 on, in order.
    """
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Stands for the end of a word in the quick encoder; no plain text holds it.
MARK = "\x00"


def quick_encoder(content: bytes, pattern: str):
    """A tiktoken.Encoding with the merges of a byte-level BPE file; where words have an ending, it is written as ``MARK``.

    It joins neighbours whenever their sum is a token, the file only those pairs
    that it lists.  Both give the same if ids follow the order of the merges and
    each token encodes to itself: the pairs inside a token then arise in one order
    only.  ``agrees`` checks that.
    """
    import tiktoken

    model = json.loads(content)["model"]
    ids, letters, ending = model["vocab"], byte_letters(), model.get("end_of_word_suffix") or ""
    cut = -len(ending) or None
    ranks = {}
    for token, i in ids.items():
        closed = bool(ending) and token.endswith(ending)
        spelled = bytes(letters[c] for c in (token[:cut] if closed else token))
        if not ending or MARK.encode() not in spelled:
            ranks[spelled + (MARK.encode() if closed else b"")] = i
    if ending:
        ranks[MARK.encode()] = 2 * len(ids)
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def agrees(content: bytes) -> bool:
    """Whether the quick encoder gives what the file's own library gives, see there."""
    spec = json.loads(content)
    ids = spec["model"]["vocab"]
    made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if not made or any(a >= b for a, b in zip(made, made[1:])) or made[0] != len(ids) - len(made):
        return False
    ending = spec["model"].get("end_of_word_suffix") or ""
    whole = tokenizer(content).model
    open_model = tokenizer(content, model=spec["model"] | {"end_of_word_suffix": None}).model if ending else whole
    for token, i in ids.items():
        closed = bool(ending) and token.endswith(ending)
        found = (whole if closed else open_model).tokenize(token[: len(token) - len(ending)] if closed else token)
        if [t.id for t in found] != [i]:
            return False
    return True
