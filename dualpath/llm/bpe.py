"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut in halves down to leaves, and neighbours are joined up the tree. What a node knows of its text is a Part:
the text before its first stable cut, the ids between its first and last stable cut, the text after the last one. A
stable cut lies between a character that is not white space and a space or line feed: no match of the pre-token pattern
runs over it (white space stands only at a match's start, or in a match of white space alone), and a match never depends
on what is left of it, so the ids on either side do not depend on the other. Joining two parts re-encodes only the
window between the last cut of the left one and the first of the right one; a part without a cut is all window, and grows
until a neighbour brings one. Joining is associative, so any tree gives the ids of the whole text.
"""

from __future__ import annotations

import base64
import functools
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

LEAF = 1 << 14
CUT = re.compile(r"\S(?=[ \n])")
NEAR = 256


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass
class Part:
    head: str  # all of the text if there is no cut
    ids: list[int] = field(default_factory=list)
    tail: str | None = None  # None: no cut


def first_cut(text: str) -> int:
    found = CUT.search(text)
    return found.end() if found else -1


def last_cut(text: str) -> int:
    reach = NEAR
    while True:
        start = max(0, len(text) - reach)
        found = -1
        for match in CUT.finditer(text, start):
            found = match.end()
        if found >= 0 or not start:
            return found
        reach *= 4


def part(encoding, text: str) -> Part:
    first = first_cut(text)
    if first < 0:
        return Part(text)
    last = last_cut(text)
    return Part(text[:first], encoding.encode_ordinary(text[first:last]), text[last:])


def join(encoding, a: Part, b: Part) -> Part:
    if a.tail is None and b.tail is None:
        return part(encoding, a.head + b.head)
    if a.tail is None:
        return Part(a.head + b.head, b.ids, b.tail)
    if b.tail is None:
        return Part(a.head, a.ids, a.tail + b.head)
    return Part(a.head, a.ids + encoding.encode_ordinary(a.tail + b.head) + b.ids, b.tail)


def reduce(encoding, text: str, leaf: int) -> Part:
    if len(text) <= leaf:
        return part(encoding, text)
    half = len(text) // 2
    return join(encoding, reduce(encoding, text[:half], leaf), reduce(encoding, text[half:], leaf))


def encode(encoding, text: str, leaf: int = LEAF) -> list[int]:
    if len(text) <= leaf:
        return encoding.encode_ordinary(text)
    whole = reduce(encoding, text, leaf)
    ends = whole.tail or ""
    return encoding.encode_ordinary(whole.head) + whole.ids + encoding.encode_ordinary(ends)


def decode(encoding, ids: list[int], leaf: int = LEAF) -> bytes:
    if len(ids) <= leaf:
        return encoding.decode_bytes(ids)
    half = len(ids) // 2
    return decode(encoding, ids[:half], leaf) + decode(encoding, ids[half:], leaf)


def encode_texts(
    docs: DataFrame, keep: list[str], ranks: str, pattern: str, text: str = "text", leaf: int = LEAF
) -> DataFrame:
    """The columns `keep` and ids, array<int>, one row per row; the ids of each match of `pattern` by itself.

    `ranks` is the path of a file of base64 tokens and ranks, there on every machine. There are no special tokens: their
    strings are ordinary text. Null and empty texts have no ids. Carried columns may be null or repeat; an empty table
    gives an empty result.
    """
    common.tune(docs.sparkSession)
    carried = common.Carried(docs, keep)

    def make():
        encoding = load(ranks, pattern)
        return lambda texts: {"ids": [np.array(encode(encoding, t or "", leaf), np.int32) for t in texts]}

    out = common.map_texts(carried.take(docs, _text=F.col(f"`{text}`")), carried, "ids array<int>", make)
    return out.select(*carried.back(), "ids")


def decode_ids(encoded: DataFrame, keep: list[str], ranks: str, pattern: str, ids: str = "ids", leaf: int = LEAF) -> DataFrame:
    """The columns `keep` and decoded, the bytes of the ids, one row per row; null ids have none. An unknown id fails."""
    carried = common.Carried(encoded, keep)

    def make():
        encoding = load(ranks, pattern)
        return lambda rows: {"decoded": [decode(encoding, r.tolist(), leaf) for r in rows]}

    out = common.map_texts(carried.take(encoded, _text=F.col(f"`{ids}`")), carried, "decoded binary", make)
    return out.select(*carried.back(), "decoded")


def digests(decoded: DataFrame, keep: list[str]) -> DataFrame:
    """Of rows with ids and decoded: the columns `keep`, n_tokens, and the hashes of the decimal ids and of the bytes."""
    return decoded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
