"""Token counts, with overlap resynchronisation for huge texts.

Texts up to `chunk` characters are encoded whole. Longer ones are encoded in chunks that overlap, with offsets. Where two
neighbouring chunks both begin a pre-token at the same place, the pre-tokenizer goes on alike in both from there, since
it only looks ahead: everything after that place is right in the right chunk, everything before it in the left one, as
long as the place is GUARD characters from the left chunk's end (more than any look-ahead or special string). The counts
are spliced there. If an overlap has no such place it is widened, up to the end of the text.
"""

from __future__ import annotations

import functools
import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

CHUNK = 1 << 16
OVERLAP = 1 << 10
GUARD = 64


@functools.lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Piece:
    """An encoded slice [start, end) of a text: where its pre-tokens begin, and the tokens before each of them."""

    def __init__(self, tokenizer, text: str, start: int, end: int):
        self.start, self.end = start, end
        encoded = tokenizer.encode(text[start:end], add_special_tokens=False)
        words = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
        offsets = np.array([o[0] for o in encoded.offsets], np.int64)
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
        self.before = np.append(np.flatnonzero(new), len(words))
        self.begins = np.append(offsets[new] + start, end)

    def tokens(self, begin: int, end: int) -> int:
        a, b = np.searchsorted(self.begins, (begin, end))
        return int(self.before[b] - self.before[a])


def count_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, guard: int = GUARD) -> int:
    n, total, begin = len(text), 0, 0
    left = Piece(tokenizer, text, 0, min(n, chunk + overlap))
    while left.end < n:
        start = left.start + chunk
        right = Piece(tokenizer, text, start, min(n, start + chunk + overlap))
        wider = overlap
        while True:
            both = np.intersect1d(left.begins, right.begins)
            both = both[(both > max(start, begin)) & (both <= left.end - guard)]
            if len(both):
                break
            wider *= 2
            end = min(n, left.end + wider)
            left = Piece(tokenizer, text, left.start, end)
            if end == n:
                return total + left.tokens(begin, n)
            if right.end < end:
                right = Piece(tokenizer, text, start, end)
        splice = int(both[0])
        total += left.tokens(begin, splice)
        left, begin = right, splice
    return total + left.tokens(begin, n)


def token_counts(
    docs: DataFrame,
    keep: list[str],
    tokenizer: str,
    text: str = "text",
    limit: int = 512,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The columns `keep`, then n_bytes, n_tokens and over_limit (more than `limit` tokens), one row per row.

    `tokenizer` is the path of a byte-level tokenizers file without normalizer, there on every machine. No special tokens
    are added; special strings in texts are special tokens, the library's default. Null and empty texts have no bytes and
    tokens. Carried columns may be null or repeat; an empty table gives an empty result.
    """
    common.tune(docs.sparkSession)
    carried = common.Carried(docs, keep)

    def make():
        model = load(tokenizer)
        if model.normalizer is not None:
            raise ValueError("offsets of a tokenizer with a normalizer can't be spliced")

        def work(texts: list) -> dict:
            texts = [t or "" for t in texts]
            short = [t for t in texts if len(t) <= chunk]
            counted = iter([len(e) for e in model.encode_batch_fast(short, add_special_tokens=False)])
            tokens = [next(counted) if len(t) <= chunk else count_long(model, t, chunk, overlap) for t in texts]
            return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

        return work

    out = common.map_texts(
        carried.take(docs, _text=F.col(f"`{text}`")), carried, "n_bytes long, n_tokens long, over_limit boolean", make
    )
    return out.select(*carried.back(), "n_bytes", "n_tokens", "over_limit")
