"""Substring dedup with difference-cover anchors.

A repeated passage of `window` words is found without looking at every window. COVER is a difference cover modulo PERIOD:
for any two positions i, j there is a shift d < PERIOD with (i + d) and (j + d) both in COVER modulo PERIOD. So two equal
windows, wherever they start, hold an equal anchor of `window - PERIOD + 1` words at cover positions of both. The steps:

1. hash the anchors at cover positions only, and find those that occur more than once;
2. extend: every window around a repeated anchor is a candidate and is hashed in full (128 bits);
3. candidates whose hash occurs more than once mark the words they cover.

Texts are dealt once, by a hash of the row, to chunks of bounded size. Between the steps only hashes travel, packed per
(chunk, bucket of the hash range): a chunk sends each distinct hash once, so a passage that fills a third of the corpus
costs one entry per chunk, and no step ever lists the pairs, or even the places, of a repeated passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

PERIOD = 21
COVER = np.array([0, 1, 4, 14, 16])  # every difference modulo 21 is one of these minus another

CHUNK_BYTES = 2 << 20
BUCKET_HASHES = 500_000

OWN = "n_words long, n_removed long, starts array<long>, ends array<long>, kept_text string"
BLOCK = "chunk long, bucket long, hashes binary, multi binary"


def dedup(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    window: int = 35,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_hashes: int = BUCKET_HASHES,
) -> DataFrame:
    """One row per input row: the columns `keep`, then n_words, n_removed, the removed spans [starts, ends) in words, and
    kept_text, the kept words joined by one space.

    A word goes if a window of `window` words over it occurs anywhere else, in the same text too; windows are judged on
    the input. Texts shorter than the window keep all words. Null and empty texts have no words and kept_text "".
    Repeated rows are texts of their own, so each is the other's copy. Ids and other columns are only carried; they may
    be null or repeat. An empty table gives an empty result.
    """
    anchor = window - PERIOD + 1
    if anchor < 1:
        raise ValueError(f"the window must have at least {PERIOD} words")
    spark = common.tune(docs.sparkSession)
    size = common.text_bytes(docs, text)
    chunks = common.pieces(size, chunk_bytes)
    # At six bytes a word, cover positions; the estimate only sets how finely work is dealt.
    buckets = common.pieces(size / 6 * len(COVER) / PERIOD, bucket_hashes, min(chunks, 16))
    carried = common.Carried(docs, keep)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = carried.take(docs, chunk=F.pmod(F.xxhash64(body, *[F.col(f"`{c}`") for c in keep if c != text]), F.lit(chunks)), _text=body)
    texts = texts.repartition(max(common.partitions(spark), chunks // 2), "chunk")

    def anchors(part: pa.Table) -> pa.Table:
        found = [anchor_hashes(Words(t), anchor)[1] for t in iterate(part.column("_text"))]
        return blocks(part, np.concatenate(found), None, buckets)

    def windows(part: pa.Table, replies: pa.Table) -> pa.Table:
        high, low = candidates(part, known(replies), anchor, window)[1:]
        return blocks(part, high, low, buckets)

    def mark(part: pa.Table, replies: pa.Table) -> pa.Table:
        kinds = replies.column("kind").to_numpy()
        places, high, low = candidates(part, known(replies.filter(pa.array(kinds == 0))), anchor, window)
        again = repeated(replies.filter(pa.array(kinds == 1)), high, low, buckets)
        return kept(part, places, again, window, carried)

    # All three passes read the same columns, so they share one exchange of the texts.
    first = texts.groupBy("chunk").applyInArrow(anchors, BLOCK)
    hits = first.groupBy("bucket").applyInArrow(repeated_hashes, "chunk long, kind int, bucket long, payload binary")
    second = texts.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(windows, BLOCK)
    again = second.groupBy("bucket").applyInArrow(repeated_flags, "chunk long, kind int, bucket long, payload binary")
    both = hits.unionByName(again)
    out = texts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(mark, carried.schema(OWN))
    return out.select(
        *carried.back(), "n_words", "n_removed", F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).alias("removed"), "kept_text"
    )


class Words:
    """The words of a text as slices of one buffer, joined by single spaces."""

    def __init__(self, text: str):
        words = text.encode().split()
        self.bytes = b" ".join(words)
        self.n = len(words)
        self.starts = np.zeros(self.n + 1, np.int64)
        if self.n:
            self.starts[1:-1] = np.flatnonzero(np.frombuffer(self.bytes, np.uint8) == 32) + 1
            self.starts[-1] = len(self.bytes) + 1

    def slices(self, at: np.ndarray, length: int) -> list[bytes]:
        data = self.bytes
        return [data[a:b] for a, b in zip(self.starts[at].tolist(), (self.starts[at + length] - 1).tolist())]


def iterate(column) -> list[str]:
    return [value.as_py() for value in column]


def anchor_hashes(words: Words, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Cover positions where a whole anchor starts, and the anchors' hashes."""
    last = words.n - anchor
    if last < 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = (np.arange(0, last + 1, PERIOD)[:, None] + COVER).ravel()
    at = at[at <= last]
    digest = xxhash.xxh3_64_digest
    return at, np.frombuffer(b"".join([digest(s) for s in words.slices(at, anchor)]), ">u8").astype(np.uint64)


def window_hashes(words: Words, at: np.ndarray, window: int) -> np.ndarray:
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(s) for s in words.slices(at, window)]), ">u8").astype(np.uint64).reshape(-1, 2)


def candidates(part: pa.Table, hits: np.ndarray, anchor: int, window: int):
    """Per text the starts of windows that hold a repeated anchor; the hashes of all of them, text after text."""
    places, hashes = [], [np.zeros((0, 2), np.uint64)]
    for text in iterate(part.column("_text")):
        words = Words(text)
        found = np.zeros(0, np.int64)
        if words.n >= window and len(hits):
            at, own = anchor_hashes(words, anchor)
            at = at[hits[np.minimum(np.searchsorted(hits, own), len(hits) - 1)] == own]
            delta = np.zeros(words.n + 1, np.int32)
            np.add.at(delta, np.maximum(at - (window - anchor), 0), 1)
            np.add.at(delta, at + 1, -1)
            found = np.flatnonzero(np.cumsum(delta)[: words.n - window + 1] > 0)
            if len(found):
                hashes.append(window_hashes(words, found, window))
        places.append((words, found))
    both = np.concatenate(hashes)
    return places, np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def distinct(high: np.ndarray, low: np.ndarray | None):
    """Order, first places of the distinct hashes in it, and how often each occurs."""
    order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
    a = high[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    if low is not None:
        b = low[order]
        new[1:] |= b[1:] != b[:-1]
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(a)))


def bucket_of(high: np.ndarray, buckets: int) -> np.ndarray:
    """Which of equal ranges of the top 32 bits a hash is in; rises with the hash."""
    return ((high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def blocks(part: pa.Table, high: np.ndarray, low: np.ndarray | None, buckets: int) -> pa.Table:
    """The chunk's distinct hashes in order, one row per bucket; multi says which occur in the chunk more than once."""
    order, first, counts = distinct(high, low)
    high = high[order[first]]
    low = None if low is None else low[order[first]]
    of = bucket_of(high, buckets)
    edges = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))
    rows = np.flatnonzero(np.diff(edges))
    cut = [(edges[r], edges[r + 1]) for r in rows]
    chunk = part.column("chunk")[0].as_py()
    data = [high[a:b].tobytes() + (b"" if low is None else low[a:b].tobytes()) for a, b in cut]
    multi = [np.packbits(counts[a:b] > 1).tobytes() for a, b in cut]
    return pa.table(
        {"chunk": pa.array([chunk] * len(rows), pa.int64()), "bucket": pa.array(rows, pa.int64()), "hashes": pa.array(data, pa.binary()), "multi": pa.array(multi, pa.binary())}
    )


def shared(part: pa.Table, wide: bool):
    """Per block of a bucket: its hashes, and which of them occur more than once in the corpus."""
    raw = [np.frombuffer(v.as_py(), np.uint64) for v in part.column("hashes")]
    raw = [r.reshape(2, -1) if wide else r.reshape(1, -1) for r in raw]
    sizes = np.array([r.shape[1] for r in raw])
    multi = np.concatenate([np.unpackbits(np.frombuffer(v.as_py(), np.uint8), count=n) for v, n in zip(part.column("multi"), sizes)])
    every = np.concatenate(raw, axis=1)
    order, first, counts = distinct(every[0], every[1] if wide else None)
    hot = (counts > 1) | (np.add.reduceat(multi[order].astype(np.int64), first) > 0)
    flags = np.empty(len(order), bool)
    flags[order] = np.repeat(hot, counts)
    return zip(part.column("chunk").to_pylist(), raw, np.split(flags, np.cumsum(sizes)[:-1]))


def replies(part: pa.Table, kind: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    bucket = part.column("bucket")[0].as_py()
    return pa.table(
        {
            "chunk": pa.array([c for c, _ in rows], pa.int64()), "kind": pa.array([kind] * len(rows), pa.int32()),
            "bucket": pa.array([bucket] * len(rows), pa.int64()), "payload": pa.array([p for _, p in rows], pa.binary()),
        }
    )


def repeated_hashes(part: pa.Table) -> pa.Table:
    return replies(part, 0, [(c, raw[0][flags].tobytes()) for c, raw, flags in shared(part, False) if flags.any()])


def repeated_flags(part: pa.Table) -> pa.Table:
    return replies(part, 1, [(c, np.packbits(flags).tobytes()) for c, _, flags in shared(part, True)])


def known(part: pa.Table) -> np.ndarray:
    """The repeated anchors of a chunk, in order."""
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(v.as_py(), np.uint64) for v in part.column("payload")]]))


def repeated(part: pa.Table, high: np.ndarray, low: np.ndarray, buckets: int) -> np.ndarray:
    """The flags that came back, put on the chunk's windows; blocks() made them in the order met here again."""
    order, first, counts = distinct(high, low)
    of = bucket_of(high[order[first]], buckets)
    edges = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))
    hot = np.zeros(len(first), bool)
    for bucket, payload in zip(part.column("bucket").to_pylist(), part.column("payload")):
        a, b = edges[bucket], edges[bucket + 1]
        hot[a:b] = np.unpackbits(np.frombuffer(payload.as_py(), np.uint8), count=b - a)
    flags = np.empty(len(order), bool)
    flags[order] = np.repeat(hot, counts)
    return flags


def kept(part: pa.Table, places, again: np.ndarray, window: int, carried: common.Carried) -> pa.Table:
    rows = {k: [] for k in ("n_words", "n_removed", "starts", "ends", "kept_text")}
    done = 0
    for words, found in places:
        hit = found[again[done : done + len(found)]]
        done += len(found)
        delta = np.zeros(words.n + 1, np.int32)
        delta[hit] += 1
        delta[hit + window] -= 1
        gone = np.cumsum(delta) > 0  # one more than the words, and the last is False
        edge = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        data, at, pieces = words.bytes, words.starts, []
        for a, b in zip(np.concatenate(([0], ends)).tolist(), np.concatenate((starts, [words.n])).tolist()):
            if b > a:
                pieces.append(data[at[a] : at[b] - 1])
        rows["n_words"].append(words.n)
        rows["n_removed"].append(int(gone.sum()))
        rows["starts"].append(starts)
        rows["ends"].append(ends)
        rows["kept_text"].append(b" ".join(pieces).decode())
    own = {n: common.as_array(rows[n], t) for n, t in common.arrow_types(OWN).items()}
    return pa.table({**{n: part.column(n) for n in carried.inner}, **own})
