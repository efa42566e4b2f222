"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint's 64 bits are 32 segments of two bits; its embedding is the 32 bit counts. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so fingerprints that differ in at most 3 bits have
embeddings within 3, and in one half of the 32 counts within 1. The grid is the 16 counts of a half: each distinct
fingerprint is at home in the cell of its counts and probes the cells that have one count more, so any two cells within
distance 1 meet. Candidates that share a cell are verified by their exact Hamming distance.

Equal fingerprints are one node, however many documents have them. A cell passes on a spanning forest of its links, not
the links, so a dense group gives as many rows as it has fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common
from dualpath.llm.components import Forest, components

SEGMENTS = 32
HALF = SEGMENTS // 2
DISTANCE = 3
SHINGLE = 3
PAIRS = 1 << 20  # pairs verified at a time
SLICE = 1 << 16  # shingles hashed at a time
POWERS = 3 ** np.arange(HALF, dtype=np.int64)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 (seed 42); no words give zero. Signed 64 bits."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    data = b" ".join(words)
    starts = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
    starts = np.concatenate(([0], starts, [len(data) + 1]))
    length = min(shingle, len(words))
    n = len(words) - length + 1
    from_, to = starts[:n].tolist(), (starts[length : length + n] - 1).tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        hashed = b"".join([digest(data[a:b], 42) for a, b in zip(from_[at : at + SLICE], to[at : at + SLICE])])
        ones += np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns `keep` and fp, one row per row. Null and empty texts get zero."""
    common.tune(docs.sparkSession)
    carried = common.Carried(docs, keep)

    def make():
        return lambda texts: {"fp": [fingerprint(t, shingle) for t in texts]}

    out = common.map_texts(carried.take(docs, _text=F.col(f"`{text}`")), carried, "fp long", make)
    return out.select(*carried.back(), "fp")


def counts(fps: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment, one row per fingerprint."""
    pairs = fps.view(np.uint64)[:, None] >> (2 * np.arange(SEGMENTS, dtype=np.uint64))
    return ((pairs & np.uint64(1)) + ((pairs >> np.uint64(1)) & np.uint64(1))).astype(np.int64)


def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fp -> (cell, home, fp): its own cell in either half, and the cells with one count more."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        grid = counts(fps)
        cells, homes, owners = [], [], []
        for half in (0, 1):
            part = grid[:, half * HALF : (half + 1) * HALF]
            own = part @ POWERS + half * 3**HALF
            row, segment = np.nonzero(part < 2)
            cells += [own, own[row] + POWERS[segment]]
            homes += [np.ones(len(fps), bool), np.zeros(len(row), bool)]
            owners += [fps, fps[row]]
        cell, home, fp = (np.concatenate(x) for x in (cells, homes, owners))
        for at in range(0, len(cell), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[at : at + (1 << 16)]) for x in (cell, home, fp)], names=["cell", "home", "fp"]
            )


def link_cells(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not parts:
            return
        cell, home, fp = (np.concatenate(x) for x in zip(*parts))
        nodes, index = np.unique(fp, return_inverse=True)
        order = np.lexsort((~home, cell))  # homes come first in their cell
        cell, home, index = cell[order], home[order], index[order]
        end = np.searchsorted(cell, cell, side="right")
        first = np.flatnonzero(home)
        partners = end[first] - first - 1
        forest, bits = Forest(len(nodes)), nodes.view(np.uint64)
        cum = np.cumsum(partners)
        at = 0
        while at < len(first):
            upto = max(at + 1, int(np.searchsorted(cum, (cum[at - 1] if at else 0) + PAIRS, side="right")))
            for lo in range(0, int(partners[at]) if upto == at + 1 else 1, PAIRS):  # one home may have more alone
                n = np.minimum(partners[at:upto] - lo, PAIRS) if upto == at + 1 else partners[at:upto]
                a = np.repeat(index[first[at:upto]], n)
                b = index[common.ranges(first[at:upto] + 1 + lo, n)]
                near = np.bitwise_count(bits[a] ^ bits[b]) <= distance
                forest.join(a[near], b[near])
            at = upto
        linked = np.flatnonzero(forest.root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[linked]), pa.array(nodes[forest.root[linked]])], names=["u", "v"]
        )

    return run


def link(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """u, v: links that connect all distinct fingerprints (column fp) that differ in at most `distance` <= 3 bits."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("halves within distance 1 find differences of at most 3 bits")
    cells = distinct.select("fp").mapInArrow(to_cells, "cell long, home boolean, fp long")
    dealt = cells.repartition(common.partitions(distinct.sparkSession), "cell")
    return dealt.mapInArrow(link_cells(distance), "u long, v long")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """doc_id, key, fp, component_id, label: one row per input row.

    component_id is the smallest id reachable over fingerprints that differ in at most `distance` bits; label, a
    fingerprint, names the component too. key is a hash of the text. Null and empty texts have fingerprint zero and link
    like any other. A null id is a component's id only if it has no other; repeated rows are in the same component. An
    empty table gives an empty result. Other columns are not read.
    """
    body = F.col(f"`{text}`")
    read = docs.select(F.col(f"`{id_col}`").alias("doc_id"), body.alias("text"), text_key(body).alias("key"))
    found = common.written(fingerprints(read, ["doc_id", "key"], "text", shingle), "fingerprints")
    nodes = common.written(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(common.written(link(nodes, distance), "links"))
    whole = nodes.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    ids = whole.groupBy("label").agg(F.min("least").alias("component_id"))
    named = whole.select("fp", "label").join(ids, "label")
    return found.join(named, "fp").select("doc_id", "key", "fp", "component_id", "label")


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """doc_id, key, label of `other`: rows of one label are connected by the labels of either table.

    Both have a label per key. Of a label of `one`, the labels of `other` link to the least.
    """
    labels = one.select("key", F.col("label").alias("_one")).distinct()
    both = common.written(other.select("key", "label").distinct().join(labels, "key").select("_one", "label").distinct(), "both")
    least = both.groupBy("_one").agg(F.min("label").alias("least"))
    links = both.join(least, "_one").filter("label <> least").select(F.col("label").alias("u"), F.col("least").alias("v")).distinct()
    whole = components(common.written(links, "links")).toDF("label", "whole")
    return other.join(whole, "label", "left").select("doc_id", "key", F.coalesce("whole", "label").alias("label"))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def one_of_each(docs: DataFrame, near: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay: of each component the one with the smallest id, of repeated rows one.

    Null ids come last; equal ids are told apart by the hash of the text.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    stay = near.groupBy("label").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    own = docs.withColumn("_own", text_key(F.col(f"`{text}`")))
    kept = own.join(stay, (F.col("_own") == F.col("_key")) & F.col(f"`{id_col}`").eqNullSafe(F.col("_id")), "left_semi")
    return kept.dropDuplicates([id_col, "_own"]).drop("_own")
