"""Near copies by the exact Jaccard similarity of their five-word shingles, by prefix filtering.

All shingles have one order, the same in every document: those of no other document first, then by how many documents have
them, then by hash. Two sets of similarity 0.8 or more share a shingle among the first fifth of each, and at the first one
they share enough of both must be left to come. So documents meet under the shingles of their first fifth; no pair is missed,
whatever the order, and most of what a document meets under is rare. The document counts are exact sums of packed hashes; what
tasks know of them are two maps of bounded size, in which places that meet can only make a shingle look more common.

Equal sets are one node. Each node is first compared with one that it meets, the one with the fewest shared shingles; after
that only pairs that are still apart are. Before a text is read again, a pair must pass its sizes, its places and its parity
bits: a node has a bit for each value of a short hash that an odd number of its shingles have, so the bits in which two nodes
differ are never more than the shingles in which they do. A dense group so costs about as many comparisons as it has nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common, phrases, simhash
from dualpath.llm.components import components

SHINGLE = 5
NUMBER, OF = 4, 5  # similarity of at least 4/5, in whole numbers
GRAMS = 4 << 20  # shingles a hash partition, about
BYTES_A_GRAM = 5.5  # of text
CHUNK = 2 << 20  # shingles counted at a time
COMMON = 16  # documents from which on the count of a shingle matters for its order
MAP_BITS = 28  # of the bit map of shingles that two documents have, at most: 32 MB
WEIGHT_BITS = 24  # of the map of counts: 16 MB
CELL = 1 << 14  # rows of a shingle that meet in one task; more are dealt in blocks, each pair of blocks once
ROWS = 1 << 18  # rows paired at a time
PAIRS = 1 << 20  # pairs looked at at a time


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct XXH64 (seed 42) of the text's word shingles, rising. Fewer words are one shingle, no words none."""
    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    data = b" ".join(words)
    starts = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
    starts = np.concatenate(([0], starts, [len(data) + 1]))
    length = min(shingle, len(words))
    n = len(words) - length + 1
    spans = zip(starts[:n].tolist(), (starts[length : length + n] - 1).tolist())
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(data[a:b], 42) for a, b in spans), np.uint64, n).view(np.int64))


def prefix(n: int) -> int:
    return n - -(-NUMBER * n // OF) + 1 if n else 0


def summaries(parts: int):
    """Texts to packed document counts of their shingles, per chunk and hash partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(phrases.keyed(shingles(text).view(np.uint64), parts))
                size += len(held[-1])
                if size >= CHUNK:
                    yield from phrases.packed_rows(*np.unique(np.concatenate(held), return_counts=True))
                    held, size = [], 0
        if size:
            yield from phrases.packed_rows(*np.unique(np.concatenate(held), return_counts=True))

    return run


def shared_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries, sorted by hash partition, to the hashes that two documents or more have, and their counts."""

    def row(part: int, own: phrases.Summary) -> pa.RecordBatch:
        own.merge()
        several = own.counts > 1
        out = {"part": part, "n": int(several.sum()), "data": phrases.packed(own.hashes[several], np.minimum(own.counts[several], 0xFFFFFFFF))}
        return pa.RecordBatch.from_pylist([out], pa.schema(list(common.arrow_types(phrases.SURVIVORS).items())))

    part, own = None, None
    for batch in batches:
        for p, n, data in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "data"))):
            if p != part:
                if own is not None:
                    yield row(part, own)
                part, own = p, phrases.Summary(1 << 62)
            own.add(*phrases.unpacked(data, n))
    if own is not None:
        yield row(part, own)


def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of packed hashes those that COMMON documents or more have."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            hashes, counts = phrases.unpacked(row["data"], row["n"])
            often = counts >= COMMON
            out.append({"part": row["part"], "n": int(often.sum()), "data": phrases.packed(hashes[often], counts[often])})
        yield pa.RecordBatch.from_pylist(out, pa.schema(list(common.arrow_types(phrases.SURVIVORS).items())))


def counted(docs: DataFrame, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of hash partitions, bit map of the shingles that several documents have, and logarithms of common counts."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{text}`").alias("text"))
    parts = min(phrases.MOST_PARTS, max(common.partitions(spark), common.pieces(common.text_bytes(read, "text") / BYTES_A_GRAM, GRAMS)))
    dealt = read.mapInArrow(summaries(parts), phrases.SUMMARY).select("part", "n", "data").repartition(max(common.partitions(spark), min(parts, 1 << 13)), "part")
    several = common.written(dealt.sortWithinPartitions("part").mapInArrow(shared_by, phrases.SURVIVORS), "shared")
    bits = phrases.bit_map(several, MAP_BITS)
    weights = phrases.cells(several.mapInArrow(frequent, phrases.SURVIVORS), WEIGHT_BITS)
    common.discard(several)
    return parts, bits, weights


def order(own: np.ndarray, known: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """The weight of each shingle: 0 if no other document has it, else the more the commoner it is."""
    parts, bits, weights = known
    keys = phrases.keyed(own.view(np.uint64), parts)
    at = phrases.place(keys, (len(bits) * 8).bit_length() - 1)
    several = bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
    return np.where(several, 1 + weights[phrases.place(keys, len(weights).bit_length() - 1)].astype(np.int64), 0)


def parity(own: np.ndarray) -> bytes:
    """Bits at which an odd number of shingles meet, twice as many bits as shingles or more: a power of two from 64 on."""
    bits = max(64, 1 << (2 * len(own) - 1).bit_length()) if len(own) else 64
    odd = np.bincount((own.view(np.uint64) >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


SETS = "node long, n long, rare long, grams array<long>, pos array<long>, sig binary"


def sets(docs: DataFrame, id_col: str, text: str, shared: Broadcast) -> DataFrame:
    """doc_id, key, node (a hash of the set), n (its size), rare (its unshared shingles), sig (its parity bits), and of its
    first fifth the shared shingles and their places. `shared` is what counted() gives."""
    body = F.col(f"`{text}`")
    read = docs.select(F.col(f"`{id_col}`").alias("doc_id"), simhash.text_key(body).alias("key"), body.alias("text"))
    carried = common.Carried(read, ["doc_id", "key"])

    def make():
        maps = shared.value

        def work(texts: list) -> dict:
            out = {name: [] for name in common.arrow_types(SETS)}
            for t in texts:
                own = shingles(t)
                weight = order(own, maps)
                first = np.lexsort((own, weight))[: prefix(len(own))]
                pos = np.flatnonzero(weight[first])
                row = node(own), len(own), int((weight == 0).sum()), own[first[pos]], pos, parity(own)
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return work

    out = common.map_texts(carried.take(read, _text=F.col("text")), carried, SETS, make)
    return out.select(*carried.back(), *common.arrow_types(SETS))


def node(own: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(own.tobytes(), 7)
    return value - (1 << 64) if value >> 63 else value


def apart(sigs: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs (a, b) of positions: in how many parity bits they differ. The longer bits are folded to the shorter's."""
    sizes = np.fromiter(map(len, sigs), np.int64, len(sigs))
    out = np.zeros(len(a), np.int64)
    kinds = np.unique(sizes)
    at, tables = np.zeros(len(sigs), np.int64), {}
    for size in kinds.tolist():
        own = np.flatnonzero(sizes == size)
        at[own] = np.arange(len(own))
        tables[size] = np.frombuffer(b"".join([sigs[i] for i in own.tolist()]), np.uint64).reshape(len(own), size // 8)
    for one in kinds.tolist():
        for other in kinds.tolist():
            here = np.flatnonzero((sizes[a] == one) & (sizes[b] == other))
            step = max(1, (32 << 20) // max(one, other))
            for lo in range(0, len(here), step):
                some = here[lo : lo + step]
                x, y = tables[one][at[a[some]]], tables[other][at[b[some]]]
                while x.shape[1] > y.shape[1]:
                    x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
                while y.shape[1] > x.shape[1]:
                    y = y[:, : y.shape[1] // 2] ^ y[:, y.shape[1] // 2 :]
                out[some] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def near_enough(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Sets of n and m that differ in `differ` shingles or more can have the similarity."""
    return (OF + NUMBER) * differ <= (OF - NUMBER) * (n + m)


def may_be_near(a: str, b: str):
    """Sizes, and what is left of both from the shared shingle on, allow the similarity."""
    least, most = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return (OF * least >= NUMBER * most) & ((OF + NUMBER) * left >= NUMBER * (least + most))


def sifted(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes (node, n, sig) that their parity bits leave."""
    both = pairs.join(nodes.toDF("u", "nu", "su"), "u").join(nodes.toDF("v", "nv", "sv"), "v").select("u", "v", "nu", "nv", "su", "sv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(batch)
            differ = apart(batch.column("su").to_pylist() + batch.column("sv").to_pylist(), np.arange(k), np.arange(k) + k)
            near = near_enough(batch.column("nu").to_numpy(), batch.column("nv").to_numpy(), differ)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


CELLS = ("gram", "lo", "hi", "first", "node", "label", "n", "pos", "sig")


def cell_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell (shingle and blocks) and n, to the pairs of nodes of different labels that may be near."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= ROWS:
            rows = pa.Table.from_batches(held).combine_chunks()
            cell = np.stack([rows.column(c).to_numpy() for c in CELLS[:3]])
            changes = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(0))
            if len(changes):  # the last cell may go on
                end = int(changes[-1]) + 1
                yield from _paired(rows.slice(0, end))
                held, size = rows.slice(end).to_batches(), len(rows) - end
    if size:
        yield from _paired(pa.Table.from_batches(held).combine_chunks())


def _paired(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    gram, lo, hi, first, own, label, n, pos = (rows.column(c).to_numpy() for c in CELLS[:8])
    new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
    cell = np.cumsum(new) - 1
    ends = np.append(np.flatnonzero(new)[1:], len(cell))[cell]
    # Sizes rise in a cell: the partners of a row are those after it, up to the largest that its size allows.
    wide = np.int64(1 << 40)
    key = cell * wide + np.minimum(n, wide - 1)
    partners = np.minimum(ends, np.searchsorted(key, cell * wide + np.minimum(n * OF // NUMBER, wide - 1), side="right")) - np.arange(len(cell)) - 1
    sigs = rows.column("sig").to_pylist()
    cum, at = np.cumsum(partners), 0
    while at < len(cell):
        upto = max(at + 1, int(np.searchsorted(cum, (cum[at - 1] if at else 0) + PAIRS, side="right")))
        a = np.repeat(np.arange(at, upto), partners[at:upto])
        b = common.ranges(np.arange(at, upto) + 1, partners[at:upto])
        at = upto
        left = np.minimum(n[a] - pos[a], n[b] - pos[b])
        keep = (label[a] != label[b]) & ((lo[a] == hi[a]) | (first[a] != first[b])) & ((OF + NUMBER) * left >= NUMBER * (n[a] + n[b]))
        a, b = a[keep], b[keep]
        u, v = np.minimum(own[a], own[b]), np.maximum(own[a], own[b])
        _, once = np.unique(np.stack([u, v]), axis=1, return_index=True) if len(u) else (None, np.zeros(0, np.int64))
        a, b, u, v = a[once], b[once], u[once], v[once]
        keep = near_enough(n[a], n[b], apart(sigs, a, b)) if len(a) else np.zeros(0, bool)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], names=["u", "v"])


def still_apart(rows: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """u, v: pairs that share a shingle of their first fifths, have different labels and may be near.

    Rows of a shingle that many nodes have are dealt in blocks of about CELL, each pair of blocks to a task of its own.
    """
    own = rows.join(labels, "node", "left").select(rows["*"], F.coalesce("label", "node").alias("label"))
    groups = own.groupBy("gram").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count(F.lit(1)).alias("rows")).filter("least < most")
    blocks = F.ceil(F.col("rows") / CELL).cast("int")
    split = own.join(groups.select("gram", blocks.alias("blocks")), "gram").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    split = split.select("gram", lo.alias("lo"), hi.alias("hi"), (F.col("block") == lo).alias("first"), "node", "label", "n", "pos")
    whole = split.join(nodes.select("node", "sig"), "node").select(*CELLS).withColumn("first", F.col("first").cast("int"))
    cell = ["gram", "lo", "hi"]
    dealt = whole.repartition(common.partitions(rows.sparkSession), *cell).sortWithinPartitions(*cell, "n")
    return dealt.mapInArrow(cell_pairs, "u long, v long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """The pairs (u, v) of nodes whose sets are similar enough. Only the texts of their nodes are read again."""
    asked = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    keys = common.written(found.join(asked, "node").groupBy("node").agg(F.min("key").alias("_key")), "asked")
    read = docs.select(F.col(f"`{text}`").alias("_text")).withColumn("_key", simhash.text_key(F.col("_text"))).join(keys, "_key")
    whole = common.written(read.groupBy("node").agg(F.first("_text").alias("own")), "texts")
    both = pairs.join(whole.toDF("u", "a"), "u").join(whole.toDF("v", "b"), "v").select("u", "v", "a", "b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = shingles(a), shingles(b)
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(OF * both >= NUMBER * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(near, pa.bool_()))

    out = common.written(both.mapInArrow(similar, "u long, v long"), "near")
    common.discard(keys, whole)
    return out


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key, label: one row per input row; rows of one label are connected by pairs of similarity 0.8 or more.

    key is a hash of the text. Null texts and texts without words are alike. Null ids are values like any other, and repeated
    rows are in the same component. An empty table gives an empty result. Other columns are not read.
    """
    common.tune(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(counted(docs, text))
    found = common.written(sets(docs, id_col, text, known), "shingles")
    known.destroy()  # up to 48 MB, else kept by the driver
    nodes = common.written(found.groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig")).select("node", "n", "sig"), "nodes")
    each = found.select(F.explode(F.arrays_zip("grams", "pos")).alias("e"), "node", "n", "rare")
    rows = common.written(each.select(F.col("e.grams").alias("gram"), "e.pos", "node", "n", "rare").distinct(), "meeting")

    centre = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("rare", "node", "n", "pos")).alias("c")).filter("rows > 1").select("gram", "c.*")
    around = rows.alias("a").join(centre.alias("b"), "gram").filter("a.node <> b.node").filter(may_be_near("a", "b"))
    # One comparison a node: with the best of the centres that it meets.
    best = around.groupBy("a.node").agg(F.min(F.struct("b.rare", "b.node")).alias("best"))
    first = best.select(F.least("node", "best.node").alias("u"), F.greatest("node", "best.node").alias("v")).distinct()
    first = common.written(sifted(first, nodes), "pairs")
    near = verified(first, docs, found, text)
    labels = components(near)

    other = common.written(still_apart(rows, labels, nodes).join(first, ["u", "v"], "left_anti"), "pairs")
    more = verified(other, docs, found, text)
    whole = common.written(components(common.written(near.union(more), "links")), "labels")
    own = common.written(found.select("doc_id", "key", "node"), "keys")
    common.discard(found, nodes, rows, first, near, other, more)
    return own.join(whole, "node", "left").select("doc_id", "key", F.coalesce("label", "node").alias("label"))
