"""Phrase collocations: Misra-Gries summaries find the frequent n-grams, a second pass counts them exactly.

First pass: tasks turn their texts into hashes of all n-grams of one to three words and count them per hash partition, in
chunks; what is shuffled are such counts as packed summaries. Each hash partition merges its summaries into one of more
counters than its mass divided by the threshold: whenever it holds more, the next largest count is taken off all. That takes
less than the threshold off any n-gram, so each one that is frequent keeps a counter. Hashes that meet only add candidates.

Second pass: the survivors are a bit map of bounded size that goes to all tasks; each task counts the n-grams that hit it by
their words, exactly, and their sums decide. A bit map that is full lets more n-grams through, never fewer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dualpath.llm import common

LONGEST = 3  # words of a phrase; three codes fill 63 bits
LEAST = 10
TOP = 2000
COVERED = 50  # percent
SCALE = 1_000_000
CHUNK = 1 << 20  # words and piece ends counted at a time
GRAMS = 16 << 20  # occurrences a hash partition, about
BYTES_A_GRAM = 1.8  # of text
MOST_PARTS = 1 << 17
CODE_BITS = 21
HASH_BITS = 32
MAP_BITS = 28  # of the bit map, at most: 32 MB
SEGMENT_BITS = 19
HELD = 2 << 20  # exact counts that a task holds before it passes them on
UNKNOWN = "und"

END = b"\xff"  # no byte of UTF-8: the end of a piece
_ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(0xFF if b in _ENDS else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def split(text: str | None) -> list[bytes]:
    """Words, with END after each piece."""
    return (text or "").encode().translate(TABLE).replace(END, b" \xff ").split() + [END]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ONE
    x = (x ^ (x >> np.uint64(27))) * _TWO
    return x ^ (x >> np.uint64(31))


class Codes(dict):
    """Numbers of words in the order they come, END first, and their hashes."""

    def __init__(self):
        super().__init__({END: 0})
        self.words, self._hashes = [END], np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.words)
        self.words.append(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    @property
    def hashes(self) -> np.ndarray:
        new = self.words[len(self._hashes) :]
        if new:
            digests = np.fromiter((xxhash.xxh64_intdigest(w, 11) for w in new), np.uint64, len(new))
            self._hashes = np.concatenate([self._hashes, digests])
        return self._hashes


def grams(codes: np.ndarray, skip: int, hashes: np.ndarray, lang: str, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For one to LONGEST words: size, where its n-grams begin, and their keys (hash partition and hash).

    The first `skip` codes are context: n-grams that end there are left out.
    """
    word, whole = hashes[codes], codes > 0
    total = np.full(len(codes), np.uint64(xxhash.xxh64_intdigest(lang.encode(), 12)))
    here = np.ones(len(codes), bool)
    for size in range(1, LONGEST + 1):
        n = len(codes) - size + 1
        if n <= 0:
            return
        here = here[:n] & whole[size - 1 :]
        total = total[:n] + mixed(word[size - 1 :] + _STEP[size - 1]) * _STEP[size - 1]
        at = np.flatnonzero(here)
        at = at[at + size > skip]
        yield size, at, keyed(mixed(total[at]), parts)


def keyed(hashed: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition and hash, from low and high bits of a 64-bit hash."""
    part = (hashed & np.uint64(0xFFFFFF)) * np.uint64(parts) >> np.uint64(24)
    return part << np.uint64(HASH_BITS) | hashed >> np.uint64(64 - HASH_BITS)


def packed(hashes: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Rising hashes, and counts: differences, byte by byte, compressed."""
    wide = np.diff(hashes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    planes = [wide[:, : HASH_BITS // 8].T.tobytes()]
    if counts is not None:
        planes.append(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and, if they were packed, counts."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = HASH_BITS // 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = raw[: n * width].reshape(width, n).T
    counts = np.ascontiguousarray(raw[n * width :].reshape(-1, n).T) if n else np.zeros((0, 4), np.uint8)
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64), counts.view("<u4").ravel().astype(np.int64) if counts.shape[1] else np.zeros(0, np.int64)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, int, Codes]]:
    """Codes of about CHUNK words of one language at a time, how many of them are context, and what they stand for."""
    codes, held, sizes = Codes(), {}, {}

    def cut(lang: str):
        sizes[lang] = 0
        return lang, np.concatenate(held.pop(lang)), 0, codes

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = split(text)
            for at in range(0, len(words), CHUNK):
                skip = min(at, LONGEST - 1)
                part = words[at - skip : at + CHUNK]
                if len(codes) + len(part) >= 1 << CODE_BITS:
                    for other in list(held):
                        yield cut(other)
                    codes = Codes()
                own = codes.of(part)
                if len(words) > CHUNK:  # parts of a very long text stand alone, after the end of the part before
                    yield lang, own, skip, codes
                    continue
                held.setdefault(lang, []).append(own)
                sizes[lang] = sizes.get(lang, 0) + len(own)
                if sizes[lang] >= CHUNK:
                    yield cut(lang)
    for other in list(held):
        yield cut(other)


SUMMARY = "part int, mass long, n long, data binary"


def summaries(parts: int):
    """Texts to packed counts of hashed n-grams, per chunk and hash partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, own, skip, codes in chunks(batches):
            keys = np.concatenate([k for _, _, k in grams(own, skip, codes.hashes, lang, parts)])
            yield from packed_rows(*np.unique(keys, return_counts=True))

    return run


def packed_rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    part = (keys >> np.uint64(HASH_BITS)).astype(np.int32)
    hashes = keys & np.uint64((1 << HASH_BITS) - 1)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
    spans = [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if a < b]
    for first in range(0, len(spans), 1024):
        some = spans[first : first + 1024]
        out = [int(part[a]) for a, _ in some], [int(counts[a:b].sum()) for a, b in some], [b - a for a, b in some]
        data = [packed(hashes[a:b], counts[a:b]) for a, b in some]
        kinds = common.arrow_types(SUMMARY)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*out, data], kinds.values())], names=list(kinds))


class Summary:
    """A Misra-Gries summary of at most `most` counters; `less` is what any of them may lack."""

    def __init__(self, most: int):
        self.most, self.less, self.waiting, self.size = most, 0, [], 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.size += len(hashes)
        if self.size > max(self.most, len(self.hashes), 1 << 18):
            self.merge()

    def merge(self) -> None:
        both = [(self.hashes, self.counts), *self.waiting]
        self.waiting, self.size = [], 0
        hashes, where = np.unique(np.concatenate([h for h, _ in both]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([c for _, c in both]).astype(float), len(hashes)).astype(np.int64)
        if len(hashes) > self.most:
            off = int(np.partition(counts, len(counts) - self.most - 1)[len(counts) - self.most - 1])
            self.less += off
            counts = counts - off
            hashes, counts = hashes[counts > 0], counts[counts > 0]
        self.hashes, self.counts = hashes, counts

    def frequent(self, least: int) -> np.ndarray:
        self.merge()
        return self.hashes[self.counts + self.less >= least]


SURVIVORS = "part int, n long, data binary"


def merged(masses: dict[int, int], least: int):
    """Summaries, sorted by hash partition, to the hashes that may have `least` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = None, None
        for batch in batches:
            for p, n, data in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "data"))):
                if p != part:
                    if own is not None:
                        yield row(part, own)
                    part, own = p, Summary(masses[p] // least + 1)
                own.add(*unpacked(data, n))
        if own is not None:
            yield row(part, own)

    def row(part: int, own: Summary) -> pa.RecordBatch:
        kept = own.frequent(least)
        return pa.RecordBatch.from_pylist([{"part": part, "n": len(kept), "data": packed(kept)}], pa.schema(list(common.arrow_types(SURVIVORS).items())))

    return run


def bit_map(survivors: DataFrame, most_bits: int) -> np.ndarray:
    """One bit for each survivor, in a map of 16 bits a survivor and at most 2 ** most_bits."""
    n = survivors.agg(F.sum("n")).first()[0] or 0
    bits = min(most_bits, max(SEGMENT_BITS, (16 * n).bit_length()))
    return cells(survivors, bits, pack=True)


def cells(found: DataFrame, bits: int, pack: bool = False) -> np.ndarray:
    """2 ** bits cells of hashes (part, n, data): at each one's place the logarithm of its largest count.

    With `pack` a cell is one bit, set where a hash is, eight to a byte.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, k, data in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "data"))):
                hashes, counts = unpacked(data, k)
                at = place(np.uint64(p) << np.uint64(HASH_BITS) | hashes, bits)
                value = (np.log2(counts) + 1).astype(np.uint8) if len(counts) else np.ones(len(at), np.uint8)
                order = np.argsort(at)
                at, value = at[order], value[order]
                segment = at >> np.uint64(SEGMENT_BITS)
                edges = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1, [len(at)])).tolist()
                spans = [(a, b) for a, b in zip(edges[:-1], edges[1:]) if a < b]
                low = (at & np.uint64((1 << SEGMENT_BITS) - 1)).astype("<u4")
                columns = [int(segment[a]) for a, _ in spans], [low[a:b].tobytes() for a, b in spans], [value[a:b].tobytes() for a, b in spans]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], names=["segment", "places", "most"])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, data, most in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = out.setdefault(segment, np.zeros(1 << SEGMENT_BITS, np.uint8))
                np.maximum.at(own, np.frombuffer(data, "<u4"), np.frombuffer(most, np.uint8))
        for segment, own in out.items():
            own = np.packbits(own > 0, bitorder="little") if pack else own
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["segment", "cells"])

    dealt = found.mapInArrow(places, "segment int, places binary, most binary").repartition(common.partitions(found.sparkSession), "segment")
    each = 1 << (SEGMENT_BITS - 3 * pack)
    whole = np.zeros(1 << (bits - 3 * pack), np.uint8)
    for r in dealt.mapInArrow(filled, "segment int, cells binary").collect():  # the map in segments, of a size that is given
        whole[r["segment"] * each : (r["segment"] + 1) * each] = np.frombuffer(r["cells"], np.uint8)
    return whole


def place(keys: np.ndarray, bits: int) -> np.ndarray:
    return mixed(keys) & np.uint64((1 << bits) - 1)


COUNTS = "bucket int, lang string, n long, phrases binary, counts binary"


class Exact:
    """Counts of n-grams by their words' codes, held until there are HELD of them."""

    def __init__(self, codes: Codes):
        self.codes, self.by_lang = codes, {}

    def add(self, lang: str, keys: np.ndarray, total: int) -> None:
        found, counts = np.unique(keys, return_counts=True)
        if lang in self.by_lang:
            before, n, total_before = self.by_lang[lang]
            found, where = np.unique(np.concatenate([before, found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n, counts]).astype(float), len(found)).astype(np.int64)
            total += total_before
        self.by_lang[lang] = found, counts, total

    def __len__(self) -> int:
        return sum(len(k) for k, _, _ in self.by_lang.values())

    def rows(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """Per language and bucket its n-grams in order, one a line, and their counts; the empty one counts the words."""
        word, low = self.codes.words.__getitem__, (1 << CODE_BITS) - 1
        for lang, (keys, counts, total) in self.by_lang.items():
            parts = [(keys >> (CODE_BITS * (LONGEST - 1 - i)) & low).tolist() for i in range(LONGEST)]
            names = [b" ".join(map(word, filter(None, ws))) for ws in zip(*parts)] + [b""]
            counts = np.append(counts, total)
            bucket = np.fromiter((zlib.crc32(n) % buckets for n in names), np.int64, len(names))
            order = np.argsort(bucket, kind="stable")
            edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)])).tolist()
            press = zstandard.ZstdCompressor(level=1).compress
            for a, b in zip(edges[:-1], edges[1:]):
                own = sorted(order[a:b].tolist(), key=names.__getitem__)
                lines = press(b"\n".join([names[i] for i in own]))
                columns = [int(bucket[order[a]])], [lang], [len(own)], [lines], [press(counts[own].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())]
                kinds = common.arrow_types(COUNTS)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))


FREQUENT = "lang string, size int, phrase string, f long"


def summed(least: int):
    """Packed exact counts, sorted by bucket, to the n-grams with f >= least, and per language size 0 with all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, sums = None, {}
        for batch in batches:
            for b, lang, n, lines, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "n", "phrases", "counts"))):
                if b != bucket:
                    yield from rows(sums)
                    bucket, sums = b, {}
                unpack = zstandard.ZstdDecompressor().decompress
                own, planes = sums.setdefault(lang, {}), np.frombuffer(unpack(counts), np.uint8).reshape(8, n)
                for name, f in zip(unpack(lines).split(b"\n"), np.ascontiguousarray(planes.T).view("<u8").ravel().tolist()):
                    own[name] = own.get(name, 0) + f
        yield from rows(sums)

    def rows(sums: dict) -> Iterator[pa.RecordBatch]:
        for lang, own in sums.items():
            kept = [(name, f) for name, f in own.items() if f >= least or not name]
            for at in range(0, len(kept), 1 << 16):
                names, counts = zip(*kept[at : at + (1 << 16)])
                sizes = [name.count(b" ") + 1 if name else 0 for name in names]
                columns = [pa.array([lang] * len(names)), pa.array(sizes, pa.int32()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "f"])

    return run


def exact_counts(parts: int, buckets: int, shared):
    """Texts to packed exact counts of the n-grams that hit the bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = shared.value
        bits = (len(bits_of) * 8).bit_length() - 1
        own = None
        for lang, codes, skip, book in chunks(batches):
            if own is None or own.codes is not book or len(own) > HELD:
                if own is not None:
                    yield from own.rows(buckets)
                own = Exact(book)
            hit, total = [], 0
            for size, at, keys in grams(codes, skip, book.hashes, lang, parts):
                total += len(at) if size == 1 else 0
                cell = place(keys, bits)
                at = at[(bits_of[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                key = np.zeros(len(at), np.int64)
                for i in range(size):
                    key |= codes[at + i] << (CODE_BITS * (LONGEST - 1 - i))
                hit.append(key)
            own.add(lang, np.concatenate(hit), total)
        if own is not None:
            yield from own.rows(buckets)

    return run


def frequent_grams(docs: DataFrame, lang: str, text: str, least: int, map_bits: int = MAP_BITS) -> DataFrame:
    """lang, size, phrase, f: every n-gram of one to LONGEST words with f >= least, and per lang size 0 with all words."""
    spark = common.tune(docs.sparkSession)
    read = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text"))
    parts = min(MOST_PARTS, max(common.partitions(spark), common.pieces(common.text_bytes(read, "text") / BYTES_A_GRAM, GRAMS)))
    found = common.written(read.mapInArrow(summaries(parts), SUMMARY), "summaries")
    # One number a hash partition.
    masses = {r["part"]: r["mass"] for r in found.groupBy("part").agg(F.sum("mass").alias("mass")).collect()}
    dealt = found.select("part", "n", "data").repartition(max(common.partitions(spark), min(parts, 1 << 13)), "part").sortWithinPartitions("part")
    survivors = common.written(dealt.mapInArrow(merged(masses, least), SURVIVORS), "survivors")
    shared = spark.sparkContext.broadcast(bit_map(survivors, map_bits))
    buckets = max(common.partitions(spark), 4 * parts)
    counts = read.mapInArrow(exact_counts(parts, buckets, shared), COUNTS).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    out = common.written(counts.mapInArrow(summed(least), FREQUENT), "counts")
    common.discard(found, survivors)
    return out


def phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, covered: int = COVERED, map_bits: int = MAP_BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of two to LONGEST words.

    Words are lower-cased (A-Z) and end at spaces and tabs, pieces at .,;:!? and line ends. a is how often a phrase stands in
    pieces, l and r how often its two parts do at the cut with the lowest score, n the language's words; the score is
    floor(SCALE * a * a / (l * r)), in whole numbers of 38 digits. Phrases below `least`, and those inside a longer one that
    has `covered` percent of their count, are left out.

    Null texts are empty, null languages UNKNOWN. Rows that repeat count as often as they stand there. Ties go to the smallest
    cut, then the larger a, then the phrase by its bytes. An empty table gives an empty result; other columns are not read.
    """
    counts = frequent_grams(docs, lang, text, least, map_bits)
    words = F.split("phrase", " ")
    found = counts.filter("size > 1")
    cuts = found.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    for name, part in (("l", F.slice(words, F.lit(1), F.col("k"))), ("r", F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")))):
        sides = counts.filter("size > 0").select("lang", F.col("phrase").alias("_part"), F.col("f").alias(name))
        cuts = cuts.withColumn("_part", F.concat_ws(" ", part)).join(sides, ["lang", "_part"]).drop("_part")
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in "alr")
    cuts = cuts.withColumns({"above": F.lit(SCALE).cast("decimal(7,0)") * a * a, "below": l * r}).withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "size", "a", "cut.*")

    inner = F.expr("flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> concat_ws(' ', slice(split(phrase, ' '), i, s)))))")
    inside = found.filter("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
