"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file holds one range of document ids, in ascending order:

    magic | ids, little-endian, `width` bytes each | boundaries | document ids | footer (JSON) | footer length (u32) | magic

boundaries (where each document's ids begin, and the total) and document ids (less the first) never fall, so both are
Elias-Fano sequences: the low bits of each value packed, the high parts in unary, and the place of every 256th one as the
select structure. That is about 2 + log2(ids per document) bits a document instead of a table of 64-bit offsets; select(i)
reads one sample and at most a few hundred bits.

Texts are encoded where they are read; only ids are shuffled, to the file of their id range. Tasks write files under names
of their own and the manifest, itself a written table, names those that count, so a task that is lost and run again
leaves at most a file that nothing names.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dualpath.llm import common
from dualpath.session import new_run_dir

MAGIC = b"IDSEF001"
SAMPLE = 256
FILE_BYTES = 32 << 20  # text a file, about
CACHE_WORDS = 1_000_000
JOINED = 500  # new words encoded in one call
CACHE_BYTES = 64  # longer words are not kept
PROBES = 500  # words that must have the same ids by the model alone, for it to be used
READ_IDS = 1 << 20
READ_DOCS = 1 << 12
MARK = b"<|"  # how special tokens begin; words that hold it are encoded alone
TAIL = re.compile(rb"(?<=[A-Za-z0-9])[.,;:!?]+$")
ENDS = frozenset(b".,;:!?")
LONG = 1 << 40
ACCURACY = 10_000


class EliasFano:
    """A sequence that never falls, of n values from 0 on."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        pack = functools.partial(np.packbits, bitorder="little")
        return cls(n, bits, pack(low.astype(np.uint8).ravel()).tobytes(), pack(unary).tobytes(), places[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQ", self.n, self.low_bits, len(self.low), len(self.high))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, bits, low, high = struct.unpack_from("<QBQQ", data)
        at = struct.calcsize("<QBQQ")
        return cls(n, bits, data[at : at + low], data[at + low : at + low + high], np.frombuffer(data, "<u4", -(-n // SAMPLE), at + low + high))

    def select(self, i: int) -> int:
        """Value i, from one sample and the bits after it."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        at = place // 8
        byte = self.high[at] >> (place % 8) << (place % 8)
        while left >= byte.bit_count():
            left -= byte.bit_count()
            at += 1
            byte = self.high[at]
        for _ in range(left):
            byte &= byte - 1
        high = at * 8 + (byte & -byte).bit_length() - 1 - i
        first = i * self.low_bits
        word = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        return high << self.low_bits | word >> (first % 8) & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        unary = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        out = (np.flatnonzero(unary)[: self.n] - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits and self.n:
            low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
            out |= low.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out


@functools.lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, WordIds(path, tokenizer)


ENCODED = "shard long, doc_id long, ids binary"


class Forms(dict):
    """Numbers of words as they stand in texts. Forms with the same ids share a number or are put together from two.

    Words that are wholly ASCII are looked up in lower case, except where a special token, whose case matters, may stand;
    others are left to the tokenizer, which composes a letter and its marks before it lowers them. Punctuation after a letter
    or digit is a word of its own. Very long words are numbered from LONG on and forgotten after each batch.
    """

    def __init__(self):
        super().__init__()
        self.size, self.plain, self.joined, self.long = 0, [], [], {}

    def __missing__(self, word: bytes) -> int:
        if len(word) > CACHE_BYTES:
            return LONG + self.long.setdefault(word, len(self.long))
        if not word.islower() and word.isascii() and MARK not in word and (base := word.lower()) != word:
            code = self[base]
        elif word[-1] in ENDS and (tail := TAIL.search(word)):
            parts = self[word[: tail.start()]], self[word[tail.start() :]]
            code, self.size = self.size, self.size + 1
            self.joined.append((code, *parts))
        else:
            code, self.size = self.size, self.size + 1
            self.plain.append((code, word))
        self[word] = code
        return code


class WordIds:
    """Ids of texts under a tokenizer that drops white space and case: no word affects another, so each is encoded once.

    The words known are forgotten when there are more than CACHE_WORDS.
    """

    def __init__(self, path: str, tokenizer):
        self.path = path
        special = [(t.content, i) for i, t in sorted(tokenizer.get_added_tokens_decoder().items()) if t.special and not t.normalized and t.content.startswith(MARK.decode())]
        self.mark, self.mark_id = (special[0][0].encode(), special[0][1]) if special else (None, -1)
        self.model = self._model(tokenizer)
        self.clear()

    @staticmethod
    def _model(tokenizer):
        """The tokenizer's inner model, where it gives lower-case ASCII letters the ids that the whole tokenizer gives."""
        stems = sorted({"".join(c for c in token if "a" <= c <= "z") for token in tokenizer.get_vocab()} - {""})
        tried = [a + b for a, b in zip(stems[:: max(1, len(stems) // PROBES)], stems[7 :: max(1, len(stems) // PROBES)])]
        whole = tokenizer.encode_batch_fast(tried, add_special_tokens=False)
        same = all([t.id for t in tokenizer.model.tokenize(w)] == e.ids for w, e in zip(tried, whole))
        return tokenizer.model if same and tried else None

    def clear(self) -> None:
        self.forms = Forms()
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)

    def tokens(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, in order."""
        out: list = [None] * len(words)
        apart, together = [], []
        for i, w in enumerate(words):
            if self.model is not None and w.isalpha() and w.islower():  # ASCII letters: nothing to normalize or split
                out[i] = np.array([t.id for t in self.model.tokenize(w.decode())], np.int32)
            else:
                (apart if self.mark is None or MARK in w else together).append(i)
        # A special token between words is one id and keeps them apart, and few long calls are quicker than many short.
        groups = [together[i : i + JOINED] for i in range(0, len(together), JOINED)] + [[i] for i in apart]
        texts = [(self.mark or b"").join([words[i] for i in g]).decode() for g in groups]
        for group, encoded in zip(groups, load(self.path)[0].encode_batch_fast(texts, add_special_tokens=False)):
            own = np.array(encoded.ids, np.int32)
            marks = np.flatnonzero(own == self.mark_id) if len(group) > 1 else np.zeros(0, np.int64)
            if len(marks) != len(group) - 1:
                raise ValueError("the tokenizer changed a special token")
            for i, a, b in zip(group, [0, *(marks + 1).tolist()], [*marks.tolist(), len(own)]):
                out[i] = own[a:b]
        return out

    def learn(self) -> None:
        """Ids of the forms that are new since the last call."""
        forms, known = self.forms, len(self.sizes)
        if forms.size == known:
            return
        new: list = [None] * (forms.size - known)
        for (code, _), ids in zip(forms.plain, self.tokens([w for _, w in forms.plain])):
            new[code - known] = ids
        starts = np.cumsum(self.sizes) - self.sizes
        old = lambda c: self.ids[starts[c] : starts[c] + self.sizes[c]]
        for code, *parts in forms.joined:  # parts have smaller numbers
            new[code - known] = np.concatenate([new[c - known] if c >= known else old(c) for c in parts])
        forms.plain, forms.joined = [], []
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, new), np.int64, len(new))])
        self.ids = np.concatenate([self.ids, *new])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.forms) > CACHE_WORDS:
            self.clear()
        split = [t.encode().split() for t in texts]
        codes = [np.fromiter(map(self.forms.__getitem__, words), np.int64, len(words)) for words in split]
        self.learn()
        ids, sizes, long = self.ids, self.sizes, self.forms.long
        if long:
            more = self.tokens(list(long))
            codes = [np.where(c >= LONG, c - LONG + len(sizes), c) for c in codes]
            ids, sizes = np.concatenate([ids, *more]), np.append(sizes, [len(m) for m in more])
            self.forms.long = {}
        starts = np.cumsum(sizes) - sizes
        return [ids[common.ranges(starts[c], sizes[c])] for c in codes]


def encode(docs: DataFrame, tokenizer: str, id_col: str, text: str, end_id: int, width: int, bounds: list[int]) -> DataFrame:
    """shard, doc_id, ids (bytes, the end id included), encoded where the texts are read."""
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    edges = np.array(bounds, np.int64)
    kinds = pa.schema(list(common.arrow_types(ENCODED).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(tokenizer)[1]
        for batch in batches:
            found = words.encode([t or "" for t in batch.column("text").to_pylist()])
            ids = pa.array([np.append(own, end_id).astype(f"<u{width}").tobytes() for own in found], pa.binary())
            # The bounds are as many as files, and rise: an id's file is the number of bounds it reaches. Nulls go first.
            names = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
            shard = pa.array(np.searchsorted(edges, names, side="right"), pa.int64())
            yield pa.RecordBatch.from_arrays([shard, batch.column("doc_id"), ids], schema=kinds)

    return read.mapInArrow(run, ENCODED)


def filesystem(folder: str):
    """The file system and path of a shared folder, given as a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class Writer:
    def __init__(self, folder: str, shard: int, width: int):
        files, path = filesystem(folder)
        files.create_dir(path)
        self.name = f"{shard:08d}-{uuid.uuid4().hex}.ids"
        self.out = files.open_output_stream(f"{path}/{self.name}", compression=None)
        self.out.write(MAGIC)
        self.shard, self.width, self.sizes, self.docs, self.nulls = shard, width, [], [], 0

    def add(self, doc_ids: pa.Array, ids: pa.Array) -> None:
        for doc, data in zip(doc_ids.to_pylist(), ids):
            raw = data.as_buffer()
            self.out.write(raw)
            self.sizes.append(raw.size // self.width)
            if doc is None:
                self.nulls += 1
            else:
                self.docs.append(doc)

    def close(self) -> dict:
        sizes = np.array(self.sizes, np.int64)
        docs = np.array(self.docs, np.int64)
        base = int(docs[0]) if len(docs) else 0
        starts = EliasFano.of(np.concatenate(([0], np.cumsum(sizes)))).to_bytes()
        names = EliasFano.of(docs.astype(np.uint64) - np.int64(base).astype(np.uint64)).to_bytes()
        footer = json.dumps({"width": self.width, "starts": len(starts), "docs": len(names), "base": base, "nulls": self.nulls}).encode()
        self.out.write(starts + names + footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()
        return {"shard": self.shard, "file": self.name, "n_docs": len(sizes), "n_ids": int(sizes.sum())}


MANIFEST = "shard long, file string, n_docs long, n_ids long"


def write_files(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(shards)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)]):
                if a == b:
                    continue
                if writer is None or writer.shard != shards[a]:
                    done += [writer.close()] if writer else []
                    writer = Writer(folder, int(shards[a]), width)
                writer.add(batch.column("doc_id").slice(a, b - a), batch.column("ids").slice(a, b - a))
        done += [writer.close()] if writer else []
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema(list(common.arrow_types(MANIFEST).items())))

    return run


class Reader:
    """One file. Offsets come from the boundary sequence; ids are read by range."""

    def __init__(self, folder: str, name: str):
        files, path = filesystem(folder)
        self.file = files.open_input_file(f"{path}/{name}")
        size = self.file.size()
        (length,) = struct.unpack("<I", self.file.read_at(12, size - 12)[:4])
        foot = json.loads(self.file.read_at(length, size - 12 - length))
        at = size - 12 - length - foot["docs"]
        self.width, self.base, self.nulls = foot["width"], foot["base"], foot["nulls"]
        self.docs = EliasFano.from_bytes(self.file.read_at(foot["docs"], at))
        self.starts = EliasFano.from_bytes(self.file.read_at(foot["starts"], at - foot["starts"]))

    def __len__(self) -> int:
        return self.starts.n - 1

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.docs.select(i - self.nulls) + self.base

    def ids(self, i: int) -> np.ndarray:
        """The ids of document i of this file."""
        return self.span(self.starts.select(i), self.starts.select(i + 1))

    def span(self, a: int, b: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((b - a) * self.width, len(MAGIC) + a * self.width), f"<u{self.width}")

    def rows(self) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
        """Documents in blocks of READ_DOCS or about READ_IDS ids: their ids, offsets and token ids.

        Offsets and ids come from the select structures, a block's at a time; no table of a file's offsets is made.
        """
        at = 0
        while at < len(self):
            to = min(at + READ_DOCS, len(self))
            first = self.starts.select(at)
            while to > at + 1 and self.starts.select(to) - first > READ_IDS:
                to = at + (to - at) // 2
            starts = np.array([first, *(self.starts.select(i) for i in range(at + 1, to + 1))], np.int64)
            ids = self.span(first, int(starts[-1]))
            yield [self.doc_id(i) for i in range(at, to)], starts, np.split(ids, starts[1:-1] - first)
            at = to


def write(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES
) -> tuple[DataFrame, str]:
    """Writes all texts' ids in ascending id order; returns the manifest (shard, file, n_docs, n_ids, start) and its folder.

    `tokenizer` is the path of a tokenizers file that drops white space and case and never joins letters or digits with
    punctuation, there on every machine. Each text's ids end with
    `end_id`. Null and empty texts are that id alone. Null ids come first; rows with equal ids are ordered by their token
    ids, and stay in one file. An empty table has no files. Other columns are not read.
    """
    spark = common.tune(docs.sparkSession)
    width = 2 if load(tokenizer)[0].get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    shards = common.pieces(common.text_bytes(docs, text), file_bytes)
    bounds: list[int] = []
    if shards > 1:
        share = [i / shards for i in range(1, shards)]
        found = docs.agg(F.percentile_approx(F.col(f"`{id_col}`"), share, max(ACCURACY, 10 * shards))).first()[0]
        bounds = sorted(set(found or []))
    folder = new_run_dir(spark, "token-files")
    dealt = encode(docs, tokenizer, id_col, text, end_id, width, bounds)
    dealt = dealt.repartition(max(common.partitions(spark), shards), "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    manifest = common.written(dealt.mapInArrow(write_files(folder, width), MANIFEST), "token-manifest")
    # One row a file.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), folder


READ = "doc_id long, start long, n_tokens long, ids binary"


def read(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian, four bytes each), from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                for docs, starts, ids in Reader(folder, name).rows():
                    columns = docs, starts[:-1] + start, np.diff(starts), [x.astype("<u4").tobytes() for x in ids]
                    kinds = common.arrow_types(READ)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

    dealt = manifest.select("file", "start").repartition(common.partitions(spark), "file")
    return dealt.mapInArrow(run, READ)
