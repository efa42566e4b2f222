"""WARC archives with a two-level capture index.

Archives: one gzip member per record, one file per task, under a name of its own; a file is closed at FILE_BYTES. The first
of the records with equal payloads (the smallest id) is a response; the others are revisits that refer to it, by its id and URL,
and have no payload, only the HTTP headers. Reading finds what revisits refer to by a lookup in the index.

Index: captures are sorted by reversed-host URL key and dealt to files by key range. A file is a row of compressed blocks of
LINES captures, and a directory with each block's first key, place and length. The table of index files, one row a file, is
the upper level. A lookup finds the file among the upper level's keys, then the block in the file's directory, both by
binary search, reads that block's range and then the records' ranges; no other byte is read.

Tables of files are written tables, so a task that is run again leaves at most a file that no row names.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath.llm import common
from dualpath.llm.tokenfile import filesystem
from dualpath.session import new_run_dir

FILE_BYTES = 1 << 30
LINES = 1000
INDEX_ROWS = 1_000_000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TAG = 0x57415243_0000_4000  # high half of the record ids, before the low one, the page id
NULL_TAG = 0x57415243_0001_4000
LOW = (1 << 64) - 1

CAPTURE = "key string, page_id long, url string, file string, at long, length long, type string, digest string"
FILES = "file string, first string, captures long"
RECORD = "page_id long, url string, type string, refers_to long, target string, payload_digest string, payload_bytes long, payload binary"
TARGET = "key string, refers_to long, payload_digest string"


def url_key(url: str | None) -> str:
    """Host parts reversed, then port, path and query: com,example)/path?query. What has no host is its own key.

    The key of a URL is that of its form in a header, so a URL that is read back has the key it was filed under.
    """
    if url is None:
        return ""
    url = header_safe(url)
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def record_id(page_id: int | None) -> str:
    high, low = (NULL_TAG, 0) if page_id is None else (TAG, page_id & LOW)
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | low)}>"


def page_of(name: str) -> int | None:
    value = uuid.UUID(name.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 64 == NULL_TAG:
        return None
    low = value & LOW
    return low - (1 << 64) if low >> 63 else low


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def header_safe(text: str) -> str:
    return "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id, url, digest: str, size: int, payload: bytes | None, first, target: str | None) -> bytes:
    """A response with its payload, or, where payload is None, a revisit of page `first` at `target`."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {header_safe(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        head += [f"WARC-Refers-To: {record_id(first)}", f"WARC-Profile: {PROFILE}"]
        if target is not None:
            head.append(f"WARC-Refers-To-Target-URI: {header_safe(target)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """One gzip member as a row of RECORD; a payload that doesn't have its digest fails."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "type": kind,
        "refers_to": page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "target": fields.get("WARC-Refers-To-Target-URI"), "payload_digest": digest,
        "payload_bytes": size, "payload": payload if kind == "response" else None,
    }


def batch_of(rows: list[dict], ddl: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(common.arrow_types(ddl).items())))


class Out:
    """Files of a folder, written one after the other."""

    def __init__(self, folder: str, suffix: str):
        self.files, self.path = filesystem(folder)
        self.files.create_dir(self.path)
        self.suffix, self.stream, self.at = suffix, None, 0

    def write(self, data: bytes) -> tuple[str, int]:
        if self.stream is None:
            self.name, self.at = f"{uuid.uuid4().hex}{self.suffix}", 0
            self.stream = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
        place = self.name, self.at
        self.stream.write(data)
        self.at += len(data)
        return place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def write_archives(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(folder, ".warc.gz")
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                digest = base32(bytes.fromhex(r["digest"]))
                payload = None if r["payload"] is None else r["payload"].encode()
                data = record(r["page_id"], r["url"], digest, r["size"], payload, r["first"], r["target"])
                name, at = out.write(data)
                rows.append(
                    {"key": url_key(r["url"]), "page_id": r["page_id"], "url": r["url"], "file": name, "at": at, "length": len(data),
                     "type": "revisit" if payload is None else "response", "digest": digest}
                )
                if out.at >= file_bytes:
                    out.close()
            yield batch_of(rows, CAPTURE)
        out.close()

    return run


def write_index(folder: str, lines: int):
    """Blocks of sorted captures, then the directory, compressed, and its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, waiting, directory, total = Out(folder, ".cdx"), [], [], 0

        def flush() -> None:
            data = zlib.compress("\n".join(json.dumps(r) for r in waiting).encode())
            at = out.write(data)[1]
            directory.append([waiting[0]["key"], at, len(data)])
            waiting.clear()

        for batch in batches:
            for row in batch.to_pylist():
                waiting.append(row)
                total += 1
                if len(waiting) == lines:
                    flush()
        if waiting:
            flush()
        if directory:
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data + struct.pack("<I", len(data)))
            out.close()
            yield batch_of([{"file": out.name, "first": directory[0][0], "captures": total}], FILES)

    return run


class IndexFile:
    def __init__(self, folder: str, name: str):
        files, path = filesystem(folder)
        self.file = files.open_input_file(f"{path}/{name}")
        size = self.file.size()
        (length,) = struct.unpack("<I", self.file.read_at(4, size - 4))
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 4 - length)))

        self.keys = [d[0] for d in self.directory]
        self.latest: tuple[int, list[dict]] = -1, []

    def block(self, i: int) -> list[dict]:
        """Block i; the latest is kept, for keys that are asked in order."""
        if self.latest[0] != i:
            _, at, length = self.directory[i]
            self.latest = i, [json.loads(line) for line in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")]
        return self.latest[1]

    def find(self, key: str) -> list[dict]:
        """All captures of a key; they may begin in the block before the first that starts with it."""
        a, b = max(0, bisect.bisect_left(self.keys, key) - 1), bisect.bisect_right(self.keys, key)
        return [c for i in range(a, b) for c in self.block(i) if c["key"] == key]


class Archives:
    """The folders and the upper table of what write() made."""

    def __init__(self, records: str, index: str, files: DataFrame):
        self.records, self.index, self.files = records, index, files


def write(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, file_bytes: int = FILE_BYTES, lines: int = LINES
) -> Archives:
    """A record per row, and the index.

    Of rows with equal payloads of at least `least` bytes the smallest id is the response and others revisit it; rows that
    repeat that id are responses too. Smaller payloads are all responses. A null payload is empty. Null ids are last: they
    are responses only where no row has an id. Null and odd URLs are kept as they are and found under their own key.
    An empty table makes no files. Other columns are not read.
    """
    spark = common.tune(pages.sparkSession)
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload"),
        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"),
    )
    # Only payloads that occur twice are joined: few rows as a rule, and one a payload, so Spark may split the pages of a hot one.
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    firsts = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min(named).alias("f"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1 and f is not null").select("digest", F.col("f.page_id").alias("first"), F.col("f.url").alias("target"))
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "digest", "size", F.when(~revisits, F.col("payload")).alias("payload"), "first", "target"
    )
    folder, index = new_run_dir(spark, "warc"), new_run_dir(spark, "cdx")
    captures = common.written(joined.mapInArrow(write_archives(folder, file_bytes), CAPTURE), "captures")
    files = common.pieces(captures.count(), INDEX_ROWS, min(8, common.partitions(spark)))
    dealt = captures.repartitionByRange(files, "key", "page_id", "file", "at").sortWithinPartitions("key", "page_id", "file", "at")
    return Archives(folder, index, common.written(dealt.mapInArrow(write_index(index, lines), FILES), "cdx-files"))


def read(spark: SparkSession, archives: Archives, payloads: bool = True) -> DataFrame:
    """All records, by way of the index, as rows of RECORD; payload is null for revisits, or for all without `payloads`.

    refers_to is the page of the response that a lookup of the revisit's target finds with the same digest, null if it finds none.
    """
    records = common.written(listed(spark, archives, payloads), "records")
    found = resolved(records.filter("type = 'revisit'"), archives)
    named = records.withColumnRenamed("refers_to", "_asked").join(
        found, (F.col("_asked") == F.col("_found")) & (F.col("payload_digest") == F.col("_digest")) & (F.col("type") == "revisit"), "left"
    )
    return named.withColumn("refers_to", F.col("_found")).select(*common.arrow_types(RECORD))


def resolved(revisits: DataFrame, archives: Archives) -> DataFrame:
    """_found, _digest: the pages and digests of the responses that revisits refer to, by binary search and range reads.

    Targets are asked in the order of their keys, so a block of the index that several are in is read once.
    """
    spark = revisits.sparkSession

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([url_key(t) for t in batch.column("target").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([own, batch.column("refers_to"), batch.column("payload_digest")], names=["key", "refers_to", "payload_digest"])

    asked = revisits.select("target", "refers_to", "payload_digest").distinct().mapInArrow(keys, TARGET)
    dealt = asked.repartitionByRange(common.partitions(spark), "key", "refers_to").sortWithinPartitions("key", "refers_to")
    search = finder(archives)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = search()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                rows += [c for c in look(r["key"]) if c["type"] == "response" and c["page_id"] == r["refers_to"] and c["digest"] == r["payload_digest"]]
            yield batch_of(rows, CAPTURE)

    captures = dealt.mapInArrow(find, CAPTURE).select("file", "at", "length")
    # The record itself is read too: its payload must have the digest.
    found = captures.mapInArrow(read_records(archives.records, False), RECORD)
    return found.select(F.col("page_id").alias("_found"), F.col("payload_digest").alias("_digest")).distinct()


def finder(archives: Archives):
    """A function that gives a task its search: from a key to its captures, by the upper table and the directories.

    The upper table, one row for a million captures, is sent to every task.
    """
    top = sorted((r["first"], r["file"]) for r in archives.files.collect())
    folder = archives.index

    def start():
        firsts, opened = [t[0] for t in top], {}

        def look(key: str) -> list[dict]:
            a, b = max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)
            out = []
            for _, name in top[a:b]:
                if name not in opened:
                    opened[name] = IndexFile(folder, name)
                out += opened[name].find(key)
            return out

        return look

    return start


def listed(spark: SparkSession, archives: Archives, payloads: bool) -> DataFrame:
    """All records as they say of themselves."""

    folder = archives.index

    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                index = IndexFile(folder, name)
                for i in range(len(index.directory)):
                    yield batch_of(index.block(i), CAPTURE)

    listed = archives.files.select("file").repartition(common.partitions(spark), "file").mapInArrow(captures, CAPTURE)
    # Ranges of a file, read in order; a long file is shared by several tasks.
    share = F.floor(F.col("at") / (64 << 20))
    dealt = listed.select("file", "at", "length").repartition(common.partitions(spark), "file", share).sortWithinPartitions("file", "at")
    return dealt.mapInArrow(read_records(archives.records, payloads), RECORD)


def read_records(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = filesystem(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["file"] != name:
                    name, file = r["file"], files.open_input_file(f"{path}/{r['file']}")
                rows.append(parse(file.read_at(r["length"], r["at"])))
                if not payloads:
                    rows[-1]["payload"] = None
            yield batch_of(rows, RECORD)

    return run


def lookup(urls: DataFrame, archives: Archives, url: str = "url") -> DataFrame:
    """The records of the given URLs (a column of strings), found by binary search and range reads.

    URLs that nothing has give no row; a null URL finds records without one.
    """
    search = finder(archives)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = search()
        for batch in batches:
            rows = [c for wanted in batch.column(0).to_pylist() for c in look(url_key(wanted)) if c["url"] == wanted]
            yield batch_of(rows, CAPTURE)

    found = urls.select(F.col(f"`{url}`").cast("string")).distinct().mapInArrow(find, CAPTURE)
    return found.select("file", "at", "length").mapInArrow(read_records(archives.records, True), RECORD)
