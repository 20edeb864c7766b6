"""WARC archives with a two-level capture index.

Archives: gzip members, one a record, written by tasks into the shared folder under names of their own attempt, so
that a task run twice never touches what another wrote; only files that the index names count. A file is closed at
ROLL_BYTES and the next one begun. The index: captures sorted by reversed-host URL key and page id, gathered into
compressed blocks of BLOCK_LINES lines; an index file ends with a sparse directory of its blocks, one entry a block, and
a footer that says where that begins. A table has each index file's first entry, one row a file.

A look-up searches that table by bisection, then the file's directory, reads one block's range, searches it by bisection
and reads the record's range. Many look-ups go the same way in sorted order, dealt by ranges of keys, so that a task reads
few directories and each block once; their records are then read in the order of archives and offsets.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import new_path, small_batches, stored, table

BLOCK_LINES = 1000
LEVEL = 3
ROLL_BYTES = 1 << 30
#: Compressed bytes that one task reads back.
READ_BYTES = 64 << 20
FOOTER, FOOTER_BYTES = "<QQ", 16
#: A record's date where the table has none (fixed, so that reruns write equal bytes).
DATE = "1970-01-01T00:00:00Z"
RECORD = "urn:mosaicflow:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id long, url string, record_type string, digest string, file string, offset long, length long"


def filesystem(path: str):  # noqa: ANN201
    """The file system of a path or URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def url_key(url: str | None) -> str:
    """Host reversed by its labels, without www and port, then path and query: com,example,blog)/a?b=c."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname or ""
    except ValueError:
        return ""
    labels = host.lower().split(".")
    if labels[0] == "www":
        labels = labels[1:]
    return ",".join(reversed(labels)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def digest_of(payload: bytes) -> str:
    """Base32 of the payload's SHA-1; 20 bytes give 32 characters, so nothing is padded."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, compressed: a response with its payload, or a revisit with the response's HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(raw: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a compressed record; a response's payload is checked."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = fields["WARC-Record-ID"][1:-1].removeprefix(RECORD)
    refers = fields.get("WARC-Refers-To")
    if refers is None and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"the payload of record {page} does not have its digest")
    return {
        "page_id": int(page) if page else None, "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": int(refers[1:-1].removeprefix(RECORD)) if refers else None,
    }


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record a row of pages (page_id, url, html) under folder/archive; a stored table of captures.

    Of rows with equal html the one of smallest page_id is a response and the others revisit it; rows of that id are
    all responses, and so is a row without id. Null html is an empty payload. Only digests and ids are brought
    together to find the first; html moves once, by page id.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    narrow = pages.select("page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("size")).filter("page_id is not null")
    narrow = stored(narrow, "warc-digests")
    firsts = narrow.groupBy("sha", "size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisits = narrow.join(stored(firsts, "warc-firsts"), ["sha", "size"]).filter("page_id <> refers_to").select("page_id", "sha", "refers_to").distinct()
    rows = pages.withColumn("sha", F.sha1("html")).join(revisits, ["page_id", "sha"], "left").select("page_id", "url", "html", "refers_to")
    archive = f"{folder}/archive"
    filesystem(archive)[0].create_dir(filesystem(archive)[1], recursive=True)

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, out, offset, number, name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}", None, 0, 0, ""
        files, base = filesystem(archive)
        for batch in batches:
            found = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is not None and offset >= ROLL_BYTES:
                    out.close()
                    out = None
                if out is None:
                    name, offset, number = f"{part}-{number:05d}.warc.gz", 0, number + 1
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                payload = html.encode()
                digest = digest_of(payload)
                raw = record(page_id, url, payload, digest, refers_to)
                out.write(raw)
                found.append((url_key(url), page_id, url, "response" if refers_to is None else "revisit", digest, name, offset, len(raw)))
                offset += len(raw)
            yield captures(found)
        if out is not None:
            out.close()

    return stored(rows.mapInArrow(run, CAPTURE), "warc-captures")


def captures(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "page_id", "url", "record_type", "digest", "file", "offset", "length"])


def place(key: str, page_id: int | None) -> tuple:
    """What captures are sorted by; no page id comes first, as in Spark's order."""
    return key, page_id is not None, page_id or 0


def write_index(found: DataFrame, folder: str) -> DataFrame:
    """Sort captures into blocks under folder/index; a stored table of index files: first_key, first_id, file, size, n."""
    index = f"{folder}/index"
    filesystem(index)[0].create_dir(filesystem(index)[1], recursive=True)

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name, out, offset, n = f"cdx-{context.partitionId():05d}-{context.taskAttemptId()}.gz", None, 0, 0
        files, base = filesystem(index)
        waiting: list[dict] = []
        directory: list[tuple] = []

        def flush() -> None:
            nonlocal out, offset
            if out is None:
                out = files.open_output_stream(f"{base}/{name}", compression=None)
            raw = packed_lines(waiting)
            out.write(raw)
            directory.append((waiting[0]["key"], waiting[0]["page_id"], offset, len(raw)))
            offset += len(raw)
            waiting.clear()

        for batch in batches:
            for r in batch.to_pylist():
                waiting.append(r)
                n += 1
                if len(waiting) == BLOCK_LINES:
                    flush()
        if waiting:
            flush()
        if out is not None:
            raw = packed_lines(directory)
            out.write(raw + struct.pack(FOOTER, offset, len(raw)))
            out.close()
            offset += len(raw) + FOOTER_BYTES
        first = directory[:1]
        columns = [[d[0] for d in first], [d[1] for d in first], [name] * len(first), [offset] * len(first), [n] * len(first)]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["first_key", "first_id", "file", "size", "n"])

    ordered = found.select("key", "page_id", "url", "record_type", "digest", "file", "offset", "length").repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return stored(ordered.mapInArrow(run, "first_key string, first_id long, file string, size long, n long"), "warc-directory")


def packed_lines(rows: list) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("".join(json.dumps(r, separators=(",", ":")) + "\n" for r in rows).encode()) + packer.flush()


def unpacked_lines(raw: bytes) -> list:
    return [json.loads(x) for x in zlib.decompress(raw, 31).decode().split("\n")[:-1]]


class CaptureIndex:
    """Look-ups by URL key and page id. In memory: one entry an index file, the directories and the block last read."""

    def __init__(self, folder: str, roots: list[tuple]):
        self.folder, self.roots = folder, sorted(roots, key=lambda r: place(r[0], r[1]))
        self.starts = [place(r[0], r[1]) for r in self.roots]
        self.directory: tuple[str, list, list] = ("", [], [])
        self.block: tuple[tuple, list, list] = ((), [], [])
        self.reads = 0

    @classmethod
    def of(cls, directory: DataFrame, folder: str) -> CaptureIndex:
        return cls(folder, roots_of(directory))

    def range(self, kind: str, file: str, offset: int, length: int) -> bytes:
        files, base = filesystem(f"{self.folder}/{kind}")
        self.reads += 1
        with files.open_input_file(f"{base}/{file}") as f:
            return f.read_at(length, offset)

    def blocks(self, file: str, size: int) -> tuple[list, list]:
        """An index file's directory, by its footer, and where its blocks start."""
        if self.directory[0] != file:
            begin, length = struct.unpack(FOOTER, self.range("index", file, size - FOOTER_BYTES, FOOTER_BYTES))
            entries = unpacked_lines(self.range("index", file, begin, length))
            self.directory = (file, entries, [place(e[0], e[1]) for e in entries])
        return self.directory[1:]

    def lines(self, file: str, offset: int, length: int) -> tuple[list, list]:
        if self.block[0] != (file, offset):
            rows = unpacked_lines(self.range("index", file, offset, length))
            self.block = ((file, offset), rows, [place(r["key"], r["page_id"]) for r in rows])
        return self.block[1:]

    def between(self, low: tuple, high: tuple) -> Iterator[dict]:
        """The captures from the place low up to the place high, both included, in the index's order."""
        f = max(0, bisect.bisect_left(self.starts, low) - 1)
        while f < len(self.roots) and self.starts[f] <= high:
            _, _, file, size = self.roots[f]
            entries, starts = self.blocks(file, size)
            k = max(0, bisect.bisect_left(starts, low) - 1)
            while k < len(entries) and starts[k] <= high:
                rows, places = self.lines(file, entries[k][2], entries[k][3])
                yield from rows[bisect.bisect_left(places, low) : bisect.bisect_right(places, high)]
                k += 1
            f += 1

    def find(self, url: str) -> list[dict]:
        """The captures of a URL."""
        key = url_key(url)
        return list(self.between((key, False, 0), (key, True, 1 << 63)))

    def read(self, capture: dict) -> dict:
        return parse(self.range("archive", capture["file"], capture["offset"], capture["length"]))


def roots_of(directory: DataFrame) -> list[tuple]:
    """One row an index file, as many as the index's writer had tasks."""
    return [(r["first_key"], r["first_id"], r["file"], r["size"]) for r in directory.collect()]


def look_up(wanted: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The captures of each (url, page_id) of wanted; of repeated ones each capture comes once."""
    shared = wanted.sparkSession.sparkContext.broadcast(roots_of(directory))

    @K.lean
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string()), batch.column(1)], names=["key", "page_id"])

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(folder, shared.value)
        for batch in batches:
            found = []
            for key, page_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = place(key, page_id)
                found += [tuple(x[k] for k in ("key", "page_id", "url", "record_type", "digest", "file", "offset", "length")) for x in index.between(at, at)]
            yield captures(found)

    keys = wanted.select(F.col("url").cast("string").alias("url"), F.col("page_id").cast("long").alias("page_id")).mapInArrow(keyed, "key string, page_id long").distinct()
    return keys.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id").mapInArrow(run, CAPTURE)


def read_records(found: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records of these captures, by range reads.

    Records go to tasks by ranges of (file, offset); a task reads READ_BYTES or so, and there are as many tasks as cores.
    """
    found = stored(found.select("file", "offset", "length"), "warc-found")
    size = found.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(found.sparkSession.sparkContext.defaultParallelism, -(-size // READ_BYTES))

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(f"{folder}/archive")
        name, f = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, files.open_input_file(f"{base}/{file}")
                out.append(parse(f.read_at(length, offset)))
            kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in kinds.items()], names=list(kinds))
        if f is not None:
            f.close()

    by_place = found.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return by_place.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages into archives, index them, look every page up in the index and read its record back.

    Null html is an empty payload; rows of one (page_id, url) are records of their own; a row without page_id is a
    response; a null or broken url has an empty key; other columns are left out; no pages give no rows.
    """
    folder, pages = new_path(spark, "warc"), table(spark, sf_dir, "pages")
    directory = write_index(write_archives(pages, folder), folder)
    return read_records(look_up(pages.select("url", "page_id"), directory, folder), folder)


#: The same without archives. Base32 of a SHA-1: each 5 of its 40 hex digits are 4 base32 digits.
OP5_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), f as (select html, min(page_id) as first from p group by html
), v as (select p.page_id, p.html, first, list_transform(range(8), lambda i: cast('0x' || substr(h, 5 * i + 1, 5) as bigint)) as g from p join f on p.html = f.html
)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(g, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 10) % 32 + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x % 32 + 1, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to
from v
"""
