"""WARC archives with per-record Zstandard frames and an embedded dictionary.

Pages become WARC/1.1 records; of pages with equal payloads one is written as
``response`` and the others as ``revisit`` records that refer to it.  An
archive file starts with a skippable frame that holds a Zstandard dictionary
built from its own records; every record is a frame of its own, so readers can
seek to any record.

Pages are digested, the first page of every digest is found on rows without
payloads, and each page meets it by its own page_id and digest; each task sorts its pages and writes archives of bounded size, buffering one at a
time.  Files are written under a temporary name and renamed, and contents
depend on the rows alone, so a repeated task leaves the same files.  The folder
lies in the shared checkpoint folder unless the caller gives one, and is
reached with pyarrow's file systems (file, hdfs, s3, gs).  Archives are read
back by Spark's binaryFile source, one bounded file at a time.

Defined results: null html is an empty payload; a null url is written as
``urn:none``; null page_ids are kept, written as ``null``, and come last when
the first page of a payload is chosen; of rows repeated in full one is the
response; payloads under ``min_bytes`` are never revisits; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icdforge.session import checkpoint_dir

from .common import materialize, ship

SKIPPABLE = 0x184D2A5D
DICTIONARY_MAGIC = (0xEC30A437).to_bytes(4, "little")


@dataclass(frozen=True)
class WarcSpec:
    archive_bytes: int = 16 << 20
    dictionary_bytes: int = 32 << 10
    #: bytes of an archive's records that its dictionary is trained on, at most
    sample_bytes: int = 1 << 20
    level: int = 3
    min_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(version: str, fields: list[tuple[str, str]]) -> bytes:
    return (version + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(kind: str, ident: str, url: str | None, payload: bytes, digest: str, refers: str | None, spec: WarcSpec) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and drops the payload."""
    http = _headers("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    body = http + (payload if kind == "response" else b"")
    target = "".join(c for c in url if c >= " ") if url else "urn:none"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{ident}>"), ("WARC-Date", spec.date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return _headers("WARC/1.1", fields) + body + b"\r\n\r\n"


def build_dictionary(records: list[bytes], spec: WarcSpec) -> bytes:
    """A dictionary from evenly spaced records; the sampled bytes themselves
    where there are too few to train on."""
    take, step = [], max(1, sum(map(len, records)) // max(1, spec.sample_bytes))
    room = spec.sample_bytes
    for r in records[::step]:
        piece = r[:min(room, 64 << 10)]
        take.append(piece)
        room -= len(piece)
        if room <= 0:
            break
    try:
        return zstandard.train_dictionary(spec.dictionary_bytes, take, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(take)[-spec.dictionary_bytes:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    kind = zstandard.DICT_TYPE_FULLDICT if content[:4] == DICTIONARY_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(content, dict_type=kind)


def archive(records: list[bytes], spec: WarcSpec) -> bytes:
    content = build_dictionary(records, spec)
    d = _dictionary(content)
    d.precompute_compress(level=spec.level)
    press = zstandard.ZstdCompressor(level=spec.level, dict_data=d, write_checksum=True, write_content_size=True)
    head = SKIPPABLE.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
    return head + b"".join(press.compress(r) for r in records)


def frame_end(buf: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends."""
    flags = buf[at + 4]
    at += zstandard.frame_header_size(buf[at:at + 18])
    last = False
    while not last:
        head = int.from_bytes(buf[at:at + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + (4 if flags & 4 else 0)


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(WARC header fields, block) of every record, one frame at a time."""
    if int.from_bytes(content[:4], "little") != SKIPPABLE:
        raise ValueError("no dictionary frame")
    size = int.from_bytes(content[4:8], "little")
    plain = zstandard.ZstdDecompressor(dict_data=_dictionary(content[8:8 + size]))
    view, at = memoryview(content), 8 + size
    while at < len(view):
        end = frame_end(view, at)
        data = plain.decompress(view[at:end])
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        yield fields, rest[:int(fields["Content-Length"])]
        at = end


def with_record_types(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """page_id, url, html, rid, kind and the first page of equal payloads
    (``first_id``, ``first_rid``).  The first page is told by its page_id;
    only where that page's row is repeated does its number in the scan decide,
    so ``pages`` must be a stored table then.

    First pages are found and met on rows without payloads; the payloads travel
    once, by page and digest, so the copies of a hot page are spread evenly."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.monotonically_increasing_id().alias("rid")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rid")
    each = rows.groupBy("digest", "page_id").agg(F.min("rid").alias("rid"), F.count("*").alias("n"))
    first = each.groupBy("digest").agg(F.min(order).alias("first"), F.min_by("n", order).alias("n_first"))
    types = each.select("digest", "page_id").join(first, "digest").select(F.col("digest").alias("of"), F.col("page_id").alias("page"), "first", "n_first")
    met = rows.join(types, (F.col("digest") == F.col("of")) & F.col("page_id").eqNullSafe(F.col("page")))
    leads = F.when(F.col("n_first") == 1, F.col("page_id").eqNullSafe(F.col("first.page_id"))).otherwise(F.col("rid") == F.col("first.rid"))
    alone = (F.octet_length("html") < spec.min_bytes) | leads
    return met.select("page_id", "url", "html", "rid", F.when(alone, "response").otherwise("revisit").alias("kind"), F.col("first.page_id").alias("first_id"), F.col("first.rid").alias("first_rid"))


def _put(folder: str, name: str, content: bytes) -> None:
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    hidden = posixpath.join(base, f".{name}.{uuid.uuid4().hex}")
    with fs.open_output_stream(hidden) as f:
        f.write(content)
    fs.move(hidden, posixpath.join(base, name))


def write_archives(pages: DataFrame, folder: str | None = None, spec: WarcSpec = WarcSpec()) -> tuple[str, DataFrame]:
    """(folder, manifest): the archives' folder and one row per file."""
    spark = pages.sparkSession
    where = folder or f"{checkpoint_dir(spark).rstrip('/')}/icdforge-llm/warc-{uuid.uuid4().hex}"

    ship()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        schema = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:05d}.warc.zst"
            content = archive(held, spec)
            _put(where, name, content)
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [len(held)], "bytes": [len(content)]}, schema)

        for batch in batches:
            for r in zip(*(batch.column(c) for c in ("page_id", "url", "html", "rid", "kind", "first_id", "first_rid"))):
                page, url, html, rid, kind, first, first_rid = (x.as_py() for x in r)
                payload = html.encode()
                name = lambda p, i: f"{'null' if p is None else p}:{i}"
                held.append(record(kind, name(page, rid), url, payload, sha1_base32(payload), name(first, first_rid), spec))
                size += len(held[-1])
                if size >= spec.archive_bytes:
                    yield flush()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield flush()

    typed = with_record_types(pages, spec).sortWithinPartitions("page_id", "rid")
    return where, materialize(typed.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes,
    payload_digest, record_type, refers_to, target_uri, payload (null for
    revisits).  A payload that does not match its digest fails the read."""
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, payload binary"
    types = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()), ("payload", pa.binary())]

    ship()

    def page(urn: str | None) -> int | None:
        text = urn[len("<urn:page:"):-1].rpartition(":")[0] if urn else "null"
        return None if text == "null" else int(text)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, block in read_archive(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = fields["WARC-Type"] == "response"
                    if whole and (len(payload) != length or sha1_base32(payload) != digest):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    rows.append((page(fields["WARC-Record-ID"]), length, digest, fields["WARC-Type"], page(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"], payload if whole else None))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], schema=pa.schema(types))
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], schema=pa.schema(types))

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(parse, kind)


def archive_pages(pages: DataFrame, folder: str | None = None, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write the pages' archives and read them back."""
    where, manifest = write_archives(pages, folder, spec)
    if manifest.isEmpty():
        return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, payload binary")
    return read_archives(pages.sparkSession, where)
