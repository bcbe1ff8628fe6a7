import base64
import hashlib
import os
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from icdforge.llm import warc
from icdforge.llm.queries import ORACLE_SQL  # noqa: F401


def brute(rows):
    first = {}
    for p, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    out, used = Counter(), set()
    for p, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (h or "").encode()
        kind = "response" if (h or "") not in used else "revisit"
        used.add(h or "")
        out[(p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), kind, None if kind == "response" else first.get(h or ""))] += 1
    return out


COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = warc.archive_pages(pages)
    assert Counter(tuple(r[c] for c in COLS) for r in got.collect()) == brute([(r["page_id"], r["html"]) for r in pages.collect()])
    back = {r["page_id"]: bytes(r["payload"]).decode() for r in got.filter("record_type = 'response'").collect()}
    assert all(back[r["page_id"]] == r["html"] for r in pages.collect() if r["page_id"] in back)


def test_awkward_pages(spark):
    rows = [(1, "u", "x"), (2, None, "x"), (3, "a\r\nb: c", None), (4, "u", ""), (4, "u", ""), (None, "u", "x"), (None, "u", "alone"), (5, "ü", "é\x00\r\n\r\nWARC/1.1"), (6, "u", "z" * 3_000_000), (7, "u", "z" * 3_000_000)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"kind": F.lit(1), "digest": F.lit(1)})
    path = os.path.join(spark.conf.get("spark.checkpoint.dir"), "warc-awkward")
    spark.createDataFrame(d.collect(), d.schema).write.mode("overwrite").parquet(path)
    got = warc.archive_pages(spark.read.parquet(path), spec=warc.WarcSpec(archive_bytes=1000))
    assert Counter(tuple(r[c] for c in COLS) for r in got.collect()) == brute([(p, h) for p, _, h in rows])
    assert warc.archive_pages(spark.read.parquet(path).limit(0)).collect() == []


def test_small_payloads_are_never_revisits(spark):
    d = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long enough"), (4, "u", "long enough")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archive_pages(d, spec=warc.WarcSpec(min_bytes=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_archive_layout():
    """A skippable dictionary frame first, then a frame for each record that a
    plain reader with that dictionary can decode on its own."""
    spec = warc.WarcSpec()
    recs = [warc.record("response", f"{i}:{i}", "http://x", (f"<html><p>page {i} " + "common words of every page " * 20).encode(), "D", None, spec) for i in range(300)]
    data = warc.archive(recs, spec)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    assert data[8:12] == warc.DICTIONARY_MAGIC
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    view, at, out = memoryview(data), 8 + size, []
    while at < len(data):
        end = warc.frame_end(view, at)
        out.append(d.decompress(view[at:end]))
        at = end
    assert out == recs
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in recs)
    assert len(data) - 8 - size < plain


def test_damage_is_found():
    spec = warc.WarcSpec()
    data = bytearray(warc.archive([warc.record("response", "1:1", "u", b"payload" * 50, "X", None, spec)], spec))
    data[-6] ^= 1
    with pytest.raises(zstandard.ZstdError):
        list(warc.read_archive(bytes(data)))
