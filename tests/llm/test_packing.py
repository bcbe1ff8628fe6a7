import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from icdforge.llm import packing

SPEC = packing.PackSpec()


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab Z'’\n\t\x0b \u3000é1.,!日\U0001f600 <|>", "<|endoftext|>", "<|endoftext", "  "]), max_size=40).map("".join))
def test_ids_equal_the_tokenizer(text):
    t = test_ids_equal_the_tokenizer.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    code = packing.encoder(SPEC)
    assert code.ids(code.encode(text)).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def check(rows, ids_of, window=2048):
    """Every id in one piece, checksums, gapless sequences, at most one short window."""
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
    assert set(docs) == set(ids_of)
    for d, v in docs.items():
        ids, at = ids_of[d], 0
        for r in sorted(v, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append(r)
    short = 0
    for v in seqs.values():
        at = 0
        for r in sorted(v, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        short += at < window
    assert short <= 1


def test_whole_tables(spark, docs_small, awkward, reference):
    rows = packing.pack(docs_small).collect()
    check(rows, {r["doc_id"]: reference(r["text"]) for r in docs_small.collect()})
    odd = awkward.withColumn("doc_id", F.monotonically_increasing_id())
    check(packing.pack(odd).collect(), {r["doc_id"]: reference(r["text"]) for r in odd.collect()})
    assert packing.pack(awkward).filter("doc_id = 5").count() >= 2


def test_ids_are_kept(docs_small, reference):
    want = {r["doc_id"]: reference(r["text"]) for r in docs_small.limit(20).collect()}
    for r in packing.pack(docs_small.limit(20), keep_ids=True).filter("ids is not null").collect():
        assert bytes(r["ids"]) == want[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()


def test_hot_length_and_very_long_text(spark, reference):
    long = " ".join(f"tok{i}" for i in range(60_000))
    rows = [(i, "same words here again " * 250) for i in range(300)] + [(1000 + i, "x " * (i + 1)) for i in range(40)] + [(5000, long)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(packing.pack(d).collect(), {i: reference(t) for i, t in rows})


def test_empty_table(no_docs):
    assert packing.pack(no_docs).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.lists(st.tuples(st.integers(1, 40), st.integers(1, 4)), max_size=5, unique_by=lambda x: x[0]))
def test_closest_fill_is_the_best(room, available):
    sums = {0}
    for k, n in available:
        sums = {s + k * i for s in sums for i in range(n + 1) if s + k * i <= room}
    got = packing.closest_fill(room, sorted(available, reverse=True))
    assert sum(k * n for k, n in got.items()) == max(sums)
    assert all(n <= dict(available)[k] for k, n in got.items())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 50), max_size=12))
def test_plan_places_every_remainder(histogram):
    plan = packing.plan_windows(histogram, 32)
    placer = packing.Placer(plan)
    fill, spots = Counter(), defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            at = 0
            for start, size, window, offset in placer.pieces(length, rank):
                assert start == at
                at += size
                fill[window] += size
                spots[window].append((offset, size))
            assert at == length
    assert set(fill) == set(range(plan.windows))
    assert sum(v < 32 for v in fill.values()) <= 1 and max(fill.values(), default=0) <= 32
    for v in spots.values():
        at = 0
        for offset, size in sorted(v):
            assert offset == at
            at += size
