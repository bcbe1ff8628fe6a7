import zlib
from collections import Counter

import pytest

from icdforge.llm import sharding


@pytest.mark.parametrize("frame", ["docs_small", "awkward", "no_docs"])
def test_rows_law_and_mixture(request, frame):
    docs = request.getfixturevalue(frame)
    rows = sharding.interleave(docs, shards=16).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    n = Counter(r["shard"] for r in rows)
    counts = [n[s] for s in range(16)]
    assert max(counts) - min(counts) <= 1
    for s in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n[s]))
    # every shard holds each source in proportion, to within two rows
    for src, total in Counter(r["source"] for r in rows).items():
        for s in range(16):
            assert abs(sum(1 for r in rows if r["shard"] == s and r["source"] == src) - total / 16) < 2
    # the order is that of the fractional rank
    order = [r["fraction"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_sources_of_one_row_spread_over_all_shards(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1_300, "hot").otherwise(F.col("id").cast("string")).alias("source"), F.lit("t").alias("text"))
    rows = sharding.interleave(docs, shards=16).collect()
    single = [r for r in rows if r["source"] != "hot"]
    cells = Counter(int(r["fraction"] * 16) for r in single)
    assert len(cells) == 16 and max(cells.values()) < 1.4 * len(single) / 16
    assert all(0 <= r["fraction"] < 1 for r in rows)
    per_shard = Counter(r["shard"] for r in rows if r["source"] == "hot")
    assert max(per_shard.values()) < 1.2 * 1_300 / 16 and min(per_shard.values()) > 0.8 * 1_300 / 16


def test_seed_decides(docs_small):
    a, b, c = ({(r["doc_id"], r["shard"], r["slot"]) for r in sharding.interleave(docs_small, seed=s).collect()} for s in (1, 1, 2))
    assert a == b != c


def test_plan_has_no_python(docs_small):
    plan = sharding.interleave(docs_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
