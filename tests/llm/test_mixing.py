import numpy as np
import pytest
from pyspark.sql import functions as F

from icdforge.llm import mixing


def brute_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        ws = sum(w[s] for s in order if s not in capped)
        t = {s: 3 * sizes[s] if s in capped else rest * w[s] / ws for s in order}
        new = {s for s in order if t[s] > 3 * sizes[s] + 1e-9} - capped
        if not new:
            return t
        capped |= new


def test_targets():
    for sizes in ({"a": 10, "b": 1000, None: 5}, {"b": 1, "a": 1, "c": 0}, {"x": 7}, {None: 0}, {}):
        got = mixing.source_targets(sizes)
        assert got == pytest.approx(brute_targets(sizes)) if sizes else got == {}
        assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_tree_splits_quotas_exactly():
    q = np.array([1000, 3, 0, 250, 77])
    got = mixing.split_quotas(q, 16, 7)
    assert (got.sum(0) == q).all() and got.min() >= 0
    assert got.sum(1).max() - got.sum(1).min() <= 1
    assert (got == mixing.split_quotas(q, 16, 7)).all()


@pytest.mark.parametrize("frame", ["docs_small", "awkward"])
def test_plan(request, frame):
    docs = request.getfixturevalue(frame)
    plan, blocks = mixing.mix_plan(docs)
    rows = plan.collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert 0 <= len(r["places"]) == r["copies"] <= 3 and (r["size"] or not r["copies"])
        by.setdefault(r["source"], []).append(r)
    want = brute_targets({s: sum(r["size"] for r in v) for s, v in by.items()})
    for s, v in by.items():
        assert v[0]["target"] == pytest.approx(want[s])
        small = min((r["size"] for r in v if r["size"]), default=0)
        assert abs(sum(r["copies"] * r["size"] for r in v) - want[s]) <= max(small, .02 * want[s], 1) + max((r["size"] for r in v), default=0) * .5
    placed = mixing.mix_rows(plan, blocks)
    assert placed.count() == sum(r["copies"] for r in rows)
    # a block goes to one shard
    assert placed.groupBy("skey", "block").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    again, _ = mixing.mix_plan(docs)
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["size"], r["copies"])
    assert sorted(map(key, again.collect()), key=str) == sorted(map(key, rows), key=str)


def test_mixed_documents_keep_columns(docs_small, no_docs):
    d = docs_small.withColumns({"shard": F.lit("x"), "size": F.lit(1)})
    out = mixing.mix_documents(d)
    assert out.columns == d.columns
    plan, _ = mixing.mix_plan(d, identity=d.columns)
    assert out.groupBy("doc_id").count().exceptAll(plan.filter("copies > 0").select("doc_id", F.col("copies").cast("long"))).count() == 0
    assert mixing.mix_documents(no_docs).collect() == []
    twice = docs_small.limit(30).union(docs_small.limit(30)).union(docs_small.limit(30).withColumn("lang", F.lit(None).cast("string")))
    plan, _ = mixing.mix_plan(twice, identity=twice.columns)
    assert mixing.mix_documents(twice).count() == plan.agg(F.sum("copies")).first()[0]


@pytest.mark.parametrize("seed", [3, 9])
def test_a_very_long_document_at_the_quota_leaves_no_gap(spark, seed):
    """The document that overflows the quota is longer than eight others: the rest is filled by as many as fit."""
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(["w"] * int(n)), "b" if i < 2000 else "a") for i, n in enumerate(rng.integers(20, 200, 2600))]
    docs = spark.createDataFrame([*rows, (9999, "w " * 60000, "b")], "doc_id long, text string, source string")
    plan, blocks = mixing.mix_plan(docs, mixing.MixSpec(seed=seed))
    got = [r for r in plan.collect() if r["source"] == "b"]
    assert [r["copies"] for r in got if r["size"] == 60000] == [0]
    gap = got[0]["target"] - sum(r["copies"] * r["size"] for r in got)
    assert 0 <= gap <= .002 * got[0]["target"] + 1 or gap < min(r["size"] for r in got if not r["copies"])
    # what fills the gap is spread over its blocks, not put into one
    block = -(-sum(len(t.split()) for _, t, _ in [*rows, (0, "w " * 60000, "")]) // (16 * 256))
    per = {}
    for r in got:
        for p in r["places"]:
            per[p["block"]] = per.get(p["block"], 0) + r["size"]
    assert max(per.values()) <= 2 * block + 4 * 200 + 200


@pytest.mark.parametrize("frame", ["docs_small", "awkward", "no_docs"])
def test_taken_words_come_from_the_drawn_blocks(request, frame):
    """Shards' blocks equal a replay of the tree and the permutations; every taken word lies in one of them."""
    docs, spec = request.getfixturevalue(frame), mixing.MixSpec()
    plan, blocks = mixing.mix_plan(docs, spec)
    plan, dealt = plan.collect(), blocks.collect()
    quotas = {}
    for r in dealt:
        quotas[r["skey"]] = quotas.get(r["skey"], 0) + 1
    keys = sorted({r["skey"] for r in plan})
    counts = mixing.split_quotas(np.array([quotas.get(k, 0) for k in keys], np.int64), spec.shards, spec.seed) if keys else None
    replay = {}
    for i, k in enumerate(keys):
        perm = np.random.default_rng([spec.seed, 1, i]).permutation(quotas.get(k, 0))
        replay.update({(k, int(b)): int(s) for b, s in zip(perm, np.repeat(np.arange(spec.shards), counts[:, i]))})
    assert {(r["skey"], r["block"]): r["shard"] for r in dealt} == replay
    want = sorted(((r["doc_id"], r["size"], len(r["places"]) * r["size"], sorted(replay[r["skey"], p["block"]] for p in r["places"])) for r in plan), key=str)
    got = mixing.mixture(docs, spec).collect()
    assert sorted(((r["doc_id"], r["size"], r["taken"], list(r["shards"])) for r in got), key=str) == want
    places = sorted((s, p) for r in got for s, p in zip(r["shards"], r["positions"]))
    for s in {s for s, _ in places}:
        own = [p for t, p in places if t == s]
        assert own == list(range(len(own)))


def test_clashing_names_are_kept(spark, docs_small):
    from icdforge.llm import langid, quality, simhash

    names = ["__p", "__row", "__id", "__h", "__key", "__shard", "__words", "__lines", "__wins", "__sorted", "__twice", "__l", "__s", "__digest", "__q_kept", "__m0", "__y0", "input__p"]
    d = docs_small.limit(80).withColumns({n: F.lit(n) for n in names})
    for operator in (langid.language_documents, quality.quality_documents, simhash.deduplicate, mixing.mix_documents):
        out = operator(d)
        assert out.columns == d.columns
        assert {tuple(r) for r in out.select(*names).distinct().collect()} <= {tuple(names)}
