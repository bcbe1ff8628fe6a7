"""The pipeline stage by stage on sf0.001 and on a table of awkward rows:
every stage against its operator's digest or a brute-force version."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from icdforge.llm import langid, mixing, quality, simhash

from .test_packing import check
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def stages(spark, docs, path):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.mode("overwrite").parquet(f"{path}/{name}")
        out.append(spark.read.parquet(f"{path}/{name}"))
    return out


@pytest.mark.parametrize("frame", ["docs_small", "awkward", "no_docs"])
def test_stages(request, spark, tmp_path, frame):
    start = request.getfixturevalue(frame).withColumns({"__x": F.lit(1), "size": F.lit("s"), "kept": F.lit(None).cast("string")})
    docs, lang, good, unique, mixed, packed = stages(spark, start, str(tmp_path))
    for t in (lang, good, unique, mixed):
        assert t.columns == start.columns
    rows = lambda t: Counter((r["doc_id"], r["text"]) for r in t.collect())

    model = langid.train(docs, ~langid.held_out(F.col("doc_id")))
    p = docs.withColumn("p", langid.predict(F.coalesce("text", F.lit("")), model)).filter("p.lang <> 'und' and not p.ambiguous")
    assert rows(lang) == rows(p)

    verdict = Counter((r["doc_id"], r["n_words"]) for r in quality.robust_rules(lang).filter("kept").collect())
    assert Counter((d, len([w for w in t.replace("\x1c", "_").split()])) for (d, t), n in rows(good).items() for _ in range(n)).total() == verdict.total()
    assert set(d for d, _ in rows(good)) == set(d for d, _ in verdict)

    kept = good.collect()
    fps = {r["doc_id"]: brute_fp(r["text"]) for r in kept}
    comp = brute_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for d, f in fps.items():
        low[comp[f]] = min(low.get(comp[f], d), d)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(low.values())

    plan, _ = mixing.mix_plan(unique, identity=unique.columns)
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({r["doc_id"]: r["copies"] for r in plan.collect() if r["copies"]})

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r["doc_id"]: (len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1, n) for r, n in Counter(mixed.collect()).items()}
    placed = Counter()
    for r in packed.collect():
        placed[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == tokens[r["doc_id"]][0]
    assert placed == Counter({d: n * k for d, (n, k) in tokens.items()})


def test_run_is_registered_and_returns_the_last_stage(spark):
    q = __spark_entry__.queries()
    assert [n for n in q if n.startswith("op")] == sorted((n for n in q if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0])) and len([n for n in q if n.startswith("op")]) == 13
    out = q["pipeline"](spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_clean_documents_survive_the_filters(spark):
    """Labelled-clean documents of 60 words and more."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    clean = docs.join(labels, "doc_id", "left_semi").filter(F.size(F.split("text", " ")) > 60)
    kept = quality.quality_documents(langid.language_documents(docs)).join(clean, "doc_id", "left_semi")
    assert kept.count() >= .98 * clean.count()


def test_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    symbols = docs.filter(F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")) > .1 * F.size(F.split("text", " ")))
    assert symbols.count() > 10
    kept = {r["doc_id"]: r["kept"] for r in quality.robust_rules(docs).collect()}
    assert np.mean([kept[r["doc_id"]] for r in symbols.collect()]) < .1
