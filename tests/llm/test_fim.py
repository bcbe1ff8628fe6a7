import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from icdforge.llm import fim, queries
from icdforge.llm.wavelet import WaveletMatrix


def brute_force(doc_id, text, unit="character"):
    text = text or ""
    g = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(g[8 * i:8 * i + 8], 16) for i in range(4)]
    if unit == "character":
        starts = list(range(len(text)))
    else:
        blanks = " \t\n\x0b\x0c\r"
        starts = [i for i, c in enumerate(text) if c not in blanks and (i == 0 or text[i - 1] in blanks)]
    n = len(starts)
    at = lambda k: 0 if k == 0 else len(text) if k == n else starts[k]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:at(a)], text[at(a):at(b)], text[at(b):]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["character", "word"])
def test_transform_equals_brute_force(spark, awkward, unit):
    r = random.Random(2)
    odd = ["<", "<P", "P>", "S>", "a<P>b", "<S>", "x<M>", "é<", "😀" * 5, "日本 語\n", "\x00", "ab" * 60_000 + "é" * 50_000]
    rows = [(k, r.choice(odd) + "".join(r.choice("ab é日😀\n<PSM>") for _ in range(r.randrange(0, 30))), None, None, None) for k in range(400)]
    rows += [(None, None, None, None, None), (1, "", None, None, None), (1, "", None, None, None)]
    docs = awkward.union(spark.createDataFrame(rows, awkward.schema))
    docs = docs.withColumn("h1", F.lit("x")).withColumn("form", F.lit(None).cast("string")).withColumn("output", F.lit(1)).withColumn("n", F.lit(0))
    got = fim.transform(docs, fim.FimSpec(unit=unit, run_bytes=300))
    expected = [brute_force(x["doc_id"], x["text"], unit) for x in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    back = got.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((x["doc_id"], x["text"] or "") for x in docs.collect()), key=str)


def test_no_documents(no_docs):
    assert fim.transform(no_docs).count() == 0


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    got = sorted(map(tuple, queries.op13_fill_in_middle(spark, path).collect()))
    assert got == sorted(con.execute(queries.ORACLE_SQL["op13_fill_in_middle"]).fetchall())


def test_wavelet_ranks_and_selects():
    r = np.random.default_rng(4)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = r.integers(0, 7, size).astype(np.uint8)
        matrix, at = WaveletMatrix(symbols, 3), np.arange(size + 1)
        for s in range(8):
            assert (matrix.rank(s, at) == np.concatenate([[0], np.cumsum(symbols == s)])).all()
        for wanted in ((0,), (1, 2, 3, 4, 5, 6), (2, 6)):
            places = np.flatnonzero(np.isin(symbols, wanted))
            k = np.arange(len(places) + 1)
            got = matrix.select(wanted, k, np.zeros(len(k)), np.full(len(k), size))
            assert (got == np.concatenate([[0], places + 1])).all()
