import hashlib
import random
import zlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from icdforge.llm import convtree

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


def brute_force(rows):
    """The contract, node by node."""
    own = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below)]
        ends = ",".join(map(str, sorted(c for c in who if len(rebuilt[c]) == len(node))))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), len(childless),
                    sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, extra=False):
    df = spark.createDataFrame(rows, TURNS)
    if extra:
        for name in ("depth", "k1", "pos", "digest", "row", "part", "bytes", "scan", "n", "base", "h"):
            df = df.withColumn(name, F.lit("x"))
    return sorted((tuple(r) for r in convtree.conversation_trie(df).collect()), key=str)


def test_trie_of_awkward_conversations_equals_brute_force(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "bot", "yes"), (0, 2, "user", "ümlaut"), (0, 3, None, None), (0, 4, "", ""),
        (1, 0, "user", "hi"), (1, 1, "bot", "yes"), (1, 2, "user", "else"), (2, None, "user", "first"), (2, 0, "user", "hi"), (2, 0, "user", "hi"),
        (3, 5, "bot", "b"), (3, 5, "bot", "a"), (3, 5, "a", "z"), (None, 0, "user", "no conversation"),
        (7, 0, "user", "x"), (8, 0, "us", "erhi"), (9, 0, "use", "rhi"), (10, 0, "user", "hi"), (14, 0, "user", "hi"), (-7, 0, "user", "hi"), (-5, 0, "user", "hi"),
        (123456789012, 0, "user", "hi"), *((20 + i, j, "user", f"t{j % 2}") for i in range(10) for j in range(12)),
    ]
    expected = brute_force(rows)
    assert trie(spark, rows) == expected
    assert trie(spark, rows, extra=True) == expected


def test_long_conversations_are_cut_up(spark, monkeypatch):
    monkeypatch.setattr(convtree, "POSITIONS_PER_BUCKET", 7)
    monkeypatch.setattr(convtree, "IDS_PER_ROW", 3)
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "bot"]), r.choice(["a", "b"])) for c in range(0, 60, 5) for t in range(r.randrange(1, 20))]
    rows += [(1000, t, "user", "same") for t in range(150)] + [(1001, t, "user", "same") for t in range(140)] + [(2000 + 5 * c, 0, "user", "a") for c in range(40)]
    assert trie(spark, rows) == brute_force(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []


def test_subtree_totals_of_chains_stars_and_random_trees(spark):
    r = random.Random(5)
    parent = {}
    for k in range(1, 400):
        parent[k] = k - 1  # a chain
    for k in range(1000, 1300):
        parent[k] = 17  # a star on it
    for k in range(2001, 2400):
        parent[k] = r.randrange(2000, k)  # a random tree of its own
    nodes = sorted({*parent, *parent.values()})
    depth = {}
    for k in nodes:
        depth[k] = depth[parent[k]] + 1 if k in parent else 0
    total = {k: k % 7 for k in nodes}
    for k in sorted(nodes, key=lambda k: -depth[k]):
        if k in parent:
            total[parent[k]] += total[k]
    rows = [(k, depth[k], parent.get(k), depth[parent[k]] if k in parent else None, k % 7) for k in nodes]
    forest = spark.createDataFrame(rows, "a long, b long, pa long, pb long, t long")
    got = {x["a"]: x["t"] for x in convtree.subtree_totals(forest, ["t"], "test", max_rounds=60).collect()}
    assert got == total
