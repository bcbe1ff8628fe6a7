"""Toxicity: a counterfactual-regularised word classifier.

A logistic regression on the presence of words and word beginnings (inflected
and compound forms share theirs), with a penalty on the change
of its score when identity terms in a labelled text are swapped for another
term of the same group: a neutral mention of a group then scores like the
mention of any other, whatever the labelled rows suggest.

It is fitted on a bounded sample of labelled rows: at most about
``rows_per_class`` whole texts per label, chosen by a hash of doc_id (the
sampled ids are broadcast: bounded by twice that number).  Words are counted
on Spark, the ``words`` most telling ones are kept, and the driver gets the
sample's word numbers only.  Scoring reads whole texts of all rows.

Defined results: null and empty texts get the score of a text without any
word; a doc_id labelled twice counts as toxic if any label says so; null
labels and null doc_ids are not learned from; a null doc_id counts as an empty
one for the split; without labels of both kinds every score is the share of
toxic labels (0 without labels); repeated rows get equal results; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, text_of
from .texts import byte_slices

#: groups of terms that may stand for one another
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"), ("americans", "mexicans", "germans", "french", "chinese", "africans"),
    ("old", "young"), ("elderly", "teenagers"), ("disabled", "deaf", "blind"),
)


@dataclass(frozen=True)
class ToxicSpec:
    rows_per_class: int = 8000
    words: int = 4096
    #: a word counts if its share differs between the labels by so many standard errors
    telling: float = 5.0
    #: words that are taken however few differ that much
    least_words: int = 16
    l2: float = 1e-6
    #: weight of the squared change of the score under a swap
    counterfactual: float = 5.0
    steps: int = 1000
    threshold: float = 0.7
    seed: int = 9


_FOLD = bytes(c | 32 if 65 <= c <= 90 or 97 <= c <= 122 else c if c >= 128 else 32 for c in range(256))


def words_of(data: np.ndarray) -> set[bytes]:
    """Distinct words: runs of letters, ASCII case folded."""
    return set(data.tobytes().translate(_FOLD).split())


#: lengths, in bytes, of the word beginnings that are features besides the words
BEGINNINGS = (4, 5, 6, 7, 8, 9)


def features(words: set[bytes]) -> set[bytes]:
    out = set(words)
    for n in BEGINNINGS:
        out |= {w[:n] + b"*" for w in words if len(w) > n}
    return out


def swap(words: set[bytes], groups=IDENTITY_GROUPS) -> set[bytes]:
    """The words with every identity term replaced by the next of its group."""
    change = {a.encode(): b.encode() for g in groups for a, b in zip(g, g[1:] + g[:1])}
    return {change.get(w, w) for w in words}


@dataclass
class ToxicModel:
    index: dict[bytes, int]
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.heads = {w[:BEGINNINGS[0]] for w in self.index}

    def score(self, words: set[bytes]) -> float:
        words = {w for w in words if w[:BEGINNINGS[0]] in self.heads}  # no other word has a feature
        z = self.bias + sum(self.weights[self.index[w]] for w in features(words) & self.index.keys())
        return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))


def fit(index: dict[bytes, int], rows: list[tuple[int, list[int], list[int]]], importance: dict[int, float], spec: ToxicSpec) -> ToxicModel:
    """rows: (label, word numbers, word numbers after the swap)."""
    y = np.array([r[0] for r in rows], float)
    r = np.repeat(np.arange(len(rows)), [len(x[1]) for x in rows])
    c = np.array([i for x in rows for i in x[1]], int)
    pairs = [k for k, x in enumerate(rows) if x[1] != x[2]]
    dr = np.array([k for k, p in enumerate(pairs) for _ in (*rows[p][1], *rows[p][2])], int)
    dc = np.array([i for p in pairs for i in (*rows[p][1], *rows[p][2])], int)
    dv = np.array([s for p in pairs for s in (*[1.0] * len(rows[p][1]), *[-1.0] * len(rows[p][2]))])
    weight = np.array([importance[int(v)] for v in y])
    weight /= weight.sum()
    # words that speak for label 1 start from their log odds, the others from 0
    on = [np.bincount(c, (weight * side)[r], len(index)) / max(weight @ side, 1e-12) for side in (1 - y, y)]
    w = np.maximum(0.0, np.log(on[1] + 0.5 / len(y)) - np.log(on[0] + 0.5 / len(y)))
    for g in IDENTITY_GROUPS:  # which must not start from what a sample happens to say of them
        w[[index[t.encode()] for t in g if t.encode() in index]] = 0.0
    b = float(np.log((weight @ y + 1e-6) / (weight @ (1 - y) + 1e-6)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, spec.steps + 1):
        e = weight * (1 / (1 + np.exp(-(np.bincount(r, w[c], len(y)) + b))) - y)
        g = np.append(np.bincount(c, e[r], len(w)) + spec.l2 * w, e.sum())
        if pairs:
            change = np.bincount(dr, dv * w[dc], len(pairs))
            g[:-1] += 2 * spec.counterfactual / len(pairs) * np.bincount(dc, dv * change[dr], len(w))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return ToxicModel(index, w, b)


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def train(docs: DataFrame, labels: DataFrame, learn: Column, spec: ToxicSpec = ToxicSpec()) -> ToxicModel | float:
    """A model, or a constant score where the labels are all of one kind."""
    known = labels.filter(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    if len(n) < 2:
        return float(max(n, default=0))
    rate = F.when(F.col("toxic") == 1, min(1.0, spec.rows_per_class / n[1])).otherwise(min(1.0, spec.rows_per_class / n[0]))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(spec.seed), "doc_id"), F.lit(1_000_003)) / 1_000_003.0 < rate)
    sample = materialize(docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxic-sample")

    ship()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        schema = pa.schema([("word", pa.binary()), ("n0", pa.int64()), ("n1", pa.int64())])

        def flush():
            keys = [*(seen[0].keys() | seen[1].keys())]
            out = pa.RecordBatch.from_pydict({"word": keys, "n0": [seen[0][k] for k in keys], "n1": [seen[1][k] for k in keys]}, schema)
            for s in seen:
                s.clear()
            return out

        for batch in batches:
            data, offs = byte_slices(batch.column("text"))
            for k, t in enumerate(batch.column("toxic").to_pylist()):
                seen[t].update(features(words_of(data[offs[k]:offs[k + 1]])))
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield flush()
        yield flush()

    words = sample.mapInArrow(count, "word binary, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return float(max(size, default=0))
    a, b = F.col("n1") / size[1], F.col("n0") / size[0]
    mean = (F.col("n0") + F.col("n1")) / (size[0] + size[1])
    errors = F.abs(a - b) / F.sqrt((mean * (1 - mean) + F.lit(1e-9)) * (1 / size[0] + 1 / size[1]))
    ranked = words.filter(F.length("word") <= 40).select("word", errors.alias("z")).orderBy(F.desc("z"), "word").limit(spec.words).collect()
    top = [r for i, r in enumerate(ranked) if r["z"] >= spec.telling or i < spec.least_words]
    identity = [w.encode() for g in IDENTITY_GROUPS for w in g]
    index = {w: i for i, w in enumerate(dict.fromkeys([*(bytes(r["word"]) for r in top), *identity]))}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("toxic", pa.int32()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
        for batch in batches:
            data, offs = byte_slices(batch.column("text"))
            own, swapped = [], []
            for k in range(batch.num_rows):
                w = words_of(data[offs[k]:offs[k + 1]])
                own.append(sorted(index[x] for x in features(w) & index.keys()))
                swapped.append(sorted(index[x] for x in features(swap(w)) & index.keys()))
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic").cast(pa.int32()), "a": own, "b": swapped}, schema)

    rows = sorted((r["toxic"], list(r["a"]), list(r["b"])) for r in sample.mapInArrow(number, "toxic int, a array<int>, b array<int>").collect())  # at most two samples of rows_per_class
    return fit(index, rows, {k: n[k] / size[k] for k in size}, spec)


def score_texts(text: Column, model: ToxicModel | float) -> Column:
    if isinstance(model, float):
        return F.lit(model)

    ship()

    @F.arrow_udf(returnType="double")
    def score(column: pa.Array) -> pa.Array:
        data, offs = byte_slices(column)
        return pa.array([model.score(words_of(data[offs[k]:offs[k + 1]])) for k in range(len(column))], pa.float64())

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, spec: ToxicSpec = ToxicSpec()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs, labels, ~held_out(F.col("doc_id")), spec)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_texts(text_of("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= spec.threshold).cast("int"))
