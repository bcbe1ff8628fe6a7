"""Language ID with error-correcting output codes.

Every language has a codeword; one linear classifier on hashed byte trigrams
per bit says which side of that bit a text is on.  Decoding is loss-weighted:
each bit's logistic loss against a codeword counts by how reliable that bit is
for that language, and the nearest codeword wins.  The score is the share of
the nearest codeword among all by exp(-loss); texts whose two nearest
codewords are close are flagged ambiguous.

Training takes a bounded sample of labelled rows: at most about
``rows_per_language`` whole texts per language, chosen by a hash of the row.
The trigram counts of a language are combined on Spark; the driver gets
``buckets`` numbers per language.  Scoring reads whole texts of all rows in
bounded pieces, whatever their length.

Defined results: null text, or a text without any letter, is ``und`` with
score 0; rows with a null language are scored but never learned from; a null
doc_id counts as an empty one for the split; repeated rows get equal results;
with no labelled row every text is ``und``; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keeping_names, materialize, ship, text_of
from .texts import byte_slices, spans

UNKNOWN = "und"
#: share of the nearest codeword under which a text is flagged ambiguous
AMBIGUOUS = 0.6


@dataclass(frozen=True)
class EcocSpec:
    rows_per_language: int = 6000
    log2_buckets: int = 13
    #: languages up to which all distinct two-way splits are used as bits
    exhaustive: int = 5
    seed: int = 5


# ASCII letters folded, every other ASCII byte a blank, bytes of other scripts kept
_FOLD = np.array([c | 32 if 65 <= c <= 90 or 97 <= c <= 122 else c if c >= 128 else 32 for c in range(256)], np.uint32)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LETTER = re.compile(r"[^\W\d_]")
_PIECE = 1 << 20


def _grams(data: np.ndarray, log2: int) -> np.ndarray:
    """Bucket of the trigram that starts at each byte (two fewer than bytes)."""
    c = _FOLD[data]
    g = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    g *= np.uint32(2654435761)
    g >>= np.uint32(32 - log2)
    return g


def gram_counts(column: pa.Array, log2: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position, trigram counts by bucket) for every value of the column."""
    data, offs = byte_slices(column)
    size = 1 << log2
    for i, j in spans(offs, _PIECE):
        lo, hi = int(offs[i]), int(offs[j])
        if j == i + 1 and hi - lo > _PIECE:  # one very long text, piece by piece
            total = np.zeros(size, np.int64)
            for at in range(lo, hi, _PIECE):
                piece = data[at:min(at + _PIECE + 2, hi)]
                if len(piece) > 2:
                    total += np.bincount(_grams(piece, log2), minlength=size)
            yield i, total
            continue
        g = _grams(data[lo:hi], log2) if hi - lo > 2 else np.zeros(0, np.uint32)
        for k in range(i, j):
            a, b = int(offs[k]) - lo, int(offs[k + 1]) - lo - 2
            yield k, np.bincount(g[a:max(a, b)], minlength=size)


def _has_letter(data: np.ndarray) -> bool:
    head = data[:4096]
    if _ASCII_LETTER[head].any() or _ASCII_LETTER[data].any():
        return True
    return _LETTER.search(data.tobytes().decode("utf-8", "replace").replace("�", "")) is not None


def codewords(n: int, exhaustive: int, seed: int) -> np.ndarray:
    """(languages, bits) of -1/+1: all two-way splits for few languages, else
    the seeded dense code with the largest smallest distance."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= exhaustive:
        bits = np.arange(1, 2 ** (n - 1))
        return np.array([[1.0 if i < n - 1 and b >> i & 1 else -1.0 for b in bits] for i in range(n)])
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        code = code[:, np.abs(code.sum(0)) < n]
        d = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * width
        if d.min() > far:
            best, far = code, d.min()
    return best


@dataclass
class EcocModel:
    languages: list[str]
    code: np.ndarray      # languages x bits
    weights: np.ndarray   # buckets x bits: log odds a trigram
    scale: np.ndarray     # bits: margin to logit
    trust: np.ndarray     # languages x bits, rows sum to 1
    log2: int

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return (counts @ self.weights) / max(1.0, float(counts.sum()))

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language (index), its share, and the ambiguity flag."""
        loss = np.logaddexp(0.0, -self.code[None] * (margins * self.scale)[:, None])
        total = (loss * self.trust[None]).sum(2) * self.code.shape[1]
        share = np.exp(total.min(1, keepdims=True) - total)
        share /= share.sum(1, keepdims=True)
        best = total.argmin(1)
        score = share[np.arange(len(best)), best]
        return best, score, score < AMBIGUOUS


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def train(docs: DataFrame, learn: Column, spec: EcocSpec = EcocSpec()) -> EcocModel | None:
    """Fit on rows of ``docs`` (doc_id, text, lang) where ``learn`` holds."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not n:
        return None
    rate = F.element_at(F.create_map(*(F.lit(x) for k, v in n.items() for x in (k, min(1.0, spec.rows_per_language / v)))), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.lit(spec.seed), "doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    sample = materialize(rows.filter(draw < rate).select("lang", "text"), "langid-sample")
    languages = sorted(n)
    at = {k: i for i, k in enumerate(languages)}
    size, log2 = 1 << spec.log2_buckets, spec.log2_buckets

    ship()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for k, c in gram_counts(batch.column("text"), log2):
                total[lang[k]] = total.get(lang[k], 0) + c
        for lang, c in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "counts": [c.astype(np.int64)]}, pa.schema([("lang", pa.string()), ("counts", pa.list_(pa.int64()))]))

    parts = sample.coalesce(24).mapInArrow(count, "lang string, counts array<bigint>")
    sums = parts.select("lang", F.posexplode("counts").alias("bucket", "n")).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).filter("n > 0")
    table = np.zeros((len(languages), size))
    for r in sums.toLocalIterator():  # buckets x languages numbers
        table[at[r["lang"]], r["bucket"]] = r["n"]
    p = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * size)
    code = codewords(len(languages), spec.exhaustive, spec.seed)
    bits = code.shape[1]
    weights = np.zeros((size, bits))
    for b in range(bits):
        on, off = p[code[:, b] > 0], p[code[:, b] < 0]
        if len(on) and len(off):
            weights[:, b] = np.log(on.mean(0)) - np.log(off.mean(0))
    model = EcocModel(languages, code, weights, np.ones(bits), np.full(code.shape, 1 / bits), log2)

    def reliability(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, size_of, n_of = np.zeros(code.shape), np.zeros(code.shape), np.zeros(len(languages))
        for batch in batches:
            lang = [at[x] for x in batch.column("lang").to_pylist()]
            for k, c in gram_counts(batch.column("text"), log2):
                m = model.margins(c)
                right[lang[k]] += (m * code[lang[k]]) > 0
                size_of[lang[k]] += np.abs(m)
                n_of[lang[k]] += 1
        for i in np.flatnonzero(n_of):
            yield pa.RecordBatch.from_pydict({"i": [int(i)], "n": [n_of[i]], "right": [right[i]], "size": [size_of[i]]}, pa.schema([("i", pa.int32()), ("n", pa.float64()), ("right", pa.list_(pa.float64())), ("size", pa.list_(pa.float64()))]))

    seen, right, margin = np.zeros(len(languages)), np.zeros(code.shape), np.zeros(code.shape)
    for r in sample.coalesce(24).mapInArrow(reliability, "i int, n double, right array<double>, size array<double>").toLocalIterator():
        seen[r["i"]] += r["n"]
        right[r["i"]] += r["right"]
        margin[r["i"]] += r["size"]
    accuracy = (right + 1) / (seen[:, None] + 2)
    model.trust = accuracy / accuracy.sum(1, keepdims=True)
    # a bit's usual margin becomes a logit of 4
    usual = margin.sum(0) / max(1.0, seen.sum())
    model.scale = 4.0 / np.maximum(usual, 1e-6)
    return model


def predict(text: Column, model: EcocModel | None) -> Column:
    """struct(lang, score, ambiguous) of a text column."""
    kind = "lang string, score double, ambiguous boolean"
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))

    ship()

    @F.arrow_udf(returnType=kind)
    def score(column: pa.Array) -> pa.Array:
        data, offs = byte_slices(column)
        margins = np.zeros((len(column), model.code.shape[1]))
        for k, c in gram_counts(column, model.log2):
            margins[k] = model.margins(c)
        best, share, unsure = model.decode(margins) if len(column) else (np.zeros(0, int), np.zeros(0), np.zeros(0, bool))
        known = np.array([_has_letter(data[offs[k]:offs[k + 1]]) for k in range(len(column))], bool)
        langs = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
        fields = [pa.array(langs, pa.string()), pa.array(np.where(known, share, 0.0)), pa.array(np.where(known, unsure, False))]
        return pa.StructArray.from_arrays(fields, ["lang", "score", "ambiguous"])

    return score(text)


def identify(docs: DataFrame, spec: EcocSpec = EcocSpec()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row."""
    out = held_out(F.col("doc_id"))
    model = train(docs, ~out, spec)
    p = docs.select("doc_id", out.alias("held_out"), predict(text_of("text"), model).alias("p"))
    return p.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.ambiguous").alias("ambiguous"))


@keeping_names
def language_documents(docs: DataFrame, spec: EcocSpec = EcocSpec()) -> DataFrame:
    """The documents with a recognised, unambiguous language."""
    model = train(docs, ~held_out(F.col("doc_id")), spec)
    marked = docs.withColumn("__p", predict(text_of("text"), model))
    return marked.filter((F.col("__p.lang") != UNKNOWN) & ~F.col("__p.ambiguous")).select(*docs.columns)
