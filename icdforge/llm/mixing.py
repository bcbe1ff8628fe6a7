"""Mixing sources to target weights: multivariate-hypergeometric splitting tree.

Each source's documents are laid out once in a seeded order; ``max_epochs``
passes over that layout are its word stream, cut into blocks of equal words.
A source's target is an exact quota of those blocks.  A binary tree over the
output shards splits the vector of quotas: at every node the left half draws
its share without replacement (one multivariate-hypergeometric draw), so the
leaves' counts add up to the quotas exactly.  Every shard then takes disjoint
runs of its sources' permuted blocks and orders its rows by a seeded hash.

The tree runs on the driver over one number per source; blocks are bounded by
``shards * blocks_per_shard`` + one per source.  Documents are never collected.

Defined results: null text or text without words has size 0 and is never
taken; a null source is a source of its own, last in order; repeated rows are
separate documents; an empty table gives an empty result; other columns are
passed through by ``mix_documents`` and never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_bits, hash_bucket, keeping_names, materialize, n_words, running_total, small_frame, text_of, value_key


@dataclass(frozen=True)
class MixSpec:
    weights: Sequence[float] = (5, 2, 1)
    max_epochs: int = 3
    shards: int = 16
    blocks_per_shard: int = 256
    #: a source may miss its target by this share, or by less than a document that fits
    tolerance: float = 0.002
    seed: int = 7


def source_targets(sizes: dict[str | None, int], spec: MixSpec = MixSpec()) -> dict[str | None, float]:
    """Words due from each source: shares of all words by weight (sources in
    code-point order, null last, weights repeating), none above ``max_epochs``
    times its source; what is cut off goes to the others by weight."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: float(spec.weights[i % len(spec.weights)]) for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    out: dict[str | None, float] = {}
    while len(out) < len(order):
        rest = total - sum(out.values())
        free = [s for s in order if s not in out]
        w = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free}
        over = [s for s in free if share[s] > spec.max_epochs * sizes[s]]
        if not over:
            return out | share
        out |= {s: float(spec.max_epochs * sizes[s]) for s in over}
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts; columns sum to ``quotas`` and shard
    totals differ by at most one."""
    total = int(quotas.sum())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(lo: int, hi: int, q: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = q
            return
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(q, sum(room[lo:mid]), method="marginals") if q.sum() else q
        split(lo, mid, left)
        split(mid, hi, q - left)

    split(0, shards, quotas.astype(np.int64))
    return out


FILLS = "skey string, gap long, fills array<struct<low:long,high:long,most:long>>"


def _fill_gaps(laid: DataFrame, gaps: dict[str, int], targets: dict[str, float], spec: MixSpec) -> DataFrame:
    """(skey, gap, fills) of sources that take documents beyond the quota's last
    whole one: those with a start in [low, high] and a size up to ``most``.
    Each round takes the documents that fit up to the first that overflows the
    gap, in the layout's order, or the largest that fits where the gap is under
    ``FEW`` times its size; again and again, until the gap is within
    ``tolerance`` or nothing fits.  What overflowed no longer fits, so rounds
    are few.  One row per source and round reaches the driver."""
    spark = laid.sparkSession
    left, fills = dict(gaps), {}
    while True:
        wide = [(k, g, fills.get(k, [])) for k, g in left.items() if g > spec.tolerance * targets[k]]
        if not wide:
            break
        fits = laid.filter("not whole and size > 0").select("skey", "bucket", "start", "size").join(F.broadcast(small_frame(spark, wide, FILLS)), "skey")
        fits = running_total(fits.filter((F.col("size") <= F.col("gap")) & ~_filled()).drop("fills"), ["skey"], "bucket", ["start"], F.col("size"), "ahead")
        fit = F.col("ahead") + F.col("size") <= F.col("gap")
        best = fits.groupBy("skey").agg(F.max(F.struct("size", "start")).alias("x"), F.sum(F.when(fit, F.col("size"))).alias("words"), F.max(F.when(fit, F.col("start"))).alias("high")).collect()
        now, left = left, {}
        for r in best:
            k, g = r["skey"], now[r["skey"]]
            one = g < FEW * r["x"]["size"]
            fills.setdefault(k, []).append((r["x"]["start"], r["x"]["start"], g) if one else (0, r["high"], g))
            left[k] = g - (r["x"]["size"] if one else r["words"])
    return small_frame(spark, [(k, gaps[k], v) for k, v in fills.items()], FILLS)


#: a gap of fewer documents of the largest size that fits is filled one by one
FEW = 8


def _filled() -> Column:
    """Whether a row that is not whole is in one of its source's fills."""
    inside = F.exists("fills", lambda f: (F.col("start") >= f["low"]) & (F.col("start") <= f["high"]) & (F.col("size") <= f["most"]))
    return F.coalesce(inside, F.lit(False))


def row_hash(columns: Sequence[str], spec: MixSpec) -> Column:
    """The seeded hash that orders rows; rows that are alike in ``columns`` share it."""
    return F.xxhash64(F.lit(spec.seed), *columns)


def mix_plan(docs: DataFrame, spec: MixSpec = MixSpec(), identity: Sequence[str] = ("doc_id", "text")) -> tuple[DataFrame, DataFrame]:
    """(plan, blocks).  plan: one row per document with rid (its number), doc_id, h (its row hash
    over ``identity``), source, size, source_size, target, copies and ``places``
    (array of copy and block).  blocks: the shard of every drawn block (skey,
    block, shard)."""
    spark = docs.sparkSession
    base = docs.select(
        "doc_id", "source", value_key("source").alias("skey"), n_words(text_of("text")).alias("size"), row_hash(identity, spec).alias("h")
    )
    base = materialize(base.withColumn("rid", F.monotonically_increasing_id()), "mix-sizes")
    per = base.groupBy("source", "skey").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # one row per source
    sizes = {r["source"]: int(r["size"] or 0) for r in per}
    targets = source_targets(sizes, spec)
    total = sum(sizes.values())
    block = max(1, -(-total // (spec.shards * spec.blocks_per_shard)))
    rows, quotas = [], []
    for r in sorted(per, key=lambda r: r["skey"]):
        s = sizes[r["source"]]
        words = min(spec.max_epochs * s, int(round(targets[r["source"]])))
        passes, rest = divmod(words, s) if s else (0, 0)
        quota = -(-words // block)
        rows.append((r["skey"], s, targets[r["source"]], passes, rest, quota))
        quotas.append(quota)
    counts = split_quotas(np.array(quotas, dtype=np.int64), spec.shards, spec.seed) if rows else np.zeros((spec.shards, 0), np.int64)
    placed = []
    for i, row in enumerate(rows):
        perm = np.random.default_rng([spec.seed, 1, i]).permutation(row[5])
        shard_of = np.repeat(np.arange(spec.shards), counts[:, i])
        placed += [(row[0], int(b), int(s)) for b, s in zip(perm, shard_of)]
    sources = small_frame(spark, rows, "skey string, source_size long, target double, passes int, rest long, quota long")
    blocks = small_frame(spark, placed, "skey string, block long, shard int")

    bits = bucket_bits(sum(r["n"] for r in per))
    laid = running_total(base.withColumn("bucket", hash_bucket("h", bits)), ["skey"], "bucket", ["h", "doc_id"], F.col("size"), "start")
    laid = laid.join(sources, "skey")
    # the last pass takes whole documents that end inside the quota
    whole = (F.col("size") > 0) & (F.col("start") + F.col("size") <= F.col("rest"))
    laid = materialize(laid.withColumn("whole", whole), "mix-layout")
    short = laid.groupBy("skey").agg((F.max("rest") - F.sum(F.when(F.col("whole"), F.col("size")).otherwise(0))).alias("gap")).collect()  # one row per source
    gaps = {r["skey"]: int(r["gap"]) for r in short}
    extra = _fill_gaps(laid, gaps, {r[0]: r[2] for r in rows}, spec)
    marked = laid.join(F.broadcast(extra), "skey", "left").withColumn("extra", ~F.col("whole") & (F.col("size") > 0) & _filled())
    marked = marked.withColumn("copies", F.when(F.col("size") > 0, F.col("passes") + (F.col("whole") | F.col("extra")).cast("int")).otherwise(0))
    # documents that fill a gap are spread over its words
    into = F.col("rest") - F.col("gap") + F.pmod(F.xxhash64(F.lit(spec.seed), "skey", "start"), "gap")
    last = F.when(F.col("extra"), into).otherwise(F.col("start"))
    copies = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(k.alias("copy"), F.least((k * F.col("source_size") + F.when(k == F.col("passes"), last).otherwise(F.col("start"))).cast("long") / F.lit(block), F.col("quota") - 1).cast("long").alias("block")),
    )
    keep = ["rid", "doc_id", "source", "skey", "size", "source_size", "target", "copies"]
    return marked.select(*keep, "h", copies.alias("places")), blocks


def mix_rows(plan: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per taken copy with its shard and its place in the shard's
    local shuffle (order by ``shuffle_key``)."""
    taken = plan.select("*", F.explode("places").alias("p")).select("*", F.col("p.copy").alias("copy"), F.col("p.block").alias("block")).drop("places", "p")
    return taken.join(blocks, ["skey", "block"]).withColumn("shuffle_key", F.xxhash64("h", "copy", "shard"))


def mixture(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """What the drawn blocks hold of each document: doc_id, size, source_size,
    target, taken (words) and, one entry a copy, ``shards`` and ``positions``,
    its place in the shard's local shuffle.  Every copy comes through the block
    that the tree has dealt to a shard and is ranked there by its shuffle key."""
    plan, blocks = mix_plan(docs, spec)
    plan = materialize(plan, "mix-plan")
    rows = mix_rows(plan, blocks).select("rid", "size", "shard", "shuffle_key", "copy")
    bits = bucket_bits(spec.max_epochs * plan.count() // spec.shards)
    # signed keys in ascending order: the bucket follows that order
    order = F.shiftrightunsigned(F.col("shuffle_key").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits)
    ranked = running_total(rows.withColumn("bucket", order), ["shard"], "bucket", ["shuffle_key", "rid", "copy"], F.lit(1), "position")
    drawn = ranked.groupBy("rid").agg(F.sum("size").alias("words"), F.sort_array(F.collect_list(F.struct("shard", "position"))).alias("at"))  # at most ``max_epochs`` entries
    out = plan.join(drawn, "rid", "left")
    none = F.array().cast("array<bigint>")
    return out.select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
        F.coalesce(F.col("at.shard").cast("array<bigint>"), none).alias("shards"), F.coalesce(F.col("at.position").cast("array<bigint>"), none).alias("positions"))


def local_shuffle(rows: DataFrame, shard: str = "shard", key: str = "shuffle_key") -> DataFrame:
    """The rows range-partitioned by shard and, inside it, in the order of
    their shuffle key: a shard of any size is spread over several tasks."""
    return rows.repartitionByRange(shard, key).sortWithinPartitions(shard, key)


@keeping_names
def mix_documents(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The mixed documents: every column of ``docs``, one row per taken copy,
    shard after shard in shuffled order."""
    columns = docs.columns
    told = [c for c, kind in docs.dtypes if "map<" not in kind]  # maps have no hash
    plan, blocks = mix_plan(docs, spec, identity=told)
    plan = materialize(plan, "mix-plan")
    taken = mix_rows(plan, blocks).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("shard").alias("__shard"), F.col("shuffle_key").alias("__key"))
    rows = docs.withColumn("__row", row_hash(told, spec))
    if not plan.groupBy("doc_id", "h").count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "__row"])  # rows alike in every column: each has its own copies in the plan
    mixed = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__h")))
    return local_shuffle(mixed, "__shard", "__key").select(*columns)
