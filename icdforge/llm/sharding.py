"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are ranked in a seeded shuffle within their source, sorted by fractional
rank (rank + start) / rows of the source, and the sorted order is cut into
``shards`` runs whose lengths differ by at most one: every shard holds each
source in the proportion it has in the whole table.  The start lies in [0, 1)
and is drawn per source by a seeded hash, so that the rows of many sources of
one or two rows do not share one fraction but spread over all shards.

Both orders are cut into buckets of bounded size (hash ranges of a source,
ranges of the fractional rank) whose counts are aggregated first, so neither a
hot source nor the whole table is ever sorted in one task.

Defined results: null or empty text has size 1 and checksum 0; a null source
is a source of its own; repeated rows are separate rows with places of their
own; an empty table gives an empty result; other columns are not read; equal
fractions are ordered by source and rank; very long texts are only measured.
Equal texts are spread like any other rows: the law that holds is ``rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_bits, hash_bucket, materialize, running_total, text_of, value_key


def interleave(docs: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """doc_id, source, size, text_crc32, rank, fraction, shard, slot."""
    text = text_of("text")
    base = docs.select(
        "doc_id", "source", value_key("source").alias("skey"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias("h"),
    )
    base = materialize(base, "shard-rows")
    per = base.groupBy("skey").agg(F.count("*").alias("n_source"))
    n_rows = base.count()
    bits = bucket_bits(n_rows)
    ranked = running_total(base.withColumn("bucket", hash_bucket("h", bits)), ["skey"], "bucket", ["h", "doc_id"], F.lit(1), "rank")
    start = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("skey")), 11) / F.lit(float(1 << 53))
    ranked = ranked.drop("bucket").join(per, "skey").withColumn("fraction", (F.col("rank") + start) / F.col("n_source"))
    cut = ranked.withColumn("bucket", F.least(F.floor(F.col("fraction") * (1 << bits)), F.lit((1 << bits) - 1))).withColumn("one", F.lit(0))
    placed = running_total(cut, ["one"], "bucket", ["fraction", "skey", "rank"], F.lit(1), "pos")
    total = F.lit(n_rows)
    shard = F.floor(F.col("pos") * shards / total).cast("int")
    placed = placed.withColumn("shard", shard)
    first = F.ceil(F.col("shard") * total / F.lit(shards)).cast("long")
    return placed.select("doc_id", "source", "size", "text_crc32", "rank", "fraction", "shard", (F.col("pos") - first).cast("long").alias("slot"))
