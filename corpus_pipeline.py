"""Documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and reread for the next.  All but the
last return the columns of ``documents``.

1. language ID: documents without a recognised, unambiguous language go
2. quality rules: documents that the base rule or the robust estimate rejects go
3. SimHash near-dedup: one document of each group stays
4. mixing: documents are repeated, kept once or dropped as their source's target asks
5. packing: the pieces of all remaining documents, placed in windows

Nulls, empty and very long texts, repeated rows and empty tables have the
results that the operators' docstrings define.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from icdforge.llm import langid, mixing, packing, quality, simhash
from icdforge.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.language_documents(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing_to_weights),
    ("packing", pack_sequences),
]

#: not expressible in SQL (fitted models, XXH64, tokens); see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/icdforge-llm/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}-{name}")
    return docs
