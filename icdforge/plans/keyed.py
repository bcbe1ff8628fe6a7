"""Keyed copies of tables: bucketed and sorted by the key as tables compare it.

A loaded table is partitioned by release, which suits loads and reads by
release.  Joins on the primary key (edits on codes, keys already in a table)
shuffle both sides each time.  A keyed copy stores every text key once more
without regard to case and trailing blanks (``Key_<column>``) and is dealt by
hash of the whole key over a fixed number of buckets, one sorted file a bucket
and write.  Keys are unique or nearly so (a code has at most one row per edit
type), so buckets are even whatever the release or code.

:func:`icdforge.operators.analytics.edit_join` and
:func:`icdforge.operators.quality.key_collisions` use the stored keys where they
find them.  Two keyed tables with the same key columns and number of buckets are
joined without an exchange; against other rows only those are shuffled.  Rows
within a task are sorted again, as a bucket may hold files of several appends.

A copy does not follow its table: append the rows of a load with
:func:`append_keyed`, or save it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import KEY_PREFIX, is_text, key_columns, key_value

#: some 2 million rows each for 500 million rows; tables to be joined take the same number
BUCKETS = 256


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with ``Key_<column>`` for every text key."""
    taken = [f"{KEY_PREFIX}{k}" for k in keys if is_text(df, k) and f"{KEY_PREFIX}{k}" in df.columns]
    if taken:
        raise ValueError(f"columns {taken} are in use")
    return df.select("*", *(key_value(df, k).alias(f"{KEY_PREFIX}{k}") for k in keys if is_text(df, k)))


def save_keyed(df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS, mode: str = "errorifexists") -> DataFrame:
    """Save ``df`` as table ``name``, bucketed and sorted by ``keys``; returns it."""
    rows = with_keys(df, keys)
    by = key_columns(rows, keys)
    dealt = rows.repartition(buckets, *by).sortWithinPartitions(*by)
    dealt.write.mode(mode).format("parquet").bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """(number of buckets, key columns) of a keyed table."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r[0] in ("Num Buckets", "Bucket Columns")}
    if len(about) < 2:
        raise ValueError(f"{name} is not a keyed table")
    return int(about["Num Buckets"]), [c.strip().strip("`") for c in about["Bucket Columns"].strip("[]").split(",")]


def append_keyed(df: DataFrame, name: str) -> None:
    """Append rows to a keyed table, one file a bucket."""
    spark = df.sparkSession
    buckets, by = bucket_spec(spark, name)
    rows = with_keys(df, [c.removeprefix(KEY_PREFIX) for c in by])
    rows = rows.select(*spark.table(name).columns)
    rows.repartition(buckets, *by).sortWithinPartitions(*by).write.insertInto(name)


def save_key_index(df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS, mode: str = "errorifexists") -> DataFrame:
    """The keys alone as a keyed table, for :func:`key_collisions` of loads."""
    return save_keyed(df.select(*keys), name, keys, buckets, mode)


__all__ = ["BUCKETS", "append_keyed", "bucket_spec", "save_key_index", "save_keyed", "with_keys"]
