"""Helpers shared by the operators: whole-text words, written tables, bucketed
running totals and connected components."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from icdforge.session import checkpoint_dir

#: a word is a run of characters that are neither blank nor \t \n \v \f \r
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
ROWS_PER_BUCKET = 20_000


_shipped: set[str] = set()


def ship() -> None:
    """Give the session's Python workers this package (once per application),
    so that functions that run in tasks can be imported there."""
    context = SparkSession.active().sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="icdforge-code-"), "icdforge-code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def text_of(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def value_key(col: str) -> Column:
    """A key that is never null and keeps null apart from every value."""
    return F.when(F.col(col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(col).cast("string")))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back:
    lineage is cut and a lost executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/icdforge-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keeping_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of their documents: input columns
    that begin like an operator's own (two underscores) are renamed on the way
    in and get their names back on the way out."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kw) -> DataFrame:
        taken, hidden = set(docs.columns), {}
        for c in docs.columns:
            if c.startswith("__"):
                name = f"input{c}"
                while name in taken:
                    name += "_"
                taken.add(name)
                hidden[c] = name
        out = operator(docs.withColumnsRenamed(hidden), *args, **kw)
        return out.withColumnsRenamed({v: k for k, v in hidden.items()})

    return run


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table from a list whose length the caller has bounded."""
    return spark.createDataFrame(list(rows), schema)


def bucket_bits(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Bits of a hash that give buckets of about ``rows_per_bucket`` rows."""
    return max(1, int(max(0, n_rows // rows_per_bucket)).bit_length())


def hash_bucket(hash_col: str, bits: int) -> Column:
    """The leading bits of a 64-bit hash; ordering by (bucket, hash as
    unsigned) is one order, cut into buckets of even size."""
    return F.shiftrightunsigned(F.col(hash_col), 64 - bits)


def running_total(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], weight: Column, out: str) -> DataFrame:
    """Sum of ``weight`` over the rows before each row, per group, ordered by
    (bucket, order).  Only one bucket is ever sorted in one task: a group that
    holds a third of all rows is spread over its buckets, whose totals are
    aggregated first."""
    w = df.withColumn("__w", weight)
    keys = [*group, bucket]
    per = w.groupBy(*keys).agg(F.sum("__w").alias("__t"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(*keys, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        w.withColumn("__in", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
        .join(base, keys)
        .withColumn(out, F.col("__base") + F.col("__in"))
        .drop("__w", "__in", "__base")
    )


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges``: (a long, b long), any direction, self-loops ignored.  Returns
    (node, root): every node that has an edge, and the smallest node it
    reaches.  Each round is a map-side combined ``min`` per node and an
    equality join, written to the shared folder; only one count per round
    comes to the driver.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        nb = both(e)
        if not large:
            nb = nb.filter("v < u")
        low = nb.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        joined = nb.join(low, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def signature(e: DataFrame) -> tuple:
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    cur = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges")
    sig = signature(cur)
    for _ in range(max_rounds):
        if sig[0] == 0:
            break
        nxt = materialize(star(star(cur, True), False), f"{label}-round")
        new = signature(nxt)
        if new == sig:
            break
        cur, sig = nxt, new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # a star forest: every node points at its root
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(cur.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
