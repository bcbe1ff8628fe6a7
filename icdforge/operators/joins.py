"""Join strategies for operators Spark has no single primitive for.

Broadcasts: the library hints ``broadcast`` only for frames whose size is
bounded by construction (release manifests: one row per release) or has been
counted (:func:`lookup_join`).  Every other join is left to the planner,
whose ``autoBroadcastJoinThreshold`` (static statistics) and AQE (runtime
sizes) pick a broadcast only under the configured size and fall back to a
shuffled sort-merge join otherwise; AQE's skew-join rule splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Code alphabet in byte order and the longest code: ICD-9/10 codes are at
# most 7 upper-case letters or digits.
CODE_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_CODE_LENGTH = 7


#: a counted table up to this size is broadcast (about 100 bytes a row)
BROADCAST_ROWS = 200_000
#: ways in which the rows of one key are dealt when the table is larger
SALTS = 16


def lookup_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str, salt: Sequence[str], table_rows: int | None = None) -> DataFrame:
    """Join many ``rows`` to a code table on ``keys`` (inner, left_semi or
    left_anti), whatever the skew of the keys among the rows.

    The table is counted (or its count given): up to ``BROADCAST_ROWS`` it is
    broadcast; beyond that both sides are shuffled, the rows of one key dealt
    over ``SALTS`` tasks by a hash of the ``salt`` columns and the table
    repeated once for each."""
    n = table.count() if table_rows is None else table_rows
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), on=list(keys), how=how)
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated, on=[*keys, "_salt"], how=how).drop("_salt")


def _bad_code(code: Column, alphabet: str, max_len: int) -> Column:
    outside = F.translate(code, alphabet, "") != ""
    return F.coalesce(outside | (F.length(code) > max_len) | (code == ""), F.lit(True))


def range_problems(codes: DataFrame, ranges: DataFrame, code_col: str, lo_col: str = "Range_Lo", hi_col: str = "Range_Hi",
                   alphabet: str = CODE_ALPHABET, max_len: int = MAX_CODE_LENGTH) -> DataFrame:
    """What :func:`expand_ranges` leaves out, as rows (side, value, reason):
    codes and bounds that are null, empty, too long or hold other characters
    than the alphabet's after upper-casing, and ranges whose low end is above
    the high end."""
    c = codes.filter(_bad_code(F.upper(code_col), alphabet, max_len)).select(F.lit("code").alias("side"), F.col(code_col).alias("value"), F.lit("not_a_code").alias("reason"))
    lo, hi = F.upper(lo_col), F.upper(hi_col)
    bad = _bad_code(lo, alphabet, max_len) | _bad_code(hi, alphabet, max_len)
    r = ranges.select(F.lit("range").alias("side"), F.concat_ws("-", lo_col, hi_col).alias("value"), F.when(bad, "not_a_code").when(lo > hi, "low_above_high").alias("reason"))
    return c.unionByName(r.filter(F.col("reason").isNotNull()))


#: distinct codes in a block of the sweep order, the unit in which ranges meet codes
BLOCK = 256
#: leading characters whose codes one task puts in order: at most 36 ** 3 codes follow four
GROUP = 4


def _sweep(points: DataFrame) -> DataFrame:
    """``points``: distinct (v, k), k 0 for a low bound, 1 for a code, 2 for a
    high bound.  Adds ``r``: the codes before the point, in the order (v, k).

    The order is cut by the first ``GROUP`` characters and again by the first
    two, so no window holds more than the code space behind such a prefix: at
    most three points for each of 36 ** 3 codes, 36 ** 2 prefixes in the next,
    36 ** 2 in the last."""
    is_code = (F.col("k") == 1).cast("long")
    p = points.select("v", "k", F.substring("v", 1, GROUP).alias("g"), F.substring("v", 1, 2).alias("h"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    groups = p.groupBy("h", "g").agg(F.sum(is_code).alias("n"))
    tops = groups.groupBy("h").agg(F.sum("n").alias("n")).select("h", F.coalesce(F.sum("n").over(before(F.lit(0)).orderBy("h")), F.lit(0)).alias("top"))
    groups = groups.select("h", "g", F.coalesce(F.sum("n").over(before("h").orderBy("g")), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum(is_code).over(before("g").orderBy("v", "k")), F.lit(0))
    ranked = p.withColumn("i", within).join(groups, ["h", "g"]).join(F.broadcast(tops), "h")  # at most 36 ** 2 tops
    return ranked.select("v", "k", (F.col("top") + F.col("base") + F.col("i")).alias("r"))


def expand_ranges(
    codes: DataFrame,
    ranges: DataFrame,
    code_col: str,
    lo_col: str = "Range_Lo",
    hi_col: str = "Range_Hi",
    alphabet: str = CODE_ALPHABET,
    max_len: int = MAX_CODE_LENGTH,
) -> DataFrame:
    """Range join ``lo <= code <= hi`` (byte order, after upper-casing) as a
    sweep over the sorted codes and bounds.

    Distinct codes and bounds are put in one order and numbered by the codes
    before them; a range then holds the codes of a run of numbers.  The numbers
    are cut into blocks of ``BLOCK`` codes: a code lies in one block, a range in
    every block its run touches, and both meet by an equality join on the block,
    with the numbers compared there.  A narrow range is one or two rows, a range
    over all codes is dealt over all blocks, and no key holds more than ``BLOCK``
    different codes; where very many ranges share a block, AQE's skew join
    splits them.  Nothing is evaluated while the query is built.  What cannot
    be compared is left out and reported by :func:`range_problems`.
    """
    bad = lambda c: _bad_code(F.upper(c), alphabet, max_len)
    c = codes.filter(~bad(code_col)).withColumn("_v", F.upper(code_col))
    r = ranges.filter(~bad(lo_col) & ~bad(hi_col)).withColumns({"_lo": F.upper(lo_col), "_hi": F.upper(hi_col)}).filter("_lo <= _hi")
    points = c.select(F.col("_v").alias("v"), F.lit(1).alias("k")).distinct().union(
        r.select(F.explode(F.array(F.struct(F.col("_lo").alias("v"), F.lit(0).alias("k")), F.struct(F.col("_hi").alias("v"), F.lit(2).alias("k")))).alias("p")).select("p.*").distinct())
    order = _sweep(points)
    numbered = lambda name, k, to: order.filter(F.col("k") == k).select(F.col("v").alias(name), F.col("r").alias(to))
    c = c.join(numbered("_v", 1, "_r"), "_v").withColumn("_block", F.floor(F.col("_r") / BLOCK)).drop("_v")
    r = r.join(numbered("_lo", 0, "_from"), "_lo").join(numbered("_hi", 2, "_to"), "_hi").filter("_from < _to").drop("_lo", "_hi")
    r = r.withColumn("_block", F.explode(F.sequence(F.floor(F.col("_from") / BLOCK), F.floor((F.col("_to") - 1) / BLOCK))))
    met = c.join(r, "_block").filter("_r >= _from AND _r < _to")
    return met.drop("_block", "_r", "_from", "_to")
