"""Code pages of release files, told from the bytes of whole files.

Release files are Windows-1252 text.  A file saved as UTF-8 or UTF-16, or torn
on the way, still parses, with wrong letters in its descriptions.  Every line
of every file is counted here (bytes as ISO-8859-1 characters, built-in
functions, one map-side combined aggregate by file), so a single wrong letter
in a description that no list names is seen:

* ``n_high``: bytes 0x80-0xFF
* ``n_sequence``: those of them inside well-formed UTF-8 sequences
* ``n_undefined``: the five bytes that Windows-1252 leaves undefined, outside
  such sequences
* ``n_control``: control bytes but tab and line ends
* ``n_replaced``: UTF-8 forms of U+FFFD, a letter lost before

A file's page is

* ``damaged`` with any control byte or replaced letter, or an undefined byte
* ``ascii`` without high bytes, which every page reads alike
* ``utf-8`` if every high byte lies in a sequence
* ``mixed`` if some do
* ``cp1252`` if none does

A Windows-1252 text with a pair like 0xC3 0xA9 on purpose counts as ``utf-8`` or
``mixed``; code descriptions have none.  A UTF-8 mark at a file's beginning is
dropped by the line reader, here and in loads, and does not count.  A file
without a line has no row.

The same pass gives each file's ``digest``: the number of its lines and three
sums of line hashes with different seeds, combined map-side like the counts.  It
tells files by their lines, whatever their order; blank lines do not count.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import FILE_NAME, decoded_file_name, raw_lines

#: pages that read_lines decodes rightly
READABLE = ("ascii", "cp1252")

# --- fixed values: well-formed UTF-8 (Unicode, table 3-7), bytes as characters
_TAIL = r"[\x80-\xBF]"
UTF8_SEQUENCE = "|".join((
    rf"[\xC2-\xDF]{_TAIL}",
    rf"\xE0[\xA0-\xBF]{_TAIL}",
    rf"[\xE1-\xEC\xEE\xEF]{_TAIL}{{2}}",
    rf"\xED[\x80-\x9F]{_TAIL}",
    rf"\xF0[\x90-\xBF]{_TAIL}{{2}}",
    rf"[\xF1-\xF3]{_TAIL}{{3}}",
    rf"\xF4[\x80-\x8F]{_TAIL}{{2}}",
))
UNDEFINED = r"[\x81\x8D\x8F\x90\x9D]"
REPLACED = r"\xEF\xBF\xBD"
# -----------------------------------------------------------------------------
#: seeds of the digest's sums, and the digest of a file without a line
SEEDS = (11, 12, 13)
EMPTY = ":".join("0" * (1 + len(SEEDS)))
HIGH = r"[\x80-\xFF]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def line_counts(value: Column) -> dict[str, Column]:
    """The counts of one line; plain lines take one test."""
    value = F.coalesce(value, F.lit("\u0000"))  # the reader's null is a line of one zero byte
    alone = F.regexp_replace(value, UTF8_SEQUENCE, "")
    high, rest = F.regexp_count(value, F.lit(HIGH)), F.regexp_count(alone, F.lit(HIGH))
    counts = {
        "n_high": high,
        "n_sequence": high - rest,
        "n_undefined": F.regexp_count(alone, F.lit(UNDEFINED)),
        "n_control": F.regexp_count(value, F.lit(CONTROL)),
        "n_replaced": F.regexp_count(value, F.lit(REPLACED)),
    }
    odd = value.rlike(f"{HIGH}|{CONTROL}")
    return {name: F.when(odd, count).otherwise(0).cast("long") for name, count in counts.items()}


def page_of_counts() -> Column:
    return (
        F.when((F.col("n_control") > 0) | (F.col("n_replaced") > 0) | (F.col("n_undefined") > 0), "damaged")
        .when(F.col("n_high") == 0, "ascii")
        .when(F.col("n_sequence") == F.col("n_high"), "utf-8")
        .when(F.col("n_sequence") > 0, "mixed")
        .otherwise("cp1252")
    )


def code_pages(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One row per file: name, n_lines, the counts, ``code_page`` and ``digest``.
    Blank lines are not counted; a header line is a line."""
    lines = raw_lines(spark, paths, header=False).select(decoded_file_name().alias(FILE_NAME), "value")
    per_line = lines.select(FILE_NAME, *(c.alias(n) for n, c in line_counts(F.col("value")).items()), *(F.xxhash64(F.lit(s), "value").alias(f"h{s}") for s in SEEDS))
    counts = [c for c in per_line.columns if c.startswith("n_")]
    sums = [F.sum(c).alias(c) for c in counts] + [F.sum(F.col(f"h{s}").cast("decimal(20,0)")).cast("string").alias(f"h{s}") for s in SEEDS]
    per_file = per_line.groupBy(FILE_NAME).agg(F.count("*").alias("n_lines"), *sums)
    digest = F.concat_ws(":", F.col("n_lines").cast("string"), *(f"h{s}" for s in SEEDS))
    return per_file.select(FILE_NAME, "n_lines", *counts, page_of_counts().alias("code_page"), digest.alias("digest"))
