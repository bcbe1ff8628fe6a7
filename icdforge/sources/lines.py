"""Line scans of release files.

Files are single-byte Windows-1252 text with CRLF line ends.  Spark's csv
source reads them as one ``value`` column (``sep`` set to a control byte that
never occurs, quoting off, so quotes and blanks are kept as-is), which is
splittable and decodes ISO-8859-1.  The separator is a three-character
control sequence: a line would lose text only if it contained that exact
sequence, which plain-text release files never do.  The 27 printable Windows-1252 characters
in 0x80-0x9F are then mapped with one ``translate``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_NAME = "CMS_File_Name"


def _cp1252_tables() -> tuple[str, str]:
    """(latin-1 control characters, their Windows-1252 glyphs), built from the codec."""
    src, dst = [], []
    for b in range(0x80, 0xA0):
        try:
            glyph = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            continue  # 5 undefined positions stay as they are
        src.append(chr(b))
        dst.append(glyph)
    return "".join(src), "".join(dst)


_CP1252_SRC, _CP1252_DST = _cp1252_tables()


def latin1_to_cp1252(c: Column) -> Column:
    return F.translate(c, _CP1252_SRC, _CP1252_DST)


def decoded_file_name() -> Column:
    """Base name of the scanned file, URL-decoded (``+`` kept literally)."""
    encoded = F.col("_metadata.file_name")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def raw_lines(spark: SparkSession, paths: Iterable[str], header: bool) -> DataFrame:
    """One row per line, its bytes as ISO-8859-1 characters (``value``)."""
    paths = list(paths)
    if not paths:
        raise ValueError("no input paths")
    return spark.read.csv(
        paths,
        schema="value STRING",
        sep="\u0001\u0002\u0003",
        quote="",
        escape="",
        comment=None,
        header=header,
        encoding="ISO-8859-1",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        nullValue="\u0000",
        mode="PERMISSIVE",
    )


def read_lines(spark: SparkSession, paths: Iterable[str], header: bool) -> DataFrame:
    """One row per line: ``value`` (decoded text) and ``CMS_File_Name``.

    ``header=True`` drops the first line of *each* file.  Blank lines are
    dropped by the reader.
    """
    raw = raw_lines(spark, paths, header)
    return raw.select(latin1_to_cp1252(F.col("value")).alias("value"), decoded_file_name().alias(FILE_NAME))
