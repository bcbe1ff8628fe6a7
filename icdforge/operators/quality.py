"""Pre-write checks: keys, NOT NULL, text lengths, version agreement, and
release-level comparisons.

Every check is one scan plus at most one aggregation (map-side partial
aggregation, so a hot key costs no more than any other key).  Results are
DataFrames of violations; callers decide whether to raise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: columns of keyed tables (``plans/keyed.py``) that hold a text key as compared
KEY_PREFIX = "Key_"


def is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString().startswith(("string", "varchar", "char"))


def key_value(df: DataFrame, column: str) -> F.Column:
    """A key column as the tables compare it: text without regard to case and
    trailing blanks (their collation is case-insensitive); read from keyed tables."""
    if f"{KEY_PREFIX}{column}" in df.columns:
        return F.col(f"{KEY_PREFIX}{column}").alias(column)
    return F.upper(F.rtrim(F.col(column))).alias(column) if is_text(df, column) else F.col(column)


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The columns that hold ``keys`` as compared in a keyed table."""
    return [f"{KEY_PREFIX}{k}" if f"{KEY_PREFIX}{k}" in df.columns else k for k in keys]


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, as compared, with the row count
    (``n_rows``)."""
    return (
        df.select(*(key_value(df, k) for k in keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).cast("int").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def key_collisions(new_rows: DataFrame, kept_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, as compared, of new rows that exist among the rows a load keeps."""
    new = new_rows.select(*(key_value(new_rows, k) for k in keys))
    return new.join(kept_rows.select(*(key_value(kept_rows, k) for k in keys)), on=list(keys), how="left_semi")


def _exploded_report(df: DataFrame, id_cols: Sequence[str], entries: list[F.Column]) -> DataFrame:
    """One pass: an array of (possibly NULL) violation structs per row,
    exploded and filtered (the filter sits above the generator, so it is not
    pushed back into the projection)."""
    return (
        df.select(*id_cols, F.explode(F.array(*entries)).alias("_e"))
        .filter(F.col("_e").isNotNull())
        .select(*id_cols, "_e.*")
    )


def null_violations(df: DataFrame, columns: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a NOT NULL column: ``id_cols`` + ``column_name``."""
    entries = [
        F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column_name"))) for c in columns
    ]
    return _exploded_report(df, id_cols, entries)


def length_violations(df: DataFrame, limits: dict[str, int], id_cols: Sequence[str]) -> DataFrame:
    """Text longer than its column's limit: ``id_cols`` + column_name,
    max_length, actual_length."""
    entries = [
        F.when(
            F.length(F.col(c)) > n,
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(n).cast("int").alias("max_length"),
                F.length(F.col(c)).cast("int").alias("actual_length"),
            ),
        )
        for c, n in limits.items()
    ]
    return _exploded_report(df, id_cols, entries)


def version_mismatches(rows: DataFrame, row_version: str = "ICD_Version", release_version: str = "Release_ICD_Version") -> DataFrame:
    """Rows whose own ICD version differs from the release's version."""
    return rows.filter(~F.col(row_version).eqNullSafe(F.col(release_version)))


def length_profile(df: DataFrame, group_cols: Sequence[str], text_cols: Sequence[str]) -> DataFrame:
    """Longest observed text per column and group (``Max_<column>``)."""
    return df.groupBy(*group_cols).agg(
        *[F.max(F.length(c)).cast("int").alias(f"Max_{c}") for c in text_cols]
    )


def multiset_difference_counts(tagged: DataFrame, pair_cols: Sequence[str], row_cols: Sequence[str]) -> DataFrame:
    """Per pair of releases: rows only in old / only in new (multiset, like
    EXCEPT ALL both ways).  ``tagged`` holds the rows of both sides with a
    ``_side`` column ('old' / 'new'); one aggregation, combined map-side."""
    per_row = tagged.groupBy(*pair_cols, *row_cols).agg(
        F.sum(F.when(F.col("_side") == "old", 1).otherwise(0)).alias("_o"),
        F.sum(F.when(F.col("_side") == "new", 1).otherwise(0)).alias("_n"),
    )
    return per_row.groupBy(*pair_cols).agg(
        F.sum(F.greatest(F.col("_o") - F.col("_n"), F.lit(0))).cast("int").alias("n_only_old"),
        F.sum(F.greatest(F.col("_n") - F.col("_o"), F.lit(0))).cast("int").alias("n_only_new"),
    )


def functional_dependency_report(
    df: DataFrame, scope: Sequence[str], lhs: Sequence[str], rhs: Sequence[str], label: str
) -> DataFrame:
    """For each ``lhs`` value within ``scope``: how many distinct ``rhs``
    values it maps to (``n_distinct``; > 1 breaks the dependency)."""
    # values are compared column by column (a NULL is a value of its own)
    per = df.groupBy(*scope, *lhs).agg(F.countDistinct(F.struct(*rhs)).cast("int").alias("n_distinct"))
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in lhs])
    return per.select(*scope, key.alias("key"), "n_distinct", F.lit(label).alias("key_kind"))


# --- fixed values: diagnosis codes whose descriptions carry accents --------
ACCENT_CHECK_CODES = ("0413", "04671", "38600", "38601", "38602", "38603", "38604")
# -----------------------------------------------------------------------------


def accent_check(dx: DataFrame, codes=ACCENT_CHECK_CODES, code_col: str = "Diagnosis_Code") -> DataFrame:
    """Rows of the named codes with a flag telling whether their descriptions
    kept non-ASCII characters (a wrong code page turns them into '?' or
    mojibake)."""
    non_ascii = F.col("Code_Desc_Long").rlike("[^\\x00-\\x7F]") | F.col("Code_Desc_Short").rlike("[^\\x00-\\x7F]")
    return dx.filter(F.col(code_col).isin(*codes)).withColumn(
        "Has_Accents", F.when(non_ascii, F.lit("Y")).otherwise(F.lit("N"))
    )
