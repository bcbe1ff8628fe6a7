"""Operators over loaded code-set tables: edits on dimensions, flags,
summaries, reconciliation, description drift and release deltas.

Join keys are always (fiscal year, version, [code type,] code), the tables'
primary keys, so per-key groups are bounded by the number of releases and no
window or collect ever sees an unbounded group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quality
from .wording import is_spelling

FY = "CMS_Fiscal_Year"
VER = "ICD_Version"


def code_dimension(dx: DataFrame | None = None, proc: DataFrame | None = None) -> DataFrame:
    """Diagnosis and procedure tables as one (FY, version, type, code, short) frame."""
    parts = []
    if dx is not None:
        parts.append(
            dx.select(FY, VER, F.lit("D").alias("ICD_Code_Type"), F.col("Diagnosis_Code").alias("ICD_Code"), "Code_Desc_Short")
        )
    if proc is not None:
        parts.append(
            proc.select(FY, VER, F.lit("P").alias("ICD_Code_Type"), F.col("Procedure_Code").alias("ICD_Code"), "Code_Desc_Short")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


EDIT_KEYS = [FY, VER, "ICD_Code_Type", "ICD_Code"]


def edit_join(codes: DataFrame, edits: DataFrame, how: str = "left") -> DataFrame:
    """Attach MCE edits to codes of the same release (B3).  Two keyed tables
    meet by their stored keys (case and trailing blanks do not count)."""
    what = ["MCE_Section", "MCE_Subsection", "MCE_Edit_Type"]
    stored = [f"{quality.KEY_PREFIX}{k}" for k in ("ICD_Code_Type", "ICD_Code")]
    if all(c in df.columns for df in (codes, edits) for c in stored):
        plain = [c for c in codes.columns if c not in stored]
        return codes.join(edits.select(FY, VER, *stored, *what), on=[FY, VER, *stored], how=how).select(*EDIT_KEYS, *(c for c in plain if c not in EDIT_KEYS), *what)
    return codes.join(edits.select(*EDIT_KEYS, *what), on=EDIT_KEYS, how=how)


def wide_dimension(codes: DataFrame, edits: DataFrame) -> DataFrame:
    """One row per code with its sorted edit types (comma list) and count (B4).

    The per-code set is bounded by the number of edit types.
    """
    per_code = (
        edits.groupBy(*EDIT_KEYS)
        .agg(F.sort_array(F.collect_set("MCE_Edit_Type")).alias("_types"))
        .select(
            *EDIT_KEYS,
            F.concat_ws(",", F.col("_types")).alias("Edit_Types"),
            F.size("_types").cast("int").alias("n_edit_types"),
        )
    )
    return codes.join(per_code, on=EDIT_KEYS, how="left").withColumn(
        "n_edit_types", F.coalesce(F.col("n_edit_types"), F.lit(0))
    )


def poa_flag(dx: DataFrame, poa: DataFrame, flag_col: str = "Is_POA_Exempt") -> DataFrame:
    """Diagnosis rows with a Y/N flag for membership in the POA-exempt list (B5)."""
    keys = [FY, VER, "Diagnosis_Code"]
    exempt = poa.select(*keys).dropDuplicates(keys).withColumn("_exempt", F.lit(True))
    return (
        dx.join(exempt, on=keys, how="left")
        .withColumn(flag_col, F.when(F.col("_exempt"), F.lit("Y")).otherwise(F.lit("N")))
        .drop("_exempt")
    )


def poa_exempt_only(dx: DataFrame, poa: DataFrame) -> DataFrame:
    return dx.join(poa.select(FY, VER, "Diagnosis_Code"), on=[FY, VER, "Diagnosis_Code"], how="left_semi")


def poa_required_only(dx: DataFrame, poa: DataFrame) -> DataFrame:
    return dx.join(poa.select(FY, VER, "Diagnosis_Code"), on=[FY, VER, "Diagnosis_Code"], how="left_anti")


def edit_pivot(edits: DataFrame, fiscal_years: Sequence[int], prefix: str = "FY_") -> DataFrame:
    """Row counts per (section, subsection, edit type, code type) with one
    column per fiscal year, zero-filled (B6).  ``fiscal_years`` are those of
    the loaded releases; a row of any other year fails the query rather than
    staying uncounted."""
    labels = [f"{prefix}{fy}" for fy in fiscal_years]
    known = F.concat(F.lit(prefix), F.col(FY).cast("string"))
    other = F.raise_error(F.concat(F.lit("fiscal year without a column: "), F.coalesce(F.col(FY).cast("string"), F.lit("NULL"))))
    groups = ["MCE_Section", "MCE_Subsection", "MCE_Edit_Type", "ICD_Code_Type"]
    out = (
        edits.withColumn("_fy", F.when(F.col(FY).isin(*[int(y) for y in fiscal_years]), known).otherwise(other))
        .groupBy(*groups)
        .pivot("_fy", labels)
        .agg(F.count(F.lit(1)))
        .fillna(0, subset=labels)
    )
    return out.select(*groups, *[F.col(x).cast("int").alias(x) for x in labels])


def section_type_dependency(edits: DataFrame) -> DataFrame:
    """Within each fiscal year, (section, subsection) -> (edit type, code type)
    and back must be one-to-one (B7).  ``n_distinct`` > 1 marks a violation."""
    fwd = quality.functional_dependency_report(
        edits, [FY], ["MCE_Section", "MCE_Subsection"], ["MCE_Edit_Type", "ICD_Code_Type"], "section->type"
    )
    back = quality.functional_dependency_report(
        edits, [FY], ["MCE_Edit_Type", "ICD_Code_Type"], ["MCE_Section", "MCE_Subsection"], "type->section"
    )
    return fwd.unionByName(back).select("key_kind", FY, "key", "n_distinct")


def edit_orphans(edits: DataFrame, codes: DataFrame) -> DataFrame:
    """Edit rows whose code is missing from the code tables of the same
    release (B8)."""
    return edits.join(codes.select(*EDIT_KEYS), on=EDIT_KEYS, how="left_anti")


def _squeeze_blanks(c):
    return F.trim(F.regexp_replace(c, " +", " "))


def description_discrepancies(poa: DataFrame, dx: DataFrame) -> DataFrame:
    """Long descriptions that differ between the POA list and the diagnosis
    table for the same code and release, classed as spacing / case / spelling
    (their words align one to one in spelling variants) / wording, with their
    edit distance (B9)."""
    keys = [FY, VER, "Diagnosis_Code"]
    a = poa.select(*keys, F.col("Code_Desc_Long").alias("POA_Desc"))
    b = dx.select(*keys, F.col("Code_Desc_Long").alias("Dx_Desc"))
    j = a.join(b, on=keys, how="inner").filter(F.col("POA_Desc") != F.col("Dx_Desc"))
    sa, sb = _squeeze_blanks(F.col("POA_Desc")), _squeeze_blanks(F.col("Dx_Desc"))
    kind = (
        F.when(sa == sb, F.lit("spacing"))
        .when(F.upper(sa) == F.upper(sb), F.lit("case"))
        .when(is_spelling(F.upper(sa), F.upper(sb)), F.lit("spelling"))
        .otherwise(F.lit("wording"))
    )
    return j.withColumn("Difference", kind).withColumn(
        "Edit_Distance", F.levenshtein("POA_Desc", "Dx_Desc").cast("int")
    )


def description_changes(dim: DataFrame, code_col: str, desc_col: str = "Code_Desc_Long") -> DataFrame:
    """Codes whose description differs from the previous release that held
    the code, within one ICD version (B10).  The window partition is one
    code's releases: bounded by the number of releases."""
    w = Window.partitionBy(VER, code_col).orderBy(FY)
    return (
        dim.select(VER, code_col, FY, desc_col)
        .withColumn("Prev_Fiscal_Year", F.lag(FY).over(w))
        .withColumn("Prev_Desc", F.lag(desc_col).over(w))
        .filter(F.col("Prev_Desc").isNotNull() & (F.col("Prev_Desc") != F.col(desc_col)))
    )


def release_pairs(manifest_df: DataFrame) -> DataFrame:
    """Consecutive releases of the same ICD version: (version, From_FY, To_FY)."""
    w = Window.partitionBy(VER).orderBy(FY)
    return (
        manifest_df.select(VER, FY)
        .distinct()
        .withColumn("To_FY", F.lead(FY).over(w))
        .filter(F.col("To_FY").isNotNull())
        .select(VER, F.col(FY).alias("From_FY"), "To_FY")
    )


def release_roles(pairs: DataFrame) -> DataFrame:
    """Each release as the old and/or new side of its consecutive pairs:
    (version, FY, From_FY, To_FY, _side) - two rows per pair, broadcastable."""
    old = pairs.select(VER, F.col("From_FY").alias(FY), "From_FY", "To_FY", F.lit("old").alias("_side"))
    new = pairs.select(VER, F.col("To_FY").alias(FY), "From_FY", "To_FY", F.lit("new").alias("_side"))
    return old.unionByName(new)


def release_delta(dim: DataFrame, pairs: DataFrame, code_col: str, desc_col: str = "Code_Desc_Long") -> DataFrame:
    """Added / deleted / revised codes between consecutive releases (B12).

    ``pairs`` (:func:`release_pairs`) is broadcast: it tells every row the
    release before and after its own.  One scan and one exchange by code: a
    code's rows, one per release, are put in order and each compared with its
    neighbour.  A second row for a release and code breaks the table's key and
    fails the query."""
    near = release_roles(pairs).groupBy(VER, FY).agg(
        F.max(F.when(F.col("_side") == "new", F.col("From_FY"))).alias("_before"),
        F.max(F.when(F.col("_side") == "old", F.col("To_FY"))).alias("_after"),
    )
    w = Window.partitionBy(VER, code_col).orderBy(FY)
    rows = dim.select(VER, FY, code_col, desc_col).join(F.broadcast(near), on=[VER, FY], how="inner").select(
        "*", F.lag(FY).over(w).alias("_lag"), F.lead(FY).over(w).alias("_lead"), F.lead(desc_col).over(w).alias("_next")
    )
    twice = F.raise_error(F.concat_ws(" ", F.lit("two rows for one release and code:"), F.col(VER), F.col(FY), F.col(code_col)))
    text = F.lit(None).cast("string")

    def entry(change: str, frm, to, old, new):
        return F.struct(frm.alias("From_FY"), to.alias("To_FY"), F.lit(change).alias("Change"), old.alias("Old_Desc"), new.alias("New_Desc"))

    fy, desc, follows = F.col(FY), F.col(desc_col), F.col("_lead").eqNullSafe(F.col("_after"))
    onward = F.when(F.col("_lag") == fy, twice).when(
        F.col("_after").isNotNull(),
        F.when(~follows, entry("deleted", fy, F.col("_after"), desc, text)).when(
            ~desc.eqNullSafe(F.col("_next")), entry("revised", fy, F.col("_after"), desc, F.col("_next"))
        ),
    )
    added = F.when(
        F.col("_before").isNotNull() & ~F.col("_lag").eqNullSafe(F.col("_before")), entry("added", F.col("_before"), fy, text, desc)
    )
    changes = rows.select(VER, F.col(code_col), F.explode(F.array(onward, added)).alias("_e")).filter(F.col("_e").isNotNull())
    return changes.select(VER, "_e.From_FY", "_e.To_FY", code_col, "_e.Old_Desc", "_e.New_Desc", "_e.Change")


def unapply_delta(
    dim: DataFrame, delta: DataFrame, pairs: DataFrame, code_col: str, desc_col: str = "Code_Desc_Long"
) -> DataFrame:
    """Rebuild each earlier release from the later one and the delta (B13):
    drop added codes, restore revised descriptions, put deleted codes back.
    One full outer join of the later releases with the delta, which is read
    once; ``pairs`` (:func:`release_pairs`) is broadcast."""
    keys = [VER, "From_FY", "To_FY", code_col]
    newer = dim.select(VER, F.col(FY).alias("To_FY"), code_col, F.col(desc_col).alias("_desc"))
    newer = newer.join(F.broadcast(pairs.select(VER, "From_FY", "To_FY")), on=[VER, "To_FY"], how="inner")
    both = newer.join(delta.select(*keys, "Change", "Old_Desc"), on=keys, how="full_outer")
    return both.filter(F.col("Change").isNull() | (F.col("Change") != "added")).select(
        VER,
        F.col("From_FY").alias(FY),
        code_col,
        F.when(F.col("Change").isNull(), F.col("_desc")).otherwise(F.col("Old_Desc")).alias(desc_col),
    )


def release_identity(dim: DataFrame, pairs: DataFrame, row_cols: Sequence[str]) -> DataFrame:
    """Are consecutive releases identical?  Multiset comparison of the given
    columns (EXCEPT ALL both ways) from one scan and one aggregation (B14)."""
    tagged = dim.join(F.broadcast(release_roles(pairs)), on=[VER, FY], how="inner")
    counts = quality.multiset_difference_counts(tagged, [VER, "From_FY", "To_FY"], list(row_cols))
    # pairs where one side is empty still appear (all rows on one side)
    return (
        pairs.join(counts, on=[VER, "From_FY", "To_FY"], how="left")
        .fillna(0, subset=["n_only_old", "n_only_new"])
        .withColumn(
            "Is_Identical",
            F.when((F.col("n_only_old") == 0) & (F.col("n_only_new") == 0), F.lit("Y")).otherwise(F.lit("N")),
        )
    )
