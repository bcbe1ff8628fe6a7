"""Applying code-set tables to claims.

Claims are kept *long*: one row per claim code (``claim_id``, ``seq``,
``ICD_Code_Type``, ``ICD_Code``) next to a claim header (``claim_id``,
``service_date``, ``age``, ``sex``, ``los_hours``).  Nothing is collected per
claim: the principal diagnosis is a ``min`` aggregate (map-side partial
aggregation, so a claim with a huge number of lines costs no more than a
small one) of a number, so it is a hash aggregate; what a rule is about (codes
with an edit, codes that occur twice, external causes) is selected first and
meets the principal's position afterwards.  Joins to the edit and code tables
are on their primary keys: broadcast after a count, salted beyond it, so a
diagnosis that half of all claims carry is no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join
from .releases import release_of_date

# --- fixed values: MCE simple edit types ---------------------------------------
# (section, subsection, edit type, code type); "_" means no subsection.
MCE_EDIT_TYPES = (
    (4, "A", "Newborn_Only", "D"),
    (4, "B", "Pediatric_Only", "D"),
    (4, "C", "Maternity_Only", "D"),
    (4, "D", "Adult_Only", "D"),
    (5, "A", "Female_Only", "D"),
    (5, "B", "Female_Only", "P"),
    (5, "C", "Male_Only", "D"),
    (5, "D", "Male_Only", "P"),
    (6, "_", "Principal_Manifestation", "D"),
    (8, "_", "Principal_Questionable_Admit", "D"),
    (9, "_", "Principal_Unacceptable", "D"),
    (11, "A", "Noncovered_Always", "P"),
    (11, "F", "Noncovered_Over60", "P"),
    (17, "A", "Limited_Coverage", "P"),
    (18, "_", "Wrong_Performed", "D"),
    (19, "_", "Noncovered_LOS_96hr", "P"),
)
# Age bounds stated by the edit labels (inclusive).
PEDIATRIC_AGES = (0, 17)
MATERNITY_AGES = (12, 55)
ADULT_AGES = (15, 124)
OVER_AGE = 60
#: lines that a task groups by claim and code, on average (some 300 bytes each in its sorts and hash tables)
LINES_PER_TASK = 1_000_000
# -----------------------------------------------------------------------------


def claim_codes_from_arrays(
    claims: DataFrame, dx_col: str = "dx", px_col: str = "px", keep: Sequence[str] = ()
) -> DataFrame:
    """Array-shaped claims -> long claim codes in one pass; position 0 of
    ``dx`` is the principal diagnosis (``seq`` is the array position).
    ``keep`` names claim columns to carry along (e.g. the header)."""

    def tagged(col: str, code_type: str) -> Column:
        return F.transform(
            F.coalesce(F.col(col), F.array().cast("array<string>")),
            lambda code, i: F.struct(F.lit(code_type).alias("t"), i.alias("seq"), code.alias("c")),
        )

    return claims.select("claim_id", *keep, F.inline(F.concat(tagged(dx_col, "D"), tagged(px_col, "P")))).select(
        "claim_id", F.col("seq"), F.col("t").alias("ICD_Code_Type"), F.col("c").alias("ICD_Code"), *keep
    )


def claim_tasks(lines: DataFrame) -> int | None:
    """Tasks over which ``lines`` are dealt by claim before they are grouped,
    of ``LINES_PER_TASK`` lines each (counted); at least one a core.  None up to
    that many lines: the planner's own choice will do.

    The planner sizes tasks by compressed bytes, and orders them by cores, so the
    lines of a task, and the hash tables made of them, grow with the input."""
    n = lines.count()
    return max(-(-n // LINES_PER_TASK), lines.sparkSession.sparkContext.defaultParallelism) if n > LINES_PER_TASK else None


def principal_seq(codes: DataFrame) -> DataFrame:
    """(claim_id, Principal_Seq): lowest ``seq`` among a claim's diagnoses.

    With a numeric ``seq`` this is a hash aggregate with map-side partial
    aggregation."""
    return (
        codes.filter(F.col("ICD_Code_Type") == "D")
        .groupBy("claim_id")
        .agg(F.min("seq").alias("Principal_Seq"))
    )


def principal_diagnoses(codes: DataFrame) -> DataFrame:
    """(claim_id, Principal_Seq, Principal_Code): the diagnosis with the lowest ``seq``."""
    d = codes.filter(F.col("ICD_Code_Type") == "D")
    d = d.select("claim_id", F.col("seq").alias("Principal_Seq"), F.col("ICD_Code").alias("Principal_Code"))
    return d.join(principal_seq(codes), on=["claim_id", "Principal_Seq"], how="left_semi")


def mark_principal(codes: DataFrame, principal: DataFrame | None = None) -> DataFrame:
    """Add ``Is_Principal`` ('Y'/'N') to every claim code.

    ``principal`` (claim_id, Principal_Seq) may be given when the caller
    can derive it more cheaply than from ``codes``."""
    p = principal if principal is not None else principal_seq(codes)
    j = codes.join(p, on="claim_id", how="left")
    is_p = (F.col("ICD_Code_Type") == "D") & (F.col("seq") == F.col("Principal_Seq"))
    return j.withColumn("Is_Principal", F.when(is_p, F.lit("Y")).otherwise(F.lit("N"))).drop("Principal_Seq")


def claims_with_release(claims: DataFrame, manifest_df: DataFrame) -> DataFrame:
    """Claim headers with the release (fiscal year, ICD version) of their service date."""
    return release_of_date(claims, "service_date", manifest_df, how="left").drop("Effective_Date", "End_Date")


def edit_rule(
    newborn_max_age: int = 0,
    los_limit_hours: int = 96,
    los_flag_below: bool = True,
) -> Column:
    """Whether an edit row fires for its claim code (one CASE, JVM-side).

    Needs columns MCE_Edit_Type, Is_Principal, age, sex, los_hours.  Missing
    age / sex / LOS never fire (see :func:`unchecked_rule`).
    """
    age, sex, los = F.col("age"), F.col("sex"), F.col("los_hours")
    principal = F.col("Is_Principal") == "Y"
    t = F.col("MCE_Edit_Type")
    los_rule = (los < los_limit_hours) if los_flag_below else (los >= los_limit_hours)
    rule = (
        F.when(t == "Newborn_Only", age > newborn_max_age)
        .when(t == "Pediatric_Only", ~age.between(*PEDIATRIC_AGES))
        .when(t == "Maternity_Only", ~age.between(*MATERNITY_AGES))
        .when(t == "Adult_Only", ~age.between(*ADULT_AGES))
        .when(t == "Female_Only", sex != "F")
        .when(t == "Male_Only", sex != "M")
        .when(t.isin("Principal_Manifestation", "Principal_Questionable_Admit", "Principal_Unacceptable"), principal)
        .when(t.isin("Noncovered_Always", "Limited_Coverage", "Wrong_Performed"), F.lit(True))
        .when(t == "Noncovered_Over60", age > OVER_AGE)
        .when(t == "Noncovered_LOS_96hr", los_rule)
        .otherwise(F.lit(False))
    )
    return F.coalesce(rule, F.lit(False))


def unchecked_rule() -> Column:
    """Edit rows whose rule needs a value the claim lacks."""
    t = F.col("MCE_Edit_Type")
    needs_age = t.isin("Newborn_Only", "Pediatric_Only", "Maternity_Only", "Adult_Only", "Noncovered_Over60")
    needs_sex = t.isin("Female_Only", "Male_Only")
    return (needs_age & F.col("age").isNull()) | (needs_sex & F.col("sex").isNull()) | (
        (t == "Noncovered_LOS_96hr") & F.col("los_hours").isNull()
    )


def claim_code_context(
    codes: DataFrame, claims_rel: DataFrame | None = None, principal: DataFrame | None = None
) -> DataFrame:
    """Claim codes with principal marker and the claim's release, age, sex, LOS.

    ``claims_rel`` is the header with its release (:func:`claims_with_release`);
    pass ``None`` when the codes already carry those columns (claim lines
    stored with their header, or joined to it once upstream) to save a join."""
    marked = mark_principal(codes, principal)
    return marked if claims_rel is None else marked.join(claims_rel, on="claim_id", how="inner")


CODE_KEYS = ["CMS_Fiscal_Year", "ICD_Version", "ICD_Code_Type", "ICD_Code"]


def apply_edits(
    codes: DataFrame,
    edits: DataFrame,
    include_unchecked: bool = False,
    principal: DataFrame | None = None,
    edit_rows: int | None = None,
    **rule_params,
) -> DataFrame:
    """Single-code MCE edits that fire on claim codes (B17).

    ``codes`` carry the claim's release, age, sex and LOS; they meet the edits
    first (:func:`lookup_join`: broadcast after a count, ``edit_rows`` saves
    the count, or a salted shuffle), so only codes that have an edit go on to
    be marked as principal (``principal``: claim_id, Principal_Seq; codes that
    already have ``Is_Principal`` are taken as they are).  Output: one row per
    (claim code, firing edit).  With ``include_unchecked`` the edits that could
    not be evaluated (the claim lacks the age, sex or LOS the rule needs) are
    returned too, and ``Edit_Status`` tells 'flag' from 'unchecked'."""
    e = edits.select(*CODE_KEYS, "MCE_Edit_Type")
    j = lookup_join(codes, e, CODE_KEYS, "inner", ["claim_id"], edit_rows)
    if "Is_Principal" not in codes.columns:
        j = mark_principal(j, principal if principal is not None else principal_seq(codes))
    if not include_unchecked:
        return j.filter(edit_rule(**rule_params))
    status = F.when(edit_rule(**rule_params), F.lit("flag")).when(unchecked_rule(), F.lit("unchecked"))
    return j.withColumn("Edit_Status", status).filter(F.col("Edit_Status").isNotNull())


def invalid_codes(codes: DataFrame, code_tables: DataFrame, table_rows: int | None = None) -> DataFrame:
    """Claim codes absent from the code tables of the claim's release (B18)."""
    return lookup_join(codes, code_tables.select(*CODE_KEYS), CODE_KEYS, "left_anti", ["claim_id"], table_rows)


def duplicate_principal(codes: DataFrame, principal: DataFrame | None = None) -> DataFrame:
    """Claims where a secondary diagnosis repeats the principal one (B19):
    (claim_id, Principal_Code, n_occurrences >= 2).

    Per (claim, code) the first position and the count, numbers in a hash
    aggregate combined map-side, so a claim with a huge number of lines is no
    hot spot; only codes that occur twice meet their claim's principal position.
    The hash tables hold every (claim, code) of a task: deal large ``codes`` by
    claim first (:func:`claim_tasks`).
    """
    repeated = (
        codes.filter(F.col("ICD_Code_Type") == "D")
        .groupBy("claim_id", "ICD_Code")
        .agg(F.min("seq").alias("Principal_Seq"), F.count(F.lit(1)).cast("int").alias("n_occurrences"))
        .filter(F.col("n_occurrences") >= 2)
    )
    p = principal if principal is not None else principal_seq(codes)
    return repeated.join(p, on=["claim_id", "Principal_Seq"], how="left_semi").select(
        "claim_id", F.col("ICD_Code").alias("Principal_Code"), "n_occurrences"
    )


def external_cause_principal(
    codes: DataFrame, claims_rel: DataFrame | None, prefixes: Mapping[int, Sequence[str]], principal: DataFrame | None = None
) -> DataFrame:
    """Claims whose principal diagnosis is an external-cause code (B20).

    ``prefixes`` maps ICD version -> code prefixes; the reference names no
    list, so the caller supplies it.  With ``claims_rel=None`` the codes
    carry the claim's release columns themselves (no join).  Only codes with
    such a prefix meet their claim's principal position."""
    p = principal if principal is not None else principal_seq(codes)
    d = codes.filter(F.col("ICD_Code_Type") == "D")
    if claims_rel is not None:
        d = d.select("claim_id", "seq", "ICD_Code").join(claims_rel.select("claim_id", "CMS_Fiscal_Year", "ICD_Version"), "claim_id")
    cond = F.lit(False)
    for v, pres in prefixes.items():
        for pre in pres:
            cond = cond | ((F.col("ICD_Version") == int(v)) & F.col("ICD_Code").startswith(pre))
    external = d.filter(cond).select("claim_id", F.col("seq").alias("Principal_Seq"), "CMS_Fiscal_Year", "ICD_Version", F.col("ICD_Code").alias("Principal_Code"))
    return external.join(p, on=["claim_id", "Principal_Seq"], how="left_semi").select("claim_id", "CMS_Fiscal_Year", "ICD_Version", "Principal_Code")
