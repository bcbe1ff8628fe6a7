"""Standardising projections from parsed file rows to table rows.

Each function takes parsed rows with release constants attached
(``Release_ICD_Version``, ``CMS_Fiscal_Year``, ``Effective_Date``,
``End_Date``) and returns the table's columns in table order, keeping the
bookkeeping columns ``_raw``, ``_reject_reason`` and ``CMS_File_Name`` so
rejects can be split off after cleaning.  Nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    cut,
    drop_periods,
    drop_quotes,
    icd9_add_period,
    icd9_period_problem,
    sql_trim,
    undouble_quotes,
)
from ..sources.lines import FILE_NAME
from ..sources.parse import RAW, REASON
from . import tables

BOOKKEEPING = [FILE_NAME, RAW, REASON]


def _keep(df: DataFrame) -> list[str]:
    return [c for c in BOOKKEEPING if c in df.columns]


def _release_cols() -> list[F.Column]:
    return [
        F.col("CMS_Fiscal_Year").cast("int").alias("CMS_Fiscal_Year"),
        F.col("Effective_Date"),
        F.col("End_Date"),
        F.col("Release_ICD_Version").cast("int").alias("ICD_Version"),
    ]


def desc_icd9(rows: DataFrame, code_name: str = "Diagnosis_Code") -> DataFrame:
    """ICD-9 descriptions: quote repair, trim, code cut to 5, texts to 60 / 323."""
    return rows.select(
        *_release_cols(),
        cut(sql_trim("ICD_Code"), 5).alias(code_name),
        cut(sql_trim(undouble_quotes("Code_Desc_Short")), 60).alias("Code_Desc_Short"),
        cut(sql_trim(undouble_quotes("Code_Desc_Long")), 323).alias("Code_Desc_Long"),
        *_keep(rows),
    )


def desc_icd10(rows: DataFrame, code_name: str = "Diagnosis_Code") -> DataFrame:
    """ICD-10 order file: only HIPAA-valid codes (header codes dropped), trim, cut.

    Rejected rows pass the filter so they reach the reject output.
    """
    valid = (F.col("Code_Is_HIPAA_Valid") == "1") | F.col(REASON).isNotNull() if REASON in rows.columns else (
        F.col("Code_Is_HIPAA_Valid") == "1"
    )
    return rows.filter(valid).select(
        *_release_cols(),
        cut(sql_trim("ICD_Code"), 7).alias(code_name),
        cut(sql_trim("Code_Desc_Short"), 60).alias("Code_Desc_Short"),
        cut(sql_trim("Code_Desc_Long"), 323).alias("Code_Desc_Long"),
        *_keep(rows),
    )


def icd10_headers(rows: DataFrame, code_name: str = "Diagnosis_Code") -> DataFrame:
    """The headings of the ICD-10 order file: codes that :func:`desc_icd10`
    leaves out because they are not valid for billing (release columns, code)."""
    return rows.filter(F.col("Code_Is_HIPAA_Valid") == "0").select(*_release_cols(), cut(sql_trim("ICD_Code"), 7).alias(code_name), *_keep(rows))


def _with_reason(df: DataFrame, extra: F.Column) -> DataFrame:
    if REASON in df.columns:
        return df.withColumn(REASON, F.coalesce(F.col(REASON), extra))
    return df.withColumn(REASON, extra)


def poa_icd9(rows: DataFrame) -> DataFrame:
    """ICD-9 POA-exempt list: upper-case, trim, code cut to 5, long text trimmed
    only; the period column is derived from the code (ICD-9 period rule)."""
    code = cut(sql_trim(F.upper(F.col("Diagnosis_Code"))), 5)
    staged = rows.withColumn("_code", code)
    out = staged.select(
        F.col("CMS_Fiscal_Year").cast("int").alias("CMS_Fiscal_Year"),
        F.col("Release_ICD_Version").cast("int").alias("ICD_Version"),
        "Effective_Date",
        "End_Date",
        F.col("_code").alias("Diagnosis_Code"),
        icd9_add_period(F.col("_code")).alias("Diagnosis_Code_With_Period"),
        sql_trim("Code_Desc_Long").alias("Code_Desc_Long"),
        icd9_period_problem(F.col("_code")).alias("_period_problem"),
        *_keep(rows),
    )
    return _with_reason(out, F.col("_period_problem")).drop("_period_problem")


def poa_icd10(rows: DataFrame) -> DataFrame:
    """ICD-10 POA-exempt list: code = upper, trim, periods removed, cut to 7;
    code with period = upper, trim, cut to 8; long = quotes removed, trim, cut."""
    up = sql_trim(F.upper(F.col("Diagnosis_Code_With_Period")))
    return rows.select(
        F.col("CMS_Fiscal_Year").cast("int").alias("CMS_Fiscal_Year"),
        F.col("Release_ICD_Version").cast("int").alias("ICD_Version"),
        "Effective_Date",
        "End_Date",
        cut(drop_periods(up), 7).alias("Diagnosis_Code"),
        cut(up, 8).alias("Diagnosis_Code_With_Period"),
        cut(sql_trim(drop_quotes("Code_Desc_Long")), 323).alias("Code_Desc_Long"),
        *_keep(rows),
    )


def mce(rows: DataFrame) -> DataFrame:
    """MCE edits: text fields as they are, section and version cast to int
    (the version comes from the row, not the manifest); MCE_Version dropped.
    ``Release_ICD_Version`` is kept for the version check."""
    return rows.select(
        F.col("CMS_Fiscal_Year").cast("int").alias("CMS_Fiscal_Year"),
        "Effective_Date",
        "End_Date",
        F.col("ICD_Version").try_cast("int").alias("ICD_Version"),
        "ICD_Code_Type",
        "ICD_Code",
        "ICD_Code_Desc",
        F.col("MCE_Section").try_cast("int").alias("MCE_Section"),
        "MCE_Subsection",
        "MCE_Edit_Type",
        F.col("Release_ICD_Version").cast("int").alias("Release_ICD_Version"),
        *_keep(rows),
    )


def rename_columns(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """Caller-chosen output column names (the seven field-name parameters)."""
    if not mapping:
        return df
    unknown = set(mapping) - set(df.columns)
    if unknown:
        raise ValueError(f"cannot rename unknown columns {sorted(unknown)}")
    return df.withColumnsRenamed(mapping)
