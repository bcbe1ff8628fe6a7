"""Release manifests and attaching release constants to file rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fiscal_year, fiscal_year_end, fiscal_year_start
from ..sources.lines import FILE_NAME
from ..sources.parse import REASON

# --- fixed values: the releases loaded by each job ---------------------------
# (ICD version, CMS fiscal year, file name); every release is effective from
# October 1 of the previous year through September 30 of its fiscal year.
DIAGNOSIS_RELEASES = (
    (10, 2016, "icd10cm_order_2016.txt"),
    (10, 2017, "icd10cm_order_2017.txt"),
    (10, 2018, "icd10cm_order_2018.txt"),
    (10, 2019, "icd10cm_order_2019.txt"),
    (10, 2020, "icd10cm_order_2020.txt"),
    (9, 2010, "V27LONG_SHORT_DX_110909u021012 Sheet1.txt"),
    (9, 2011, "CMS28_DESC_LONG_SHORT_DX Sheet1.txt"),
    (9, 2012, "CMS29_DESC_LONG_SHORT_DX 101111u021012 Sheet1.txt"),
    (9, 2013, "CMS30_DESC_LONG_SHORT_DX 080612 Sheet1.txt"),
    (9, 2014, "CMS31_DESC_LONG_SHORT_DX Sheet1.txt"),
    (9, 2015, "CMS32_DESC_LONG_SHORT_DX Sheet1.txt"),
)
PROCEDURE_RELEASES = (
    (10, 2016, "icd10pcs_order_2016.txt"),
    (10, 2017, "icd10pcs_order_2017.txt"),
    (10, 2018, "icd10pcs_order_2018.txt"),
    (10, 2019, "icd10pcs_order_2019.txt"),
    (10, 2020, "icd10pcs_order_2020.txt"),
    (9, 2010, "CMS27_DESC_LONG_SHORT_SG_092709 Sheet1.txt"),
    (9, 2011, "CMS28_DESC_LONG_SHORT_SG Sheet1.txt"),
    (9, 2012, "CMS29_DESC_LONG_SHORT_SG Sheet1.txt"),
    (9, 2013, "CMS30_DESC_LONG_SHORT_SG 051812 Sheet1.txt"),
    (9, 2014, "CMS31_DESC_LONG_SHORT_SG Sheet1.txt"),
    (9, 2015, "CMS32_DESC_LONG_SHORT_SG Sheet1.txt"),
)
POA_EXEMPT_RELEASES = (
    (10, 2016, "POAexemptcodes2016.txt"),
    (10, 2017, "POAexemptcodes2017.txt"),
    (10, 2018, "POAexemptcodes2018.txt"),
    (10, 2019, "POAexemptcodes2019.txt"),
    (10, 2020, "POAexemptcodes2020.txt"),
    (9, 2010, "POA_Exempt_Diagnosis_Codes_Generated_FY2010.txt"),
    (9, 2011, "POA_Exempt_Diagnosis_Codes_Generated_FY2011.txt"),
    (9, 2012, "POA_Exempt_Diagnosis_Codes_Oct12011_FY2012.txt"),
    (9, 2013, "POA_Exempt_Diagnosis_Codes_Oct12011_FY2012.txt"),
    (9, 2014, "POA_Exempt_Diagnosis_Codes_Oct12013_FY2014.txt"),
    (9, 2015, "ICD-9_POA_Exempt_Diagnosis_Codes_Oct12014_FY2015.txt"),
)
# (MCE release version, ICD version, CMS fiscal year)
MCE_RELEASES = (
    ("33", 10, 2016),
    ("34", 10, 2017),
    ("35", 10, 2018),
    ("36", 10, 2019),
    ("37", 10, 2020),
    ("26", 9, 2010),
    ("27", 9, 2011),
    ("28", 9, 2012),
    ("30", 9, 2013),
    ("31", 9, 2014),
    ("32", 9, 2015),
)
MCE_FILE_PREFIX = "MCE_Simple_Code_Edits_v"
MCE_FILE_SUFFIX = ".txt"
# -----------------------------------------------------------------------------

VERSION_CHOICES = {"ALL": (9, 10), "9": (9,), "09": (9,), "10": (10,)}

MANIFEST_COLUMNS = ["ICD_Version", "CMS_Fiscal_Year", "Effective_Date", "End_Date", FILE_NAME]


def mce_file_name(version_col) -> F.Column:
    return F.concat(F.lit(MCE_FILE_PREFIX), version_col, F.lit(MCE_FILE_SUFFIX))


def with_validity(df: DataFrame) -> DataFrame:
    """Add Effective_Date / End_Date (fiscal-year bounds, both inclusive)."""
    fy = F.col("CMS_Fiscal_Year")
    return df.withColumn("Effective_Date", fiscal_year_start(fy)).withColumn("End_Date", fiscal_year_end(fy))


def manifest(spark: SparkSession, releases) -> DataFrame:
    """Manifest DataFrame from (version, FY, file) triples."""
    df = spark.createDataFrame(
        [(int(v), int(fy), name) for v, fy, name in releases],
        f"ICD_Version INT, CMS_Fiscal_Year INT, {FILE_NAME} STRING",
    )
    return with_validity(df).select(*MANIFEST_COLUMNS)


def mce_manifest(spark: SparkSession, releases=MCE_RELEASES) -> DataFrame:
    df = spark.createDataFrame(
        [(mv, int(v), int(fy)) for mv, v, fy in releases],
        "MCE_Release_Version STRING, ICD_Version INT, CMS_Fiscal_Year INT",
    )
    df = with_validity(df).withColumn(FILE_NAME, mce_file_name(F.col("MCE_Release_Version")))
    return df.select("MCE_Release_Version", *MANIFEST_COLUMNS)


def select_versions(manifest_df: DataFrame, which: str) -> DataFrame:
    """Releases of the requested ICD version(s): 'ALL', '9', '09' or '10'."""
    key = str(which).strip().upper()
    if key not in VERSION_CHOICES:
        raise ValueError(f"unknown ICD version choice {which!r}; use one of {sorted(VERSION_CHOICES)}")
    return manifest_df.filter(F.col("ICD_Version").isin(*VERSION_CHOICES[key]))


def ordered(manifest_df: DataFrame) -> DataFrame:
    return manifest_df.orderBy("CMS_Fiscal_Year", "ICD_Version")


def attach_release(rows: DataFrame, manifest_df: DataFrame, on: str = FILE_NAME) -> DataFrame:
    """Stamp release constants on every row of a file.

    Equi-join on the file name; a file named by several releases is stamped
    once per release.  Rows of a file that no release names stay, without
    release constants; parsed rows among them are rejects with the reason
    ``unknown_release``.  The manifest holds one row per release, so it is
    broadcast (its size is bounded by the number of releases, not by data).
    The manifest's version arrives as ``Release_ICD_Version``.
    """
    m = manifest_df.select(
        F.col(on),
        F.col("ICD_Version").alias("Release_ICD_Version"),
        "CMS_Fiscal_Year",
        "Effective_Date",
        "End_Date",
    )
    out = rows.join(F.broadcast(m), on=on, how="left")
    if REASON in rows.columns:
        unknown = F.when(F.col("Release_ICD_Version").isNull(), F.lit("unknown_release"))
        out = out.withColumn(REASON, F.coalesce(F.col(REASON), unknown))
    return out


def release_of_date(df: DataFrame, date_col: str, manifest_df: DataFrame, how: str = "left") -> DataFrame:
    """As-of lookup: the release in effect on ``date_col`` (validity bounds
    inclusive).

    Each manifest row is listed under every fiscal year its validity interval
    touches (one for fiscal-year releases), so the fiscal year of the date is
    an equi-key - a hash join against the broadcast manifest instead of a
    nested loop - and the interval itself is checked in the join condition.
    Exact for any intervals; the manifest stays one row per release and year.
    """
    m = manifest_df.select(
        "ICD_Version",
        "CMS_Fiscal_Year",
        "Effective_Date",
        "End_Date",
        F.explode(F.sequence(fiscal_year(F.col("Effective_Date")), fiscal_year(F.col("End_Date")))).alias("_rel_fy"),
    )
    d = df.withColumn("_svc_fy", fiscal_year(F.col(date_col)))
    cond = (
        (d["_svc_fy"] == m["_rel_fy"])
        & (d[date_col].cast("date") >= m["Effective_Date"])
        & (d[date_col].cast("date") <= m["End_Date"])
    )
    return d.join(F.broadcast(m), cond, how).drop("_svc_fy", "_rel_fy")
