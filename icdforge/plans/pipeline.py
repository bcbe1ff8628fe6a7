"""Line rows -> standardised table rows, the dataflow shared by every load.

``lines`` is any DataFrame with a ``value`` column and ``CMS_File_Name``:
a scan of release files (:func:`icdforge.sources.read_lines`) or lines Spark
derives from other tables.  Parsing, release stamping and cleaning are
narrow (no shuffle); the manifest join is a broadcast hash join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import clean
from ..operators.releases import attach_release
from ..sources import layouts
from ..sources.parse import parse

# (table kind, ICD version) -> (layout, cleaning function)
STEPS: dict[tuple[str, int | None], tuple[layouts.Layout, Callable[..., DataFrame]]] = {
    ("desc", 9): (layouts.DESC_ICD9, clean.desc_icd9),
    ("desc", 10): (layouts.DESC_ICD10, clean.desc_icd10),
    ("poa", 9): (layouts.POA_ICD9, clean.poa_icd9),
    ("poa", 10): (layouts.POA_ICD10, clean.poa_icd10),
    ("mce", None): (layouts.MCE_EDITS, clean.mce),
}


def layout_for(kind: str, version: int | None) -> layouts.Layout:
    return STEPS[(kind, version)][0]


def standardize(lines: DataFrame, manifest_df: DataFrame, kind: str, version: int | None, **clean_kw) -> DataFrame:
    """parse -> attach release -> clean, keeping reject bookkeeping columns."""
    layout, clean_fn = STEPS[(kind, version)]
    parsed = parse(lines, layout)
    attached = attach_release(parsed, manifest_df)
    return clean_fn(attached, **clean_kw)


def icd10_headers(lines: DataFrame, manifest_df: DataFrame, code_name: str = "Diagnosis_Code") -> DataFrame:
    """Heading codes of ICD-10 order lines by release."""
    return clean.icd10_headers(attach_release(parse(lines, layout_for("desc", 10)), manifest_df), code_name)
