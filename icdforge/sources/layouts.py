"""The five flat-file layouts of the code-set releases.

A layout is plain data: its fields in *file* order, the widths the bulk-load
format gives them (used as maximum lengths), which fields are kept, and the
order of the kept fields in the loaded rowset.  The parsers in
:mod:`icdforge.sources.parse` turn a layout into Spark column expressions; no
format-file interpreter is involved.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Field:
    name: str
    width: int
    keep: bool = True


@dataclass(frozen=True)
class Layout:
    name: str
    kind: str  # "fixed" | "quoted_bar" | "tab"
    fields: tuple[Field, ...]
    # order of the kept fields in the loaded rowset (names)
    rowset_order: tuple[str, ...]
    header: bool  # True: first line of every file is a header and is skipped
    # fixed layouts: minimum line length (start of the last field - 1)
    min_length: int = 0
    int_fields: tuple[str, ...] = field(default=())


# --- fixed values: field names, widths and orders of the release files -------
DESC_ICD10 = Layout(
    name="desc_icd10",
    kind="fixed",
    fields=(
        Field("ICD_Code_Order", 5),
        Field("Filler_01", 1, keep=False),
        Field("ICD_Code", 7),
        Field("Filler_02", 1, keep=False),
        Field("Code_Is_HIPAA_Valid", 1),
        Field("Filler_03", 1, keep=False),
        Field("Code_Desc_Short", 60),
        Field("Filler_04", 1, keep=False),
        Field("Code_Desc_Long", 323),
    ),
    rowset_order=("ICD_Code_Order", "ICD_Code", "Code_Is_HIPAA_Valid", "Code_Desc_Short", "Code_Desc_Long"),
    header=False,
    min_length=77,
)

DESC_ICD9 = Layout(
    name="desc_icd9",
    kind="quoted_bar",
    fields=(
        Field("ICD_Code", 7),
        Field("Code_Desc_Long", 323),
        Field("Code_Desc_Short", 60),
    ),
    rowset_order=("ICD_Code", "Code_Desc_Short", "Code_Desc_Long"),
    header=True,
)

POA_ICD9 = Layout(
    name="poa_icd9",
    kind="tab",
    fields=(Field("Diagnosis_Code", 8), Field("Code_Desc_Long", 323)),
    rowset_order=("Diagnosis_Code", "Code_Desc_Long"),
    header=True,
)

POA_ICD10 = Layout(
    name="poa_icd10",
    kind="tab",
    fields=(
        Field("ICD_Code_Order", 5, keep=False),
        Field("Diagnosis_Code_With_Period", 8),
        Field("Code_Desc_Long", 323),
    ),
    rowset_order=("Diagnosis_Code_With_Period", "Code_Desc_Long"),
    header=True,
)

MCE_EDITS = Layout(
    name="mce_edits",
    kind="tab",
    fields=(
        Field("MCE_Version", 2),
        Field("ICD_Version", 2),
        Field("MCE_Section", 2),
        Field("MCE_Subsection", 2),
        Field("MCE_Edit_Type", 32),
        Field("ICD_Code_Type", 1),
        Field("ICD_Code", 7),
        Field("ICD_Code_Desc", 64),
    ),
    rowset_order=(
        "ICD_Version",
        "ICD_Code_Type",
        "ICD_Code",
        "ICD_Code_Desc",
        "MCE_Version",
        "MCE_Section",
        "MCE_Subsection",
        "MCE_Edit_Type",
    ),
    header=True,
    int_fields=("ICD_Version", "MCE_Section"),
)

ALL_LAYOUTS = {l.name: l for l in (DESC_ICD10, DESC_ICD9, POA_ICD9, POA_ICD10, MCE_EDITS)}
# -----------------------------------------------------------------------------
