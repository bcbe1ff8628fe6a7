"""Output table definitions: columns (in table order), text limits, keys."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Column_:
    name: str
    sql_type: str  # INT, DATE, STRING, VARCHAR(n)
    nullable: bool = False

    @property
    def max_length(self) -> int | None:
        t = self.sql_type.upper()
        if t.startswith("VARCHAR("):
            return int(t[len("VARCHAR(") : -1])
        return None


@dataclass(frozen=True)
class TableSpec:
    default_name: str
    columns: tuple[Column_, ...]
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ("ICD_Version", "CMS_Fiscal_Year")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def renamed(self, mapping: dict[str, str]) -> "TableSpec":
        ren = lambda n: mapping.get(n, n)
        return TableSpec(
            self.default_name,
            tuple(Column_(ren(c.name), c.sql_type, c.nullable) for c in self.columns),
            tuple(ren(k) for k in self.keys),
            tuple(ren(p) for p in self.partition_by),
        )

    def limits(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length}

    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


# --- fixed values: the four dimension tables (names, column order, types, keys)
DIAGNOSIS = TableSpec(
    "DIM_ICD_Diagnosis",
    (
        Column_("CMS_Fiscal_Year", "INT"),
        Column_("Effective_Date", "DATE"),
        Column_("End_Date", "DATE"),
        Column_("ICD_Version", "INT"),
        Column_("Diagnosis_Code", "VARCHAR(7)"),
        Column_("Code_Desc_Short", "VARCHAR(60)"),
        Column_("Code_Desc_Long", "VARCHAR(323)"),
    ),
    ("CMS_Fiscal_Year", "ICD_Version", "Diagnosis_Code"),
)

PROCEDURE = TableSpec(
    "DIM_ICD_Procedure",
    (
        Column_("CMS_Fiscal_Year", "INT"),
        Column_("Effective_Date", "DATE"),
        Column_("End_Date", "DATE"),
        Column_("ICD_Version", "INT"),
        Column_("Procedure_Code", "VARCHAR(7)"),
        Column_("Code_Desc_Short", "VARCHAR(60)"),
        Column_("Code_Desc_Long", "VARCHAR(323)"),
    ),
    ("CMS_Fiscal_Year", "ICD_Version", "Procedure_Code"),
)

POA_EXEMPT = TableSpec(
    "DIM_ICD_Diagnosis_POA_Exempt",
    (
        Column_("CMS_Fiscal_Year", "INT"),
        Column_("ICD_Version", "INT"),
        Column_("Effective_Date", "DATE"),
        Column_("End_Date", "DATE"),
        Column_("Diagnosis_Code", "VARCHAR(7)"),
        Column_("Diagnosis_Code_With_Period", "VARCHAR(8)"),
        Column_("Code_Desc_Long", "VARCHAR(323)"),
    ),
    ("CMS_Fiscal_Year", "ICD_Version", "Diagnosis_Code"),
)

MCE_EDITS = TableSpec(
    "DIM_ICD_MCE_Simple_Code_Edits",
    (
        Column_("CMS_Fiscal_Year", "INT"),
        Column_("Effective_Date", "DATE"),
        Column_("End_Date", "DATE"),
        Column_("ICD_Version", "INT"),
        Column_("ICD_Code_Type", "VARCHAR(1)"),
        Column_("ICD_Code", "VARCHAR(7)"),
        Column_("ICD_Code_Desc", "VARCHAR(64)"),
        Column_("MCE_Section", "INT"),
        Column_("MCE_Subsection", "VARCHAR(1)"),
        Column_("MCE_Edit_Type", "VARCHAR(32)"),
    ),
    ("CMS_Fiscal_Year", "ICD_Version", "MCE_Section", "MCE_Subsection", "ICD_Code_Type", "ICD_Code"),
)
# -----------------------------------------------------------------------------
