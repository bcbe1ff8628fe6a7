"""Column functions with the semantics the code-set loads rely on.

All are built-in Spark expressions (codegen'd, no Python at run time).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_trim(c) -> Column:
    """LTRIM(RTRIM(c)): strips blanks (0x20) only; tabs are kept."""
    return F.trim(_c(c))


def cut(c, n: int) -> Column:
    """SUBSTRING(c, 1, n)."""
    return F.substring(_c(c), 1, n)


def undouble_quotes(c) -> Column:
    """REPLACE(c, '""', '"'): undo the doubled quotes of quoted files."""
    return F.replace(_c(c), F.lit('""'), F.lit('"'))


def drop_quotes(c) -> Column:
    return F.replace(_c(c), F.lit('"'), F.lit(""))


def drop_periods(c) -> Column:
    return F.replace(_c(c), F.lit("."), F.lit(""))


def fiscal_year(date_col) -> Column:
    """CMS fiscal year of a date: October 1 starts the next fiscal year."""
    d = _c(date_col).cast("date")
    return (F.year(d) + F.when(F.month(d) >= 10, 1).otherwise(0)).cast("int")


def fiscal_year_start(fy) -> Column:
    return F.make_date(_c(fy) - 1, F.lit(10), F.lit(1))


def fiscal_year_end(fy) -> Column:
    return F.make_date(_c(fy), F.lit(9), F.lit(30))


def icd9_period_category_length(code) -> Column:
    """Category length of an ICD-9 diagnosis code: 4 for E codes, 3 for V or
    digit codes, NULL for anything else (no period rule applies)."""
    code = _c(code)
    return F.when(code.startswith("E"), F.lit(4)).when(code.rlike("^[V0-9]"), F.lit(3))


def icd9_add_period(code) -> Column:
    """ICD-9 diagnosis code with its period.

    E codes get the period after character 4, V and numeric codes after
    character 3; a code exactly as long as its category has no period.
    Codes shorter than their category and codes of other shapes give NULL
    (see :func:`icd9_period_problem`).
    """
    code = _c(code)
    cat = icd9_period_category_length(code)
    n = F.length(code)
    return (
        F.when(cat.isNull() | (n < cat), F.lit(None).cast("string"))
        .when(n == cat, code)
        .otherwise(F.concat(F.substring(code, F.lit(1), cat), F.lit("."), F.substring(code, cat + 1, n - cat)))
    )


def icd9_period_problem(code) -> Column:
    """Reason the period rule cannot run on a row, else NULL."""
    code = _c(code)
    cat = icd9_period_category_length(code)
    return F.when(cat.isNotNull() & (F.length(code) < cat), F.lit("shorter_than_category"))
