"""Column functions (built-in expressions only)."""

from .text import (
    cut,
    drop_periods,
    drop_quotes,
    fiscal_year,
    fiscal_year_end,
    fiscal_year_start,
    icd9_add_period,
    icd9_period_category_length,
    icd9_period_problem,
    sql_trim,
    undouble_quotes,
)

__all__ = [
    "cut", "drop_periods", "drop_quotes", "fiscal_year", "fiscal_year_end",
    "fiscal_year_start", "icd9_add_period", "icd9_period_category_length", "icd9_period_problem", "sql_trim",
    "undouble_quotes",
]
