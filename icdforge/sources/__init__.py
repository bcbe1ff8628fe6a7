"""Sources: release-file layouts, line scans and layout parsers."""

from .codepage import code_pages
from .layouts import ALL_LAYOUTS, DESC_ICD9, DESC_ICD10, MCE_EDITS, POA_ICD9, POA_ICD10, Field, Layout
from .lines import FILE_NAME, read_lines
from .parse import RAW, REASON, parse, parse_fixed, parse_quoted_bar, parse_tab, split_rejects

__all__ = [
    "ALL_LAYOUTS", "DESC_ICD9", "DESC_ICD10", "MCE_EDITS", "POA_ICD9", "POA_ICD10", "Field", "Layout",
    "FILE_NAME", "code_pages", "read_lines", "RAW", "REASON", "parse", "parse_fixed", "parse_quoted_bar", "parse_tab",
    "split_rejects",
]
