"""DataFrame -> DataFrame operators."""

from . import analytics, claims, clean, joins, quality, releases, tables

__all__ = ["analytics", "claims", "clean", "joins", "quality", "releases", "tables"]
