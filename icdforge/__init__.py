"""icdforge: versioned medical code sets on Apache Spark.

Loads yearly releases of ICD diagnosis / procedure descriptions, POA-exempt
lists and MCE simple code edits from flat files into partitioned dimension
tables, and offers DataFrame operators over those tables (release deltas,
description drift, range expansion, as-of lookup, edit summaries and applying
single-code edits to claims).

Sub-packages:
    sources    file layouts, line scans, layout parsers with reject capture
    functions  column expressions (SQL-Server-compatible trim, fiscal year,
               ICD-9 period rule, ...)
    operators  DataFrame -> DataFrame building blocks (releases, cleaning,
               quality checks, analytics, claim edits, join strategies)
    plans      end-to-end jobs (load_* functions), table sinks and the
               query catalogue used by the driver
    streaming  incremental (Structured Streaming) variants of the claim edits
"""

__version__ = "0.1.0"
