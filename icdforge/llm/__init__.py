"""Operators of a training-data pipeline (packing, near-dedup, quality,
language ID, mixing, URL filters, sharding, toxicity, WARC).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` registers
its queries only when it can be imported.
"""
