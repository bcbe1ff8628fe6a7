"""Layout parsers: one ``value`` line column -> typed-as-text fields.

Every parser keeps the input line as ``_raw`` and adds ``_reject_reason``
(NULL for good rows).  The first failing check wins, in this order:
structure (quoting, field count, line length), field widths in file order,
integer fields.  :func:`split_rejects` separates good from rejected rows, the
counterpart of a bulk load's error file.

All work is column expressions, so a scan of many files is one stage of
whole-stage-codegen'd projections, split by file blocks across executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .layouts import Layout

RAW = "_raw"
REASON = "_reject_reason"
_PARTS = "_parts"


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(cond, F.lit(reason)) for cond, reason in checks], F.lit(None).cast("string"))


def materialize(df: DataFrame, cols: list[Column]) -> DataFrame:
    """``df.select(*cols)`` evaluated exactly once per row.

    Filters on the result (the reject split, downstream predicates) would
    otherwise be pushed below the projection with every column expression
    substituted at each reference, re-evaluating (and, through stacked
    projections, multiplying) the parse work.  A one-row ``inline`` generator
    is an evaluation boundary the optimizer does not push filters through.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


def _null_if_empty(c: Column) -> Column:
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def _passthrough(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "value"]


def parse_fixed(lines: DataFrame, layout: Layout) -> DataFrame:
    """Fixed-width layout: fields by position; the last field runs to line end."""
    v = F.col("value")
    starts: dict[str, int] = {}
    start = 1
    for f in layout.fields:
        starts[f.name] = start
        start += f.width
    last = layout.fields[-1]

    def field(line: Column, f) -> Column:
        if f is last:
            return F.substring(line, starts[f.name], 1 << 30)
        return F.substring(line, starts[f.name], f.width)

    reason = _first_reason(
        [
            (F.length(v) < layout.min_length, "line_too_short"),
            (F.length(field(v, last)) > last.width, f"field_too_long:{last.name}"),
        ]
    )
    by_name = {f.name: f for f in layout.fields}
    out = [F.col(c) for c in _passthrough(lines)]
    out += [field(v, by_name[n]).alias(n) for n in layout.rowset_order]
    out += [v.alias(RAW), reason.alias(REASON)]
    return materialize(lines, out)


def _parse_split(lines: DataFrame, layout: Layout, body: Column, sep_regex: str, struct_checks) -> DataFrame:
    n = len(layout.fields)
    staged = lines.select(*_passthrough(lines), F.col("value"), F.split(body, sep_regex, -1).alias(_PARTS))

    parts = F.col(_PARTS)
    fields = {f.name: _null_if_empty(F.get(parts, i)) for i, f in enumerate(layout.fields)}
    checks = list(struct_checks(F.col("value")))
    checks.append((F.size(parts) != n, "field_count"))
    for f in layout.fields:
        checks.append((F.coalesce(F.length(fields[f.name]), F.lit(0)) > f.width, f"field_too_long:{f.name}"))
    for name in layout.int_fields:
        checks.append((fields[name].isNotNull() & fields[name].try_cast("int").isNull(), f"not_an_integer:{name}"))
    out = [F.col(c) for c in _passthrough(lines)]
    out += [fields[n].alias(n) for n in layout.rowset_order]
    out += [F.col("value").alias(RAW), _first_reason(checks).alias(REASON)]
    # the line and its split are computed once below the boundary; every
    # field and check reads them as attributes
    return materialize(staged, out)


def parse_quoted_bar(lines: DataFrame, layout: Layout) -> DataFrame:
    """``"a"|"b"|"c"`` lines: outer quotes stripped, split on ``"|"``.

    Doubled quotes inside a field are left for the cleaning step, exactly
    once, as the bulk load leaves them.
    """
    body = F.expr("substring(value, 2, length(value) - 2)")

    def struct_checks(value: Column):
        ok = value.startswith('"') & value.endswith('"') & (F.length(value) >= 2)
        return [(~ok, "bad_quoting")]

    return _parse_split(lines, layout, body, '"\\|"', struct_checks)


def parse_tab(lines: DataFrame, layout: Layout) -> DataFrame:
    return _parse_split(lines, layout, F.col("value"), "\t", lambda value: [])


def parse(lines: DataFrame, layout: Layout) -> DataFrame:
    if layout.kind == "fixed":
        return parse_fixed(lines, layout)
    if layout.kind == "quoted_bar":
        return parse_quoted_bar(lines, layout)
    if layout.kind == "tab":
        return parse_tab(lines, layout)
    raise ValueError(f"unknown layout kind {layout.kind!r}")


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the bookkeeping columns, rejected rows)."""
    good = parsed.filter(F.col(REASON).isNull()).drop(RAW, REASON)
    bad = parsed.filter(F.col(REASON).isNotNull())
    return good, bad
