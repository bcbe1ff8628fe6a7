"""Code-set releases derived from the driver's TPC-H-style tables.

The driver ships no medical data, so the query catalogue derives it: each
``part`` row stands for one code that lives through a span of fiscal years,
``orders`` / ``lineitem`` stand for claims and claim lines.  Every derived
column is one SQL expression that Spark and DuckDB evaluate identically, so
the Spark side (which writes release *lines* and runs them through the
library's parsers and cleaners) and the DuckDB oracle (which computes the
expected fields straight from the same columns, never by parsing) start
from the same facts.

Work grows with the tables: a part yields one row per fiscal year it lives
in (at most seven), a line item one claim code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.claims import MCE_EDIT_TYPES
from ..operators.releases import manifest, mce_manifest
from ..sources.lines import FILE_NAME

# --- fixed values: the adapter's release calendar ------------------------------
# Order dates span 1995-01-01 .. 2001-08-01, i.e. CMS fiscal years 1995-2001.
# ICD-10 starts with fiscal year 1999 (the real switch was FY 2016).
FY_FIRST = 1995
FY_LAST = 2001
ICD10_FROM = 1999
FISCAL_YEARS = tuple(range(FY_FIRST, FY_LAST + 1))
POA_SHARED = (1996, 1997)  # the FY 1996 POA file is loaded for 1996 and 1997
MCE_VERSION_OFFSET = 1970  # MCE release version = FY - 1970
# -----------------------------------------------------------------------------

P = "p_partkey"


def _s(x: str) -> str:
    return f"cast({x} as string)"


def _letter(num: str) -> str:
    return f"chr(cast(65 + {num} % 26 as integer))"


# --- codes: injective in the part key up to a stated capacity, loud beyond it ---
RAISE = "__raise__"  # raise_error in Spark, error in DuckDB
BASE36 = "__base36__"  # a number's digits in base 36, of each engine's own


def base36(num: str, width: str | int) -> str:
    """``num`` in base 36, with leading zeros up to ``width`` digits."""
    own = f"{BASE36}({num})"
    return f"lpad({own}, cast(greatest(length({own}), {width}) as integer), '0')"


def within(num: str, capacity: int, what: str, expr: str) -> str:
    return f"case when {num} >= {capacity} then {RAISE}('{what}: no code for part ' || {_s(num)}) else {expr} end"


def tens(p: str) -> str:
    return f"cast(({p} - {p} % 10) / 10 as bigint)"


def letters(p: str) -> str:
    return f"cast(({p} - {p} % 26) / 26 as bigint)"


DX9_PARTS = 10 * 36**4
PX9_PARTS = 36**5
DX10_PARTS = 26 * 36**6
PX10_PARTS = 26 * 36**5


def dx9(p: str, r10: str, q10: str) -> str:
    """ICD-9 diagnosis code of a part: E, V or a digit, then 2 to 4 characters."""
    return within(p, DX9_PARTS, "ICD-9 diagnosis", (
        f"(case when {r10} = 0 then 'E' || {base36(q10, f'3 + {q10} % 2')}"
        f" when {r10} = 1 then 'V' || {base36(q10, f'2 + {q10} % 3')}"
        f" else {_s(r10)} || {base36(q10, f'2 + {q10} % 3')} end)"))


def px9(p: str) -> str:
    return within(p, PX9_PARTS, "ICD-9 procedure", base36(p, f"3 + {p} % 2"))


def dx10(p: str, q26: str) -> str:
    return within(p, DX10_PARTS, "ICD-10 diagnosis", f"{_letter(p)} || {base36(q26, 6)}")


def px10(p: str, q26: str) -> str:
    return within(p, PX10_PARTS, "ICD-10 procedure", f"'0' || {_letter(p)} || {base36(q26, 5)}")


def _called(expr: str, left: str, right: str) -> str:
    """``BASE36(x)`` (x without brackets of its own but pairs) as left x right."""
    while BASE36 in expr:
        at = expr.index(BASE36)
        start = at + len(BASE36) + 1
        end, depth = start, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(expr[end], 0)
            end += 1
        expr = expr[:at] + left + expr[start:end - 1] + right + expr[end:]
    return expr


def spark_sql(expr: str) -> str:
    return _called(expr.replace(RAISE, "raise_error"), "conv(cast(", " as string), 10, 36)")


def duck_sql(expr: str) -> str:
    return _called(expr.replace(RAISE, "error"), "to_base(cast(", " as bigint), 36)")


# Columns of a part, whatever the year: codes and texts are made once a part.
PART_STAGES: list[list[tuple[str, str]]] = [
    [
        ("r10", f"{P} % 10"),
        ("q10", tens(P)),
        ("q26", letters(P)),
        (
            "short",
            f"(case when {P} % 7 = 0 then '\"' || p_name || '\" ' else p_name || ' ' end) || lower(p_type)"
            f" || (case when {P} % 9 = 0 then ' ' || repeat('x', cast({P} % 30 as integer)) else '' end)",
        ),
        (
            "core0",
            f"upper(substring(p_name, 1, 1)) || substring(p_name, 2) || ' of ' || lower(p_type)"
            f" || ' size ' || {_s('p_size')}"
            f" || (case when {P} % 7 = 0 then ', \"quoted\"' else '' end)",
        ),
        ("tail", f"case when {P} % 13 = 0 then ' ' || repeat(p_name || ' ', cast({P} % 20 as integer)) else '' end"),
        ("pad", f"case when {P} % 5 = 0 then ' ' else '' end"),
        ("hipaa", f"case when {P} % 10 = 5 then '0' else '1' end"),
        ("exempt", "p_size <= 10"),
    ],
    [("dxc9", dx9(P, "r10", "q10")), ("dxc10", dx10(P, "q26")), ("pxc9", px9(P)), ("pxc10", px10(P, "q26"))],
]

# Columns of a part in a year; a stage may use columns of earlier stages.
STAGES: list[list[tuple[str, str]]] = [
    [
        ("ver", f"case when fy >= {ICD10_FROM} then 10 else 9 end"),
        ("core", f"core0 || (case when fy >= 1996 + {P} % 7 then ' (revised ' || {_s(f'1996 + {P} % 7')} || ')' else '' end)"),
    ],
    [
        ("code9", "case when ver = 9 then dxc9 end"),
        ("code10", "case when ver = 10 then dxc10 end"),
        ("px_code", "case when ver = 10 then pxc10 else pxc9 end"),
        ("long", "core || tail"),
        (
            "poa_long",
            f"(case {P} % 6 when 1 then replace(core, ' ', '  ') when 2 then upper(core)"
            " when 3 then core || ' NOS' when 4 then replace(core, ' size ', ' sise ') else core end) || tail",
        ),
    ],
    [
        ("dx_code", "coalesce(code10, code9)"),
        ("cwp10", "substring(code10, 1, 3) || '.' || substring(code10, 4)"),
    ],
]

# Life span of a code: first and last fiscal year it is released in.
FIRST_FY = f"{FY_FIRST} + {P} % 4"
LAST_FY = f"{FY_LAST} - {P} % 3"
# MCE lists lag deletions by one release and hold parts up to size 32.
MCE_LAST_FY = f"least({LAST_FY} + 1, {FY_LAST})"
MCE_MEMBER = "p_size <= 32"


def _edit_field(field_index: int, quote: bool, dialect: str) -> str:
    """Field of the MCE edit-type table picked by ``p_size % 16``: a lookup
    in a constant array (folded to one literal by both engines)."""
    vals = [(f"'{row[field_index]}'" if quote else str(row[field_index])) for row in MCE_EDIT_TYPES]
    idx = "cast(p_size % 16 + 1 as integer)"
    if dialect == "spark":
        return f"element_at(array({', '.join(vals)}), {idx})"
    return f"[{', '.join(vals)}][{idx}]"


def mce_stages(dialect: str) -> list[list[tuple[str, str]]]:
    return [
        [
            ("mce_section", _edit_field(0, False, dialect)),
            ("mce_sub0", _edit_field(1, True, dialect)),
            ("mce_type", _edit_field(2, True, dialect)),
            ("mce_code_type", _edit_field(3, True, dialect)),
            ("mce_version", _s(f"fy - {MCE_VERSION_OFFSET}")),
        ],
        [
            # section 8 is relabelled 8 A from FY 2000 on
            ("mce_sub", "case when mce_section = 8 and fy >= 2000 then 'A' else mce_sub0 end"),
            ("mce_code", "case when mce_code_type = 'P' then px_code else dx_code end"),
            ("mce_desc", "substring(short, 1, 64)"),
        ],
    ]


# File names of the adapter's releases, one pattern for SQL and Python.
FILE_PATTERNS = {
    ("dx", 9): "dx9_{}.txt", ("dx", 10): "dx10_{}.txt",
    ("proc", 9): "px9_{}.txt", ("proc", 10): "px10_{}.txt",
    ("poa", 9): "poa9_{}.txt", ("poa", 10): "poa10_{}.txt",
    ("mce", None): "mce_{}.txt",
}
FILE_NAMES = {k: "'" + v.replace("{}", "' || cast(fy as string) || '") + "'" for k, v in FILE_PATTERNS.items()}


def _py_file_name(kind: str, version: int | None, fy: int) -> str:
    if kind == "poa" and version == 9 and fy == POA_SHARED[1]:
        fy = POA_SHARED[0]
    return FILE_PATTERNS[(kind, version)].format(fy)


def version_of(fy: int) -> int:
    return 10 if fy >= ICD10_FROM else 9


def adapter_manifest(spark: SparkSession, kind: str) -> DataFrame:
    """Release manifest of the adapter calendar (one row per fiscal year;
    bounded by the calendar, so it is safe to broadcast)."""
    if kind == "mce":
        m = mce_manifest(spark, [(f"{fy - MCE_VERSION_OFFSET}", version_of(fy), fy) for fy in FISCAL_YEARS])
        return m.withColumn(FILE_NAME, F.expr(FILE_NAMES[("mce", None)].replace("fy", "CMS_Fiscal_Year")))
    return manifest(spark, [(version_of(fy), fy, _py_file_name(kind, version_of(fy), fy)) for fy in FISCAL_YEARS])


# ---------------------------------------------------------------- Spark side --
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the driver's data set."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stage(df: DataFrame, stage: list[tuple[str, str]]) -> DataFrame:
    # one call per stage: expressions are parsed JVM-side in a batch
    return df.selectExpr("*", *[f"{spark_sql(e)} AS {n}" for n, e in stage])


def part_releases(spark: SparkSession, sf_dir: str, mce: bool = False) -> DataFrame:
    """One row per (part, fiscal year it is released in) with derived codes
    and texts.  ``mce=True`` gives the MCE membership instead (parts up to
    size 32, one extra year after deletion)."""
    part = read_table(spark, sf_dir, "part").select(P, "p_name", "p_type", "p_size")
    if mce:
        part = part.filter(F.expr(MCE_MEMBER))
    last = MCE_LAST_FY if mce else LAST_FY
    df = part
    for st in PART_STAGES:
        df = _stage(df, st)
    df = df.selectExpr("*", f"explode(sequence({FIRST_FY}, {last})) AS fy")
    for st in STAGES:
        df = _stage(df, st)
    if mce:
        for st in mce_stages("spark"):
            df = _stage(df, st)
    return df


def release_rows(spark: SparkSession, sf_dir: str, mce: bool = False) -> int:
    """How many rows :func:`part_releases` has, from the parts' life spans
    alone (no code or text is derived for it)."""
    part = read_table(spark, sf_dir, "part")
    if mce:
        part = part.filter(F.expr(MCE_MEMBER))
    years = f"{MCE_LAST_FY if mce else LAST_FY} - ({FIRST_FY}) + 1"
    return int(part.selectExpr(f"coalesce(sum({years}), 0) AS n").first()["n"])


TAB = "chr(9)"

LINE_EXPRS = {
    # ICD-10 order file, fixed width
    ("desc", 10): (
        "lpad(cast({p} % 100000 as string), 5, '0') || ' ' || rpad({code}, 7, ' ') || ' ' || hipaa || ' '"
        " || rpad(short, 60, ' ') || ' ' || pad || pad || long"
    ),
    # ICD-9 quoted, bar-delimited; quotes inside fields doubled
    ("desc", 9): (
        "'\"' || pad || {code} || pad || '\"|\"' || replace(pad || pad || long, '\"', '\"\"')"
        " || '\"|\"' || replace(short, '\"', '\"\"') || '\"'"
    ),
    ("poa", 9): "(case when {p} % 4 = 0 then lower(code9) else code9 end) || " + TAB + " || ' ' || poa_long || ' '",
    ("poa", 10): (
        "lpad(cast({p} % 100000 as string), 5, '0') || " + TAB + " || (case when {p} % 4 = 0 then lower(cwp10) else cwp10 end) || "
        + TAB + " || '\"' || poa_long || '\"'"
    ),
    ("mce", None): (
        "mce_version || " + TAB + " || cast(ver as string) || " + TAB + " || cast(mce_section as string) || "
        + TAB + " || mce_sub || " + TAB + " || mce_type || " + TAB + " || mce_code_type || " + TAB
        + " || mce_code || " + TAB + " || mce_desc"
    ),
}


def line_expr(kind: str, version: int | None, table: str = "dx") -> str:
    code = "dx_code" if table == "dx" else "px_code"
    return LINE_EXPRS[(kind, version)].format(p=P, code=code)


def release_lines(spark: SparkSession, sf_dir: str, kind: str, version: int | None, table: str = "dx") -> DataFrame:
    """Lines of the release files of one layout (``value``, ``CMS_File_Name``)."""
    if kind == "mce":
        pr = part_releases(spark, sf_dir, mce=True)
        name = FILE_NAMES[("mce", None)]
    else:
        pr = part_releases(spark, sf_dir).filter(F.col("ver") == version)
        if kind == "poa":
            pr = pr.filter("exempt")
            if version == 9:
                pr = pr.filter(F.col("fy") != POA_SHARED[1])  # shared file holds the FY 1996 content
        name = FILE_NAMES[(table if kind == "desc" else kind, version)]
    return pr.selectExpr(f"{line_expr(kind, version, table)} AS value", f"{name} AS {FILE_NAME}")


# --------------------------------------------------------------- DuckDB side --
def duck_stage(prev_sql: str, stage: list[tuple[str, str]]) -> str:
    cols = ", ".join(f"{duck_sql(e)} AS {n}" for n, e in stage)
    return f"SELECT *, {cols} FROM ({prev_sql})"


def duck_part_releases(mce: bool = False) -> str:
    last = MCE_LAST_FY if mce else LAST_FY
    where = f" WHERE {MCE_MEMBER}" if mce else ""
    sql = f"SELECT {P}, p_name, p_type, p_size FROM part{where}"
    for st in PART_STAGES:
        sql = duck_stage(sql, st)
    sql = f"SELECT *, unnest(generate_series({FIRST_FY}, {last})) AS fy FROM ({sql})"
    for st in STAGES:
        sql = duck_stage(sql, st)
    if mce:
        for st in mce_stages("duckdb"):
            sql = duck_stage(sql, st)
    return sql
