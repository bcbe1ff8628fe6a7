"""DuckDB oracle SQL for the query catalogue.

Each statement computes the expected result straight from the derived
columns of :mod:`icdforge.plans.tpch_codes` (shared with the Spark side as
input facts) using plain SQL: the expected fields are written down from the
reference rules, lines are never parsed.
"""

from __future__ import annotations

from ..operators.wording import EDIT
from . import catalog as C
from . import tpch_codes as T

FYS = T.FISCAL_YEARS


def _date(y: int, m: int, d: int) -> str:
    return f"DATE '{y:04d}-{m:02d}-{d:02d}'"


def _manifest_values() -> str:
    rows = ", ".join(
        f"({T.version_of(fy)}, {fy}, {_date(fy - 1, 10, 1)}, {_date(fy, 9, 30)})" for fy in FYS
    )
    return f"SELECT * FROM (VALUES {rows}) AS t(ICD_Version, CMS_Fiscal_Year, Effective_Date, End_Date)"


def _pairs_values() -> str:
    rows = []
    for v in (9, 10):
        fys = [fy for fy in FYS if T.version_of(fy) == v]
        rows += [f"({v}, {a}, {b})" for a, b in zip(fys, fys[1:])]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(ICD_Version, From_FY, To_FY)"


def _dates(fy: str) -> str:
    return (
        f"make_date(cast({fy} - 1 as integer), 10, 1) AS Effective_Date, "
        f"make_date(cast({fy} as integer), 9, 30) AS End_Date"
    )


# characters before the period: E codes 4, others 3; a code of just that length takes none
_CATEGORY = "(CASE WHEN code[1] = 'E' THEN 4 ELSE 3 END)"
PERIOD = (
    f"CASE WHEN regexp_matches(code, '^[EV0-9]') AND length(code) >= {_CATEGORY}"
    f" THEN rtrim(left(code, {_CATEGORY}) || '.' || substring(code, {_CATEGORY} + 1), '.') END"
)


def _desc_dim(code_col: str, out_name: str) -> str:
    return f"""SELECT cast(fy as integer) AS CMS_Fiscal_Year, {_dates('fy')}, cast(ver as integer) AS ICD_Version,
  CASE WHEN ver = 10 THEN substring(trim(rpad({code_col}, 7, ' ')), 1, 7)
       ELSE substring(trim(pad || {code_col} || pad), 1, 5) END AS {out_name},
  CASE WHEN ver = 10 THEN substring(trim(rpad(short, 60, ' ')), 1, 60)
       ELSE substring(trim(short), 1, 60) END AS Code_Desc_Short,
  substring(trim(pad || pad || long), 1, 323) AS Code_Desc_Long,
  p_partkey, pad, long
FROM pr WHERE ver = 9 OR hipaa = '1'"""


POA9SRC = f"""SELECT *, fy AS fy_out FROM pr WHERE ver = 9 AND exempt AND fy <> {T.POA_SHARED[1]}
UNION ALL SELECT *, {T.POA_SHARED[1]} AS fy_out FROM pr WHERE exempt AND fy = {T.POA_SHARED[0]}"""

POA9 = f"""SELECT cast(fy_out as integer) AS CMS_Fiscal_Year, 9 AS ICD_Version, {_dates('fy_out')},
  code AS Diagnosis_Code, {PERIOD} AS Diagnosis_Code_With_Period, trim(' ' || poa_long || ' ') AS Code_Desc_Long
FROM (SELECT *, substring(trim(upper(CASE WHEN p_partkey % 4 = 0 THEN lower(code9) ELSE code9 END)), 1, 5) AS code
      FROM poa9src)"""

POA10 = f"""SELECT cast(fy as integer) AS CMS_Fiscal_Year, 10 AS ICD_Version, {_dates('fy')},
  substring(replace(trim(upper(cwpf)), '.', ''), 1, 7) AS Diagnosis_Code,
  substring(trim(upper(cwpf)), 1, 8) AS Diagnosis_Code_With_Period,
  substring(trim(replace('"' || poa_long || '"', '"', '')), 1, 323) AS Code_Desc_Long
FROM (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN lower(cwp10) ELSE cwp10 END AS cwpf FROM pr WHERE ver = 10 AND exempt)"""

MCE = f"""SELECT cast(fy as integer) AS CMS_Fiscal_Year, {_dates('fy')}, cast(ver as integer) AS ICD_Version,
  mce_code_type AS ICD_Code_Type, mce_code AS ICD_Code, mce_desc AS ICD_Code_Desc,
  cast(mce_section as integer) AS MCE_Section, mce_sub AS MCE_Subsection, mce_type AS MCE_Edit_Type, p_partkey
FROM mr"""

CODES = """SELECT CMS_Fiscal_Year, ICD_Version, 'D' AS ICD_Code_Type, Diagnosis_Code AS ICD_Code, Code_Desc_Short FROM dx
UNION ALL SELECT CMS_Fiscal_Year, ICD_Version, 'P' AS ICD_Code_Type, Procedure_Code AS ICD_Code, Code_Desc_Short FROM px"""

DX_COLS = ", ".join(C.DX_COLS)
PX_COLS = ", ".join(C.PX_COLS)
POA_COLS = ", ".join(C.POA_COLS)
MCE_COLS = ", ".join(C.MCE_COLS)

BASE = {
    "pr": T.duck_part_releases(),
    "mr": T.duck_part_releases(mce=True),
    "dx": _desc_dim("dx_code", "Diagnosis_Code"),
    "px": _desc_dim("px_code", "Procedure_Code"),
    "poa9src": POA9SRC,
    "poa": f"SELECT {POA_COLS} FROM ({POA9}) UNION ALL SELECT {POA_COLS} FROM ({POA10})",
    "mce": MCE,
    "codes": CODES,
    "man": _manifest_values(),
    "pairs": _pairs_values(),
}

FY_OF = (
    "cast(year(cast({d} as date)) + CASE WHEN month(cast({d} as date)) >= 10 THEN 1 ELSE 0 END as integer)"
)

CLAIMS = {
    "hdr": f"""SELECT o_orderkey AS claim_id, cast(o_orderdate as date) AS service_date,
  cast(o_custkey % 100 as integer) AS age, CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
  cast(o_orderkey % 10 as integer) * 24 AS los_hours, m.CMS_Fiscal_Year, m.ICD_Version
FROM orders LEFT JOIN man m ON {FY_OF.format(d='o_orderdate')} = m.CMS_Fiscal_Year""",
    "cl0": f"""SELECT l_orderkey AS claim_id, l_partkey AS p_partkey, l_linenumber,
  {', '.join(f"{e.replace('p_partkey', 'l_partkey')} AS {n}" for n, e in C.CLAIM_PARTS.items())},
  CASE WHEN {FY_OF.format(d='o_orderdate')} >= {T.ICD10_FROM} THEN 10 ELSE 9 END AS ver
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ccodes": f"""SELECT claim_id, l_linenumber, p_partkey, 'D' AS ICD_Code_Type, {C.CLAIM_DX} AS ICD_Code FROM cl0
UNION ALL SELECT claim_id, l_linenumber, p_partkey, 'P' AS ICD_Code_Type, {C.CLAIM_PX} AS ICD_Code FROM cl0""",
    "principal": """SELECT claim_id, min(cast(l_linenumber as bigint) * 1000000000000 + p_partkey) AS pkey
FROM ccodes WHERE ICD_Code_Type = 'D' GROUP BY claim_id""",
    "pcode": """SELECT DISTINCT c.claim_id, c.ICD_Code AS Principal_Code FROM ccodes c JOIN principal p
  ON c.claim_id = p.claim_id AND c.ICD_Code_Type = 'D' AND cast(c.l_linenumber as bigint) * 1000000000000 + c.p_partkey = p.pkey""",
    "ctx": """SELECT c.claim_id, c.ICD_Code_Type, c.ICD_Code,
  CASE WHEN c.ICD_Code_Type = 'D' AND cast(c.l_linenumber as bigint) * 1000000000000 + c.p_partkey = p.pkey
       THEN 'Y' ELSE 'N' END AS Is_Principal,
  h.age, h.sex, h.los_hours, h.CMS_Fiscal_Year, h.ICD_Version
FROM ccodes c LEFT JOIN principal p ON c.claim_id = p.claim_id JOIN hdr h ON c.claim_id = h.claim_id""",
}


def _with(*names: str, extra: dict | None = None) -> str:
    """WITH clause holding the named CTEs (dependencies included, in order)."""
    order = list(BASE) + list(CLAIMS)
    src = {**BASE, **CLAIMS, **(extra or {})}
    deps = {
        "dx": ["pr"], "px": ["pr"], "poa9src": ["pr"], "poa": ["pr", "poa9src"], "mce": ["mr"],
        "codes": ["dx", "px"], "hdr": ["man"], "ccodes": ["cl0"], "principal": ["ccodes"],
        "pcode": ["ccodes", "principal"], "ctx": ["ccodes", "principal", "hdr"],
    }
    need: list[str] = []

    def add(n):
        for d in deps.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=lambda n: order.index(n) if n in order else len(order))
    return "WITH " + ",\n".join(f"{n} AS ({src[n]})" for n in need) + "\n"


def _file(kind, version):
    return T.FILE_NAMES[(kind, version)]


RULE = """CASE MCE_Edit_Type
  WHEN 'Newborn_Only' THEN age > 0
  WHEN 'Pediatric_Only' THEN NOT (age BETWEEN 0 AND 17)
  WHEN 'Maternity_Only' THEN NOT (age BETWEEN 12 AND 55)
  WHEN 'Adult_Only' THEN NOT (age BETWEEN 15 AND 124)
  WHEN 'Female_Only' THEN sex <> 'F'
  WHEN 'Male_Only' THEN sex <> 'M'
  WHEN 'Principal_Manifestation' THEN Is_Principal = 'Y'
  WHEN 'Principal_Questionable_Admit' THEN Is_Principal = 'Y'
  WHEN 'Principal_Unacceptable' THEN Is_Principal = 'Y'
  WHEN 'Noncovered_Always' THEN true
  WHEN 'Limited_Coverage' THEN true
  WHEN 'Wrong_Performed' THEN true
  WHEN 'Noncovered_Over60' THEN age > 60
  WHEN 'Noncovered_LOS_96hr' THEN los_hours < 96
  ELSE false END"""


def _line(kind, version):
    return "(" + T.line_expr(kind, version) + ")"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_fixed_width"] = _with("pr") + f"""SELECT {_file('dx', 10)} AS CMS_File_Name,
  lpad(cast(p_partkey % 100000 as string), 5, '0') AS ICD_Code_Order, rpad(dx_code, 7, ' ') AS ICD_Code,
  hipaa AS Code_Is_HIPAA_Valid, rpad(short, 60, ' ') AS Code_Desc_Short, pad || pad || long AS Code_Desc_Long
FROM pr WHERE ver = 10"""
    q["scan_quoted_bar"] = _with("pr") + f"""SELECT {_file('dx', 9)} AS CMS_File_Name, pad || dx_code || pad AS ICD_Code,
  replace(short, '"', '""') AS Code_Desc_Short, replace(pad || pad || long, '"', '""') AS Code_Desc_Long
FROM pr WHERE ver = 9"""
    q["scan_tab2"] = _with("pr") + f"""SELECT {_file('poa', 9)} AS CMS_File_Name,
  CASE WHEN p_partkey % 4 = 0 THEN lower(code9) ELSE code9 END AS Diagnosis_Code,
  ' ' || poa_long || ' ' AS Code_Desc_Long
FROM pr WHERE ver = 9 AND exempt AND fy <> {T.POA_SHARED[1]}"""
    q["scan_tab3_skip"] = _with("pr") + f"""SELECT {_file('poa', 10)} AS CMS_File_Name,
  CASE WHEN p_partkey % 4 = 0 THEN lower(cwp10) ELSE cwp10 END AS Diagnosis_Code_With_Period,
  '"' || poa_long || '"' AS Code_Desc_Long
FROM pr WHERE ver = 10 AND exempt"""
    q["scan_tab8_reorder"] = _with("mr") + f"""SELECT {_file('mce', None)} AS CMS_File_Name,
  cast(ver as string) AS ICD_Version, mce_code_type AS ICD_Code_Type, mce_code AS ICD_Code, mce_desc AS ICD_Code_Desc,
  mce_version AS MCE_Version, cast(mce_section as string) AS MCE_Section, mce_sub AS MCE_Subsection,
  mce_type AS MCE_Edit_Type
FROM mr"""
    q["reject_rows"] = _with("pr", "mr") + f"""SELECT 'desc_icd9' AS Layout, {_file('dx', 9)} AS CMS_File_Name,
  {C.FAULTS_DESC9.format(line=_line('desc', 9))} AS raw,
  CASE p_partkey % 17 WHEN 1 THEN 'field_count' WHEN 2 THEN 'field_too_long:ICD_Code' ELSE 'bad_quoting' END AS reason
FROM pr WHERE ver = 9 AND p_partkey % 17 IN (1, 2, 3)
UNION ALL
SELECT 'desc_icd10', {_file('dx', 10)}, {C.FAULTS_DESC10.format(line=_line('desc', 10))}, 'line_too_short'
FROM pr WHERE ver = 10 AND p_partkey % 17 = 4
UNION ALL
SELECT 'mce_edits', {_file('mce', None)}, {C.FAULTS_MCE.format(line=_line('mce', None))}, 'not_an_integer:MCE_Section'
FROM mr WHERE p_partkey % 17 = 5"""
    man_from_orders = f"""SELECT DISTINCT {FY_OF.format(d='o_orderdate')} AS fy FROM orders"""
    q["release_manifest"] = f"""SELECT cast(CASE WHEN fy >= {T.ICD10_FROM} THEN 10 ELSE 9 END as integer) AS ICD_Version,
  fy AS CMS_Fiscal_Year, {_dates('fy')},
  CASE WHEN fy >= {T.ICD10_FROM} THEN {_file('dx', 10)} ELSE {_file('dx', 9)} END AS CMS_File_Name,
  {_file('mce', None)} AS MCE_File_Name
FROM ({man_from_orders})"""
    mo = f"SELECT fy AS CMS_Fiscal_Year, CASE WHEN fy >= {T.ICD10_FROM} THEN 10 ELSE 9 END AS ICD_Version, CASE WHEN fy >= {T.ICD10_FROM} THEN {_file('dx', 10)} ELSE {_file('dx', 9)} END AS CMS_File_Name FROM ({man_from_orders})"
    parts = []
    for which, cond in (("ALL", "true"), ("9", "ICD_Version = 9"), ("09", "ICD_Version = 9"), ("10", "ICD_Version = 10")):
        parts.append(
            f"SELECT '{which}' AS Which_ICD_Version_To_Load, cast(ICD_Version as integer) AS ICD_Version, CMS_Fiscal_Year, CMS_File_Name FROM mo WHERE {cond}"
        )
    q["release_filter"] = f"WITH mo AS ({mo})\n" + "\nUNION ALL\n".join(parts)
    poa_code = "CASE WHEN p_partkey % 4 = 0 THEN lower(code9) ELSE code9 END AS Diagnosis_Code"
    q["attach_release"] = _with("poa9src") + f"""SELECT {_file('poa', 9)} AS CMS_File_Name,
  9 AS ICD_Version, cast(fy_out as integer) AS CMS_Fiscal_Year, {_dates('fy_out')}, {poa_code}, cast(NULL AS varchar) AS reason
FROM poa9src WHERE NOT {C.UNLISTED}
UNION ALL
SELECT 'unlisted.txt', NULL, NULL, NULL, NULL, {poa_code}, 'unknown_release' FROM poa9src WHERE {C.UNLISTED} AND fy = fy_out"""
    q["version_mismatch"] = _with("mr") + f"""SELECT {_file('mce', None)} AS CMS_File_Name, cast(fy as integer) AS CMS_Fiscal_Year,
  cast(ver as integer) AS Release_ICD_Version, CASE WHEN ver = 10 THEN 9 ELSE 10 END AS ICD_Version, mce_code AS ICD_Code
FROM mr WHERE p_partkey % 23 = 7"""
    q["asof_release"] = _with("man") + """SELECT o_orderkey, cast(o_orderdate as date) AS service_date,
  m.CMS_Fiscal_Year, m.ICD_Version, m.Effective_Date, m.End_Date
FROM orders LEFT JOIN man m ON cast(o_orderdate as date) BETWEEN m.Effective_Date AND m.End_Date"""
    q["fiscal_year"] = f"""SELECT o_orderkey, cast(o_orderdate as date) AS service_date, {FY_OF.format(d='o_orderdate')} AS CMS_Fiscal_Year
FROM orders"""
    q["dx_load_icd9"] = _with("dx") + f"SELECT {DX_COLS} FROM dx WHERE ICD_Version = 9"
    q["dx_load_icd10"] = _with("dx") + f"SELECT {DX_COLS} FROM dx WHERE ICD_Version = 10"
    q["dx_load_union"] = _with("dx") + f"SELECT {DX_COLS} FROM dx"
    q["proc_load"] = _with("px") + f"SELECT {PX_COLS} FROM px"
    q["poa_load_icd9"] = _with("poa") + f"SELECT {POA_COLS} FROM poa WHERE ICD_Version = 9"
    q["poa_load_icd10"] = _with("poa") + f"SELECT {POA_COLS} FROM poa WHERE ICD_Version = 10"
    q["poa_load_union"] = _with("poa") + f"SELECT {POA_COLS} FROM poa"
    q["mce_load"] = _with("mce") + f"SELECT {MCE_COLS} FROM mce"
    q["rename_columns"] = _with("dx") + "SELECT " + ", ".join(f"{c} AS {C.RENAMES.get(c, c)}" for c in C.DX_COLS) + " FROM dx"
    q["code_period"] = _with("dx") + f"""SELECT ICD_Version, CMS_Fiscal_Year, code AS Diagnosis_Code,
  CASE WHEN ICD_Version = 9 THEN {PERIOD} END AS Diagnosis_Code_With_Period
FROM (SELECT *, Diagnosis_Code AS code FROM dx)"""
    q["pk_violations"] = _with("dx") + """SELECT CMS_Fiscal_Year, ICD_Version, Diagnosis_Code, 2 AS n_rows
FROM dx WHERE p_partkey % 29 <= 1"""
    q["not_null_violations"] = _with("poa9src") + f"""SELECT CMS_Fiscal_Year, ICD_Version, Diagnosis_Code, column_name FROM (
  SELECT cast(fy_out as integer) AS CMS_Fiscal_Year, 9 AS ICD_Version,
    substring(trim(upper('X' || substring(code9, 2))), 1, 5) AS Diagnosis_Code, 'Diagnosis_Code_With_Period' AS column_name
  FROM poa9src WHERE p_partkey % 31 = 0
  UNION ALL
  SELECT cast(fy_out as integer), 9, substring(trim(upper(code9)), 1, 5), 'Code_Desc_Long'
  FROM poa9src WHERE p_partkey % 31 = 1)"""
    q["length_violations"] = _with("mce") + """SELECT CMS_Fiscal_Year, ICD_Version, MCE_Section, 'AA' AS MCE_Subsection, ICD_Code_Type, ICD_Code,
  'MCE_Subsection' AS column_name, 1 AS max_length, 2 AS actual_length
FROM mce WHERE p_partkey % 37 = 0"""
    q["slice_replace"] = _with("dx") + f"""SELECT {DX_COLS} FROM dx WHERE ICD_Version = 9
UNION ALL
SELECT CMS_Fiscal_Year, Effective_Date, End_Date, ICD_Version, Diagnosis_Code, Code_Desc_Short,
  substring(trim(pad || pad || long || CASE WHEN p_partkey % 3 = 0 THEN ' (corrected)' ELSE '' END), 1, 323) AS Code_Desc_Long
FROM dx WHERE ICD_Version = 10"""
    q["edit_join"] = _with("codes", "mce") + """SELECT c.CMS_Fiscal_Year, c.ICD_Version, c.ICD_Code_Type, c.ICD_Code, c.Code_Desc_Short,
  m.MCE_Section, m.MCE_Subsection, m.MCE_Edit_Type
FROM codes c LEFT JOIN mce m ON c.CMS_Fiscal_Year = m.CMS_Fiscal_Year AND c.ICD_Version = m.ICD_Version
  AND c.ICD_Code_Type = m.ICD_Code_Type AND c.ICD_Code = m.ICD_Code"""
    q["wide_dim"] = _with("codes", "mce") + """SELECT c.CMS_Fiscal_Year, c.ICD_Version, c.ICD_Code_Type, c.ICD_Code, c.Code_Desc_Short,
  e.Edit_Types, cast(coalesce(e.n_edit_types, 0) as integer) AS n_edit_types
FROM codes c LEFT JOIN (
  SELECT CMS_Fiscal_Year, ICD_Version, ICD_Code_Type, ICD_Code,
    array_to_string(list_sort(list_distinct(list(MCE_Edit_Type))), ',') AS Edit_Types,
    count(DISTINCT MCE_Edit_Type) AS n_edit_types
  FROM mce GROUP BY ALL) e
ON c.CMS_Fiscal_Year = e.CMS_Fiscal_Year AND c.ICD_Version = e.ICD_Version
  AND c.ICD_Code_Type = e.ICD_Code_Type AND c.ICD_Code = e.ICD_Code"""
    q["poa_flag"] = _with("dx", "poa") + """SELECT d.CMS_Fiscal_Year, d.ICD_Version, d.Diagnosis_Code,
  CASE WHEN p.Diagnosis_Code IS NOT NULL THEN 'Y' ELSE 'N' END AS Is_POA_Exempt
FROM dx d LEFT JOIN (SELECT DISTINCT CMS_Fiscal_Year, ICD_Version, Diagnosis_Code FROM poa) p
  ON d.CMS_Fiscal_Year = p.CMS_Fiscal_Year AND d.ICD_Version = p.ICD_Version AND d.Diagnosis_Code = p.Diagnosis_Code"""
    cols = ", ".join(f"cast(count(*) FILTER (WHERE CMS_Fiscal_Year = {fy}) as integer) AS FY_{fy}" for fy in FYS)
    q["edit_pivot"] = _with("mce") + f"SELECT MCE_Section, MCE_Subsection, MCE_Edit_Type, ICD_Code_Type, {cols} FROM mce GROUP BY ALL"
    q["fd_check"] = _with("mce") + """SELECT 'section->type' AS key_kind, CMS_Fiscal_Year,
  concat_ws('|', cast(MCE_Section as string), MCE_Subsection) AS key,
  cast(count(DISTINCT concat_ws('|', MCE_Edit_Type, ICD_Code_Type)) as integer) AS n_distinct
FROM mce GROUP BY 1, 2, 3
UNION ALL
SELECT 'type->section', CMS_Fiscal_Year, concat_ws('|', MCE_Edit_Type, ICD_Code_Type),
  cast(count(DISTINCT concat_ws('|', cast(MCE_Section as string), MCE_Subsection)) as integer)
FROM mce GROUP BY 1, 2, 3"""
    q["edit_orphans"] = _with("codes", "mce") + """SELECT m.CMS_Fiscal_Year, m.ICD_Version, m.ICD_Code_Type, m.ICD_Code,
  m.MCE_Section, m.MCE_Subsection, m.MCE_Edit_Type
FROM mce m WHERE NOT EXISTS (SELECT 1 FROM codes c WHERE c.CMS_Fiscal_Year = m.CMS_Fiscal_Year
  AND c.ICD_Version = m.ICD_Version AND c.ICD_Code_Type = m.ICD_Code_Type AND c.ICD_Code = m.ICD_Code)"""
    sq = "trim(regexp_replace({x}, ' +', ' ', 'g'))"
    # alignment of words by dynamic programming: one recursion step per word of a, each a whole row over the words of b
    same = "p.CMS_Fiscal_Year = d.CMS_Fiscal_Year AND p.ICD_Version = d.ICD_Version AND p.Diagnosis_Code = d.Diagnosis_Code"
    x = "string_split(a, ' ')[i + 1]"
    y = "string_split(b, ' ')[j]"
    near = f"(translate({x} || {y}, '0123456789', '') = {x} || {y} AND levenshtein({x}, {y}) * 4 <= greatest(length({x}), length({y})))"
    pair = f"CASE WHEN {x} = {y} THEN 0 WHEN {near} THEN levenshtein({x}, {y}) * {EDIT} ELSE levenshtein({x}, {y}) * {EDIT} + 1 END"
    alone = f"(length({x}) * {EDIT} + 1)"
    align = f"""RECURSIVE al0 AS (SELECT DISTINCT upper({sq.format(x='p.Code_Desc_Long')}) AS a, upper({sq.format(x='d.Code_Desc_Long')}) AS b
  FROM poa p JOIN dx d ON {same}),
st AS (SELECT a, b, len(string_split(b, ' ')) AS m,
    list_transform(range(0, len(string_split(b, ' ')) + 1), lambda j: coalesce(list_sum(list_transform(string_split(b, ' ')[1:j], lambda w: length(w) * {EDIT} + 1)), 0)) AS skip
  FROM al0 WHERE a <> b),
dp AS (SELECT a, b, 0::BIGINT AS i, m, skip, skip AS cells FROM st
  UNION ALL
  SELECT a, b, i + 1, m, skip, list_transform(range(1, m + 2), lambda k: list_min(list_transform(range(1, k + 1), lambda t: cand[t] + skip[k] - skip[t])))
  FROM (SELECT *, list_transform(range(0, m + 1), lambda j: CASE WHEN j = 0 THEN cells[1] + {alone} ELSE least(cells[j + 1] + {alone}, cells[j] + {pair}) END) AS cand
    FROM dp WHERE i < len(string_split(a, ' ')))),
al AS (SELECT a, b, cells[m + 1]::BIGINT AS cost FROM dp WHERE i = len(string_split(a, ' ')))"""
    base = _with("dx", "poa")
    q["desc_discrepancy"] = base.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ",\n" + align.replace("RECURSIVE ", "", 1) + "\n" + f"""SELECT p.CMS_Fiscal_Year, p.ICD_Version, p.Diagnosis_Code,
  p.Code_Desc_Long AS POA_Desc, d.Code_Desc_Long AS Dx_Desc,
  CASE WHEN {sq.format(x='p.Code_Desc_Long')} = {sq.format(x='d.Code_Desc_Long')} THEN 'spacing'
       WHEN upper({sq.format(x='p.Code_Desc_Long')}) = upper({sq.format(x='d.Code_Desc_Long')}) THEN 'case'
       WHEN al.cost % {EDIT} = 0 THEN 'spelling' ELSE 'wording' END AS Difference,
  cast(levenshtein(p.Code_Desc_Long, d.Code_Desc_Long) as integer) AS Edit_Distance
FROM poa p JOIN dx d ON p.CMS_Fiscal_Year = d.CMS_Fiscal_Year AND p.ICD_Version = d.ICD_Version
  AND p.Diagnosis_Code = d.Diagnosis_Code
LEFT JOIN al ON al.a = upper({sq.format(x='p.Code_Desc_Long')}) AND al.b = upper({sq.format(x='d.Code_Desc_Long')})
WHERE p.Code_Desc_Long <> d.Code_Desc_Long"""
    q["desc_changes"] = _with("dx") + """SELECT * FROM (
  SELECT ICD_Version, Diagnosis_Code, CMS_Fiscal_Year, Code_Desc_Long,
    lag(CMS_Fiscal_Year) OVER w AS Prev_Fiscal_Year, lag(Code_Desc_Long) OVER w AS Prev_Desc
  FROM dx WINDOW w AS (PARTITION BY ICD_Version, Diagnosis_Code ORDER BY CMS_Fiscal_Year))
WHERE Prev_Desc IS NOT NULL AND Prev_Desc <> Code_Desc_Long"""
    q["range_expand"] = _with("dx") + f"""SELECT r.Range_Lo, r.Range_Hi, d.CMS_Fiscal_Year, d.Diagnosis_Code
FROM (SELECT {C.RANGE_LO} AS Range_Lo, {C.RANGE_HI} AS Range_Hi FROM part) r
JOIN dx d ON d.ICD_Version = 10 AND d.Diagnosis_Code BETWEEN r.Range_Lo AND r.Range_Hi"""
    delta = """SELECT coalesce(o.ICD_Version, n.ICD_Version) AS ICD_Version, coalesce(o.From_FY, n.From_FY) AS From_FY,
  coalesce(o.To_FY, n.To_FY) AS To_FY, coalesce(o.Diagnosis_Code, n.Diagnosis_Code) AS Diagnosis_Code,
  CASE WHEN o.Old_Desc IS NULL THEN 'added' WHEN n.New_Desc IS NULL THEN 'deleted'
       WHEN o.Old_Desc <> n.New_Desc THEN 'revised' END AS Change,
  o.Old_Desc, n.New_Desc
FROM (SELECT d.ICD_Version, p.From_FY, p.To_FY, d.Diagnosis_Code, d.Code_Desc_Long AS Old_Desc
      FROM dx d JOIN pairs p ON d.ICD_Version = p.ICD_Version AND d.CMS_Fiscal_Year = p.From_FY) o
FULL OUTER JOIN
     (SELECT d.ICD_Version, p.From_FY, p.To_FY, d.Diagnosis_Code, d.Code_Desc_Long AS New_Desc
      FROM dx d JOIN pairs p ON d.ICD_Version = p.ICD_Version AND d.CMS_Fiscal_Year = p.To_FY) n
ON o.ICD_Version = n.ICD_Version AND o.From_FY = n.From_FY AND o.To_FY = n.To_FY AND o.Diagnosis_Code = n.Diagnosis_Code"""
    q["release_delta"] = _with("dx", "pairs") + f"SELECT * FROM ({delta}) WHERE Change IS NOT NULL"
    q["delta_unapply"] = _with("dx", "pairs") + """SELECT d.ICD_Version, d.CMS_Fiscal_Year, d.Diagnosis_Code, d.Code_Desc_Long
FROM dx d JOIN pairs p ON d.ICD_Version = p.ICD_Version AND d.CMS_Fiscal_Year = p.From_FY"""
    q["release_identity"] = _with("poa", "pairs") + """, t AS (
  SELECT p.ICD_Version, p.From_FY, p.To_FY, Diagnosis_Code, Diagnosis_Code_With_Period, Code_Desc_Long, 1 AS o, 0 AS n
  FROM poa x JOIN pairs p ON x.ICD_Version = p.ICD_Version AND x.CMS_Fiscal_Year = p.From_FY
  UNION ALL
  SELECT p.ICD_Version, p.From_FY, p.To_FY, Diagnosis_Code, Diagnosis_Code_With_Period, Code_Desc_Long, 0, 1
  FROM poa x JOIN pairs p ON x.ICD_Version = p.ICD_Version AND x.CMS_Fiscal_Year = p.To_FY),
g AS (SELECT ICD_Version, From_FY, To_FY, sum(o) AS o, sum(n) AS n FROM t
      GROUP BY ICD_Version, From_FY, To_FY, Diagnosis_Code, Diagnosis_Code_With_Period, Code_Desc_Long),
s AS (SELECT ICD_Version, From_FY, To_FY, sum(greatest(o - n, 0)) AS a, sum(greatest(n - o, 0)) AS b FROM g
      GROUP BY ICD_Version, From_FY, To_FY)
SELECT p.ICD_Version, p.From_FY, p.To_FY, cast(coalesce(s.a, 0) as integer) AS n_only_old,
  cast(coalesce(s.b, 0) as integer) AS n_only_new,
  CASE WHEN coalesce(s.a, 0) = 0 AND coalesce(s.b, 0) = 0 THEN 'Y' ELSE 'N' END AS Is_Identical
FROM pairs p LEFT JOIN s ON p.ICD_Version = s.ICD_Version AND p.From_FY = s.From_FY AND p.To_FY = s.To_FY"""
    q["delta_chain"] = q["delta_unapply"]
    ends = "SELECT ICD_Version, min(From_FY) AS From_FY, max(To_FY) AS To_FY FROM pairs GROUP BY ICD_Version"
    q["delta_compose"] = _with("dx", "pairs").rstrip() + f", ends AS ({ends})\nSELECT * FROM ({delta.replace('JOIN pairs p', 'JOIN ends p')}) WHERE Change IS NOT NULL"
    q["identity_by_fingerprint"] = q["release_identity"][:q["release_identity"].rindex("SELECT p.ICD_Version")] + """SELECT p.ICD_Version, p.From_FY, p.To_FY,
  (SELECT count(*) FROM poa x WHERE x.ICD_Version = p.ICD_Version AND x.CMS_Fiscal_Year = p.From_FY) AS n_old,
  (SELECT count(*) FROM poa x WHERE x.ICD_Version = p.ICD_Version AND x.CMS_Fiscal_Year = p.To_FY) AS n_new,
  CASE WHEN coalesce(s.a, 0) = 0 AND coalesce(s.b, 0) = 0 THEN 'Y' ELSE 'N' END AS Is_Identical
FROM pairs p LEFT JOIN s ON p.ICD_Version = s.ICD_Version AND p.From_FY = s.From_FY AND p.To_FY = s.To_FY"""
    spans = f"""SELECT ICD_Version, ICD_Code_Type, ICD_Code, min(CMS_Fiscal_Year) AS From_FY, max(CMS_Fiscal_Year) AS To_FY, cast(count(*) as integer) AS n_releases
FROM (SELECT *, CMS_Fiscal_Year - row_number() OVER (PARTITION BY ICD_Version, ICD_Code_Type, ICD_Code ORDER BY CMS_Fiscal_Year) AS island
  FROM (SELECT DISTINCT CMS_Fiscal_Year, ICD_Version, ICD_Code_Type, ICD_Code FROM codes))
GROUP BY ICD_Version, ICD_Code_Type, ICD_Code, island"""
    q["code_spans"] = _with("codes") + f"""SELECT *, make_date(cast(From_FY - 1 as integer), 10, 1) AS Valid_From, make_date(cast(To_FY as integer), 9, 30) AS Valid_To FROM ({spans})"""
    q["invalid_reason"] = _with("ctx", "codes").rstrip() + f""",
sp AS ({spans}),
lim AS (SELECT ICD_Version, ICD_Code_Type, ICD_Code, min(From_FY) AS f, max(To_FY) AS t FROM sp GROUP BY ALL),
heads AS (SELECT DISTINCT fy AS CMS_Fiscal_Year, 'D' AS ICD_Code_Type, substring(trim(dx_code), 1, 7) AS ICD_Code FROM pr WHERE ver = 10 AND hipaa = '0'
  UNION SELECT fy, 'P', substring(trim(px_code), 1, 7) FROM pr WHERE ver = 10 AND hipaa = '0')
SELECT c.claim_id, c.CMS_Fiscal_Year, c.ICD_Version, c.ICD_Code_Type, c.ICD_Code,
  CASE WHEN h.ICD_Code IS NOT NULL THEN 'header_code' WHEN l.f IS NULL THEN 'never_valid'
    WHEN c.CMS_Fiscal_Year < l.f THEN 'not_yet' WHEN c.CMS_Fiscal_Year > l.t THEN 'no_longer' ELSE 'suspended' END AS Reason
FROM ctx c LEFT JOIN lim l USING (ICD_Version, ICD_Code_Type, ICD_Code)
LEFT JOIN heads h ON c.ICD_Version = 10 AND h.CMS_Fiscal_Year = c.CMS_Fiscal_Year AND h.ICD_Code_Type = c.ICD_Code_Type AND h.ICD_Code = c.ICD_Code
WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.ICD_Version = c.ICD_Version AND sp.ICD_Code_Type = c.ICD_Code_Type AND sp.ICD_Code = c.ICD_Code
  AND c.CMS_Fiscal_Year BETWEEN sp.From_FY AND sp.To_FY)"""
    q["length_profile"] = _with("dx", "px") + """SELECT ICD_Version, cast(max(length(Code_Desc_Short)) as integer) AS Max_Code_Desc_Short,
  cast(max(length(Code_Desc_Long)) as integer) AS Max_Code_Desc_Long, 'DIM_ICD_Diagnosis' AS Table_Name
FROM dx GROUP BY ICD_Version
UNION ALL
SELECT ICD_Version, cast(max(length(Code_Desc_Short)) as integer), cast(max(length(Code_Desc_Long)) as integer),
  'DIM_ICD_Procedure' FROM px GROUP BY ICD_Version"""
    q["claim_edits"] = _with("ctx", "mce") + f"""SELECT c.claim_id, c.CMS_Fiscal_Year, c.ICD_Code_Type, c.ICD_Code, c.Is_Principal, m.MCE_Edit_Type
FROM ctx c JOIN mce m ON c.CMS_Fiscal_Year = m.CMS_Fiscal_Year AND c.ICD_Version = m.ICD_Version
  AND c.ICD_Code_Type = m.ICD_Code_Type AND c.ICD_Code = m.ICD_Code
WHERE {RULE}"""
    q["invalid_code"] = _with("ctx", "codes") + """SELECT c.claim_id, c.CMS_Fiscal_Year, c.ICD_Version, c.ICD_Code_Type, c.ICD_Code
FROM ctx c WHERE NOT EXISTS (SELECT 1 FROM codes d WHERE d.CMS_Fiscal_Year = c.CMS_Fiscal_Year
  AND d.ICD_Version = c.ICD_Version AND d.ICD_Code_Type = c.ICD_Code_Type AND d.ICD_Code = c.ICD_Code)"""
    q["dup_pdx"] = _with("pcode") + """SELECT p.claim_id, p.Principal_Code, cast(count(*) as integer) AS n_occurrences
FROM pcode p JOIN ccodes c ON c.claim_id = p.claim_id AND c.ICD_Code_Type = 'D' AND c.ICD_Code = p.Principal_Code
GROUP BY p.claim_id, p.Principal_Code HAVING count(*) >= 2"""
    ext = " OR ".join(
        f"(h.ICD_Version = {v} AND p.Principal_Code LIKE '{pre}%')" for v, pres in C.EXTERNAL_PREFIXES.items() for pre in pres
    )
    q["external_pdx"] = _with("pcode", "hdr") + f"""SELECT p.claim_id, h.CMS_Fiscal_Year, h.ICD_Version, p.Principal_Code
FROM pcode p JOIN hdr h ON p.claim_id = h.claim_id WHERE {ext}"""
    return q


ORACLE_SQL: dict[str, str] = {k: T.duck_sql(v) for k, v in build().items()}
