"""Query catalogue: every operator of the survey as (Spark query, oracle SQL).

Spark queries run the library (parsers, cleaners, checks, analytics, claim
edits) on release data derived from the driver's tables
(:mod:`icdforge.plans.tpch_codes`).  Oracle SQL computes the expected result
directly from the same derived columns in DuckDB, without parsing lines.
Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fiscal_year, icd9_add_period
from ..operators import analytics, claims, history, quality, releases, tables
from ..operators.clean import rename_columns
from ..operators.joins import expand_ranges
from ..sources import layouts
from ..sources.lines import FILE_NAME
from ..sources.parse import REASON, materialize, parse, split_rejects
from . import tpch_codes as T
from .pipeline import icd10_headers, standardize
from .sinks import replace_version_slice

Query = Callable[[SparkSession, str], DataFrame]

DX_COLS = tables.DIAGNOSIS.names
PX_COLS = tables.PROCEDURE.names
POA_COLS = tables.POA_EXEMPT.names
MCE_COLS = tables.MCE_EDITS.names

RENAMES = {
    "CMS_Fiscal_Year": "FY",
    "Effective_Date": "Eff_Date",
    "End_Date": "Exp_Date",
    "ICD_Version": "Version",
    "Diagnosis_Code": "ICD_Code",
    "Code_Desc_Short": "Short_Desc",
    "Code_Desc_Long": "Long_Desc",
}
EXTERNAL_PREFIXES = {9: ("E",), 10: ("V", "W", "X", "Y")}


# =============================================================== Spark side ==
def _load(spark, sf, kind, version, table="dx", lines=None):
    if lines is None:
        lines = T.release_lines(spark, sf, kind, version, table)
    man = T.adapter_manifest(spark, "mce" if kind == "mce" else (table if kind == "desc" else kind))
    rows = standardize(lines, man, kind, version)
    good, _ = split_rejects(rows)
    return good


def dx_rows(spark, sf, version):
    return _load(spark, sf, "desc", version, "dx").select(*DX_COLS)


def dx_union(spark, sf):
    return dx_rows(spark, sf, 9).unionByName(dx_rows(spark, sf, 10))


def px_union(spark, sf):
    def one(v):
        return _load(spark, sf, "desc", v, "proc").withColumnRenamed("Diagnosis_Code", "Procedure_Code").select(*PX_COLS)

    return one(9).unionByName(one(10))


def poa_rows(spark, sf, version):
    return _load(spark, sf, "poa", version).select(*POA_COLS)


def poa_union(spark, sf):
    return poa_rows(spark, sf, 9).unionByName(poa_rows(spark, sf, 10))


def mce_rows(spark, sf):
    return _load(spark, sf, "mce", None).select(*MCE_COLS)


def code_tables(spark, sf):
    return analytics.code_dimension(dx_union(spark, sf), px_union(spark, sf))


def q_scan_fixed_width(spark, sf):
    good, _ = split_rejects(parse(T.release_lines(spark, sf, "desc", 10), layouts.DESC_ICD10))
    return good


def q_scan_quoted_bar(spark, sf):
    good, _ = split_rejects(parse(T.release_lines(spark, sf, "desc", 9), layouts.DESC_ICD9))
    return good


def q_scan_tab2(spark, sf):
    good, _ = split_rejects(parse(T.release_lines(spark, sf, "poa", 9), layouts.POA_ICD9))
    return good


def q_scan_tab3_skip(spark, sf):
    good, _ = split_rejects(parse(T.release_lines(spark, sf, "poa", 10), layouts.POA_ICD10))
    return good


def q_scan_tab8_reorder(spark, sf):
    good, _ = split_rejects(parse(T.release_lines(spark, sf, "mce", None), layouts.MCE_EDITS))
    return good


# faulty lines: each fault yields exactly one reject reason
FAULTS_DESC9 = (
    "case p_partkey % 17"
    " when 1 then '\"' || dx_code || '\"|\"' || replace(long, '\"', '\"\"') || '\"'"
    " when 2 then '\"' || rpad(dx_code, 8, 'X') || '\"|\"' || replace(long, '\"', '\"\"') || '\"|\"' || replace(short, '\"', '\"\"') || '\"'"
    " when 3 then '\"' || dx_code || '\"|\"' || replace(long, '\"', '\"\"') || '\"|\"' || replace(short, '\"', '\"\"')"
    " else {line} end"
)
FAULTS_DESC10 = "case when p_partkey % 17 = 4 then substring({line}, 1, 70) else {line} end"
FAULTS_MCE = (
    "case when p_partkey % 17 = 5 then mce_version || chr(9) || cast(ver as string) || chr(9) || 'X1' || chr(9)"
    " || mce_sub || chr(9) || mce_type || chr(9) || mce_code_type || chr(9) || mce_code || chr(9) || mce_desc"
    " else {line} end"
)


def _faulty_lines(spark, sf, kind, version, template):
    if kind == "mce":
        pr = T.part_releases(spark, sf, mce=True)
        name = T.FILE_NAMES[("mce", None)]
    else:
        pr = T.part_releases(spark, sf).filter(F.col("ver") == version)
        name = T.FILE_NAMES[("dx", version)]
    expr = template.format(line="(" + T.line_expr(kind, version) + ")")
    return pr.select(F.expr(expr).alias("value"), F.expr(name).alias(FILE_NAME))


def q_reject_rows(spark, sf):
    out = None
    for layout, kind, version, template in (
        (layouts.DESC_ICD9, "desc", 9, FAULTS_DESC9),
        (layouts.DESC_ICD10, "desc", 10, FAULTS_DESC10),
        (layouts.MCE_EDITS, "mce", None, FAULTS_MCE),
    ):
        _, bad = split_rejects(parse(_faulty_lines(spark, sf, kind, version, template), layout))
        bad = bad.select(F.lit(layout.name).alias("Layout"), FILE_NAME, F.col("_raw").alias("raw"), F.col(REASON).alias("reason"))
        out = bad if out is None else out.unionByName(bad)
    return out


def _orders_manifest(spark, sf):
    o = T.read_table(spark, sf, "orders").select(fiscal_year("o_orderdate").alias("CMS_Fiscal_Year")).distinct()
    m = releases.with_validity(o).withColumn("fy", F.col("CMS_Fiscal_Year"))
    m = m.withColumn("ICD_Version", F.expr(f"cast(case when fy >= {T.ICD10_FROM} then 10 else 9 end as int)"))
    name = F.when(F.col("ICD_Version") == 10, F.expr(T.FILE_NAMES[("dx", 10)])).otherwise(F.expr(T.FILE_NAMES[("dx", 9)]))
    out = [
        F.col("ICD_Version"),
        F.col("CMS_Fiscal_Year"),
        F.col("Effective_Date"),
        F.col("End_Date"),
        name.alias(FILE_NAME),
        F.expr(T.FILE_NAMES[("mce", None)]).alias("MCE_File_Name"),
    ]
    # evaluation boundary: filters on the manifest (version choices) stay
    # above it, so every use shares one scan of orders
    return materialize(m, out)


def q_release_manifest(spark, sf):
    return releases.ordered(_orders_manifest(spark, sf))


def q_release_filter(spark, sf):
    m = _orders_manifest(spark, sf)
    out = None
    for which in ("ALL", "9", "09", "10"):
        part = releases.select_versions(m, which).select(
            F.lit(which).alias("Which_ICD_Version_To_Load"), "ICD_Version", "CMS_Fiscal_Year", FILE_NAME
        )
        out = part if out is None else out.unionByName(part)
    return out


UNLISTED = "p_partkey % 19 = 0"  # lines of a file that no release names


def q_attach_release(spark, sf):
    pr = T.part_releases(spark, sf).filter((F.col("ver") == 9) & F.col("exempt") & (F.col("fy") != T.POA_SHARED[1]))
    name = F.expr(f"case when {UNLISTED} then 'unlisted.txt' else {T.FILE_NAMES[('poa', 9)]} end")
    lines = pr.select(F.expr(T.line_expr("poa", 9)).alias("value"), name.alias(FILE_NAME))
    att = releases.attach_release(parse(lines, layouts.POA_ICD9), T.adapter_manifest(spark, "poa"))
    return att.select(
        FILE_NAME,
        F.col("Release_ICD_Version").alias("ICD_Version"),
        "CMS_Fiscal_Year",
        "Effective_Date",
        "End_Date",
        "Diagnosis_Code",
        F.col(REASON).alias("reason"),
    )


FAULT_VERSION_MCE = (
    "case when p_partkey % 23 = 7 then mce_version || chr(9) || (case when ver = 10 then '9' else '10' end)"
    " || chr(9) || cast(mce_section as string) || chr(9) || mce_sub || chr(9) || mce_type || chr(9)"
    " || mce_code_type || chr(9) || mce_code || chr(9) || mce_desc else {line} end"
)


def q_version_mismatch(spark, sf):
    lines = _faulty_lines(spark, sf, "mce", None, FAULT_VERSION_MCE)
    rows = standardize(lines, T.adapter_manifest(spark, "mce"), "mce", None)
    good, _ = split_rejects(rows)
    return quality.version_mismatches(good).select(
        FILE_NAME, "CMS_Fiscal_Year", "Release_ICD_Version", "ICD_Version", "ICD_Code"
    )


def _orders_dates(spark, sf):
    return T.read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("service_date"))


def q_asof_release(spark, sf):
    return releases.release_of_date(_orders_dates(spark, sf), "service_date", T.adapter_manifest(spark, "dx")).select(
        "o_orderkey", "service_date", "CMS_Fiscal_Year", "ICD_Version", "Effective_Date", "End_Date"
    )


def q_fiscal_year(spark, sf):
    return _orders_dates(spark, sf).withColumn("CMS_Fiscal_Year", fiscal_year("service_date"))


def q_dx_load_icd9(spark, sf):
    return dx_rows(spark, sf, 9)


def q_dx_load_icd10(spark, sf):
    return dx_rows(spark, sf, 10)


def q_dx_load_union(spark, sf):
    return dx_union(spark, sf)


def q_proc_load(spark, sf):
    return px_union(spark, sf)


def q_poa_load_icd9(spark, sf):
    return poa_rows(spark, sf, 9)


def q_poa_load_icd10(spark, sf):
    return poa_rows(spark, sf, 10)


def q_poa_load_union(spark, sf):
    return poa_union(spark, sf)


def q_mce_load(spark, sf):
    return mce_rows(spark, sf)


def q_rename_columns(spark, sf):
    return rename_columns(dx_union(spark, sf), RENAMES)


def q_code_period(spark, sf):
    dx = dx_union(spark, sf)
    wp = F.when(F.col("ICD_Version") == 9, icd9_add_period("Diagnosis_Code"))
    return dx.select("ICD_Version", "CMS_Fiscal_Year", "Diagnosis_Code", wp.alias("Diagnosis_Code_With_Period"))


def _dup_lines(spark, sf, version):
    """Release lines plus a second line for the same code where p % 29 = 0,
    and one for the code in lower case where p % 29 = 1."""
    pr = T.part_releases(spark, sf).filter(F.col("ver") == version)
    name = F.expr(T.FILE_NAMES[("dx", version)]).alias(FILE_NAME)
    base = pr.select(F.expr(T.line_expr("desc", version)).alias("value"), name)
    dup = pr.filter(F.expr("p_partkey % 29 <= 1")).withColumn("short", F.expr("'dup ' || short"))
    dup = dup.withColumn("dx_code", F.expr("case when p_partkey % 29 = 1 then lower(dx_code) else dx_code end"))
    dup = dup.select(F.expr(T.line_expr("desc", version)).alias("value"), name)
    return base.unionByName(dup)


def q_pk_violations(spark, sf):
    rows = None
    for v in (9, 10):
        r = _load(spark, sf, "desc", v, "dx", lines=_dup_lines(spark, sf, v)).select(*DX_COLS)
        rows = r if rows is None else rows.unionByName(r)
    return quality.key_violations(rows, tables.DIAGNOSIS.keys)


FAULTS_POA9 = (
    "case p_partkey % 31"
    " when 0 then 'X' || substring(code9, 2) || chr(9) || ' ' || poa_long || ' '"
    " when 1 then code9 || chr(9)"
    " else {line} end"
)


def q_not_null_violations(spark, sf):
    pr = T.part_releases(spark, sf).filter((F.col("ver") == 9) & F.col("exempt") & (F.col("fy") != T.POA_SHARED[1]))
    lines = pr.select(
        F.expr(FAULTS_POA9.format(line="(" + T.line_expr("poa", 9) + ")")).alias("value"),
        F.expr(T.FILE_NAMES[("poa", 9)]).alias(FILE_NAME),
    )
    rows = _load(spark, sf, "poa", 9, lines=lines).select(*POA_COLS)
    spec = tables.POA_EXEMPT
    return quality.null_violations(rows, spec.not_null(), ["CMS_Fiscal_Year", "ICD_Version", "Diagnosis_Code"])


FAULT_LEN_MCE = (
    "case when p_partkey % 37 = 0 then mce_version || chr(9) || cast(ver as string) || chr(9)"
    " || cast(mce_section as string) || chr(9) || 'AA' || chr(9) || mce_type || chr(9) || mce_code_type"
    " || chr(9) || mce_code || chr(9) || mce_desc else {line} end"
)


def q_length_violations(spark, sf):
    lines = _faulty_lines(spark, sf, "mce", None, FAULT_LEN_MCE)
    rows = _load(spark, sf, "mce", None, lines=lines).select(*MCE_COLS)
    spec = tables.MCE_EDITS
    return quality.length_violations(rows, spec.limits(), list(spec.keys))


def q_slice_replace(spark, sf):
    existing = dx_union(spark, sf)
    pr = T.part_releases(spark, sf).filter(F.col("ver") == 10)
    pr = pr.withColumn("long", F.expr("case when p_partkey % 3 = 0 then long || ' (corrected)' else long end"))
    lines = pr.select(F.expr(T.line_expr("desc", 10)).alias("value"), F.expr(T.FILE_NAMES[("dx", 10)]).alias(FILE_NAME))
    new = _load(spark, sf, "desc", 10, "dx", lines=lines).select(*DX_COLS)
    return replace_version_slice(existing, new, 10)


def q_edit_join(spark, sf):
    return analytics.edit_join(code_tables(spark, sf), mce_rows(spark, sf))


def q_wide_dim(spark, sf):
    return analytics.wide_dimension(code_tables(spark, sf), mce_rows(spark, sf))


def q_poa_flag(spark, sf):
    return analytics.poa_flag(dx_union(spark, sf), poa_union(spark, sf)).select(
        "CMS_Fiscal_Year", "ICD_Version", "Diagnosis_Code", "Is_POA_Exempt"
    )


def q_edit_pivot(spark, sf):
    return analytics.edit_pivot(mce_rows(spark, sf), T.FISCAL_YEARS)


def q_fd_check(spark, sf):
    return analytics.section_type_dependency(mce_rows(spark, sf))


def q_edit_orphans(spark, sf):
    return analytics.edit_orphans(mce_rows(spark, sf), code_tables(spark, sf)).select(
        "CMS_Fiscal_Year", "ICD_Version", "ICD_Code_Type", "ICD_Code", "MCE_Section", "MCE_Subsection", "MCE_Edit_Type"
    )


def q_desc_discrepancy(spark, sf):
    return analytics.description_discrepancies(poa_union(spark, sf), dx_union(spark, sf))


def q_desc_changes(spark, sf):
    return analytics.description_changes(dx_union(spark, sf), "Diagnosis_Code")


# every part is the low end of a range of codes that share its first six characters
RANGE_LO = T.dx10("p_partkey", T.letters("p_partkey"))
RANGE_HI = f"substring({RANGE_LO}, 1, 6) || 'Z'"


def q_range_expand(spark, sf):
    ranges = T.read_table(spark, sf, "part").select(
        F.expr(T.spark_sql(RANGE_LO)).alias("Range_Lo"), F.expr(T.spark_sql(RANGE_HI)).alias("Range_Hi")
    )
    codes = dx_rows(spark, sf, 10).select("CMS_Fiscal_Year", "Diagnosis_Code")
    return expand_ranges(codes, ranges, "Diagnosis_Code").select("Range_Lo", "Range_Hi", "CMS_Fiscal_Year", "Diagnosis_Code")


def _pairs(spark, kind="dx"):
    return analytics.release_pairs(T.adapter_manifest(spark, kind))


def q_release_delta(spark, sf):
    return analytics.release_delta(dx_union(spark, sf), _pairs(spark), "Diagnosis_Code").select(
        "ICD_Version", "From_FY", "To_FY", "Diagnosis_Code", "Change", "Old_Desc", "New_Desc"
    )


def q_delta_unapply(spark, sf):
    dx = dx_union(spark, sf)
    delta = analytics.release_delta(dx, _pairs(spark), "Diagnosis_Code")
    return analytics.unapply_delta(dx, delta, _pairs(spark), "Diagnosis_Code")


def q_release_identity(spark, sf):
    return analytics.release_identity(
        poa_union(spark, sf), _pairs(spark, "poa"), ["Diagnosis_Code", "Diagnosis_Code_With_Period", "Code_Desc_Long"]
    ).select("ICD_Version", "From_FY", "To_FY", "n_only_old", "n_only_new", "Is_Identical")


def q_delta_chain(spark, sf):
    """Every earlier release from the newest one and the chain of deltas."""
    dx, pairs = dx_union(spark, sf), _pairs(spark)
    newest = pairs.groupBy("ICD_Version").agg(F.max("To_FY").alias("CMS_Fiscal_Year"))
    delta = analytics.release_delta(dx, pairs, "Diagnosis_Code")
    return history.rebuild_releases(dx.join(F.broadcast(newest), ["ICD_Version", "CMS_Fiscal_Year"]), delta, pairs, "Diagnosis_Code")


def q_delta_compose(spark, sf):
    """The deltas of consecutive releases as one delta from first to last."""
    return history.compose_deltas(analytics.release_delta(dx_union(spark, sf), _pairs(spark), "Diagnosis_Code"), "Diagnosis_Code")


def q_identity_by_fingerprint(spark, sf):
    poa, cols = poa_union(spark, sf), ["Diagnosis_Code", "Diagnosis_Code_With_Period", "Code_Desc_Long"]
    return history.identical_releases(history.release_fingerprints(poa, cols), _pairs(spark, "poa"), poa, cols)


def q_code_spans(spark, sf):
    return history.code_spans(code_tables(spark, sf), T.adapter_manifest(spark, "dx"), ["ICD_Code_Type", "ICD_Code"])


def header_codes(spark, sf):
    """Headings of the ICD-10 diagnosis and procedure files."""
    out = None
    for kind, letter in (("dx", "D"), ("proc", "P")):
        h = icd10_headers(T.release_lines(spark, sf, "desc", 10, kind), T.adapter_manifest(spark, kind), "ICD_Code")
        h = h.select("ICD_Version", "CMS_Fiscal_Year", F.lit(letter).alias("ICD_Code_Type"), "ICD_Code")
        out = h if out is None else out.unionByName(h)
    return out


def q_invalid_reason(spark, sf):
    keys = ["ICD_Code_Type", "ICD_Code"]
    spans = history.code_spans(code_tables(spark, sf), T.adapter_manifest(spark, "dx"), keys)
    found = history.invalid_reasons(claim_codes(spark, sf), spans, keys, header_codes(spark, sf), ["claim_id"], 2 * T.release_rows(spark, sf))
    return found.select("claim_id", "CMS_Fiscal_Year", "ICD_Version", *keys, "Reason")


def q_length_profile(spark, sf):
    dx = quality.length_profile(dx_union(spark, sf), ["ICD_Version"], ["Code_Desc_Short", "Code_Desc_Long"])
    px = quality.length_profile(px_union(spark, sf), ["ICD_Version"], ["Code_Desc_Short", "Code_Desc_Long"])
    return dx.withColumn("Table_Name", F.lit(tables.DIAGNOSIS.default_name)).unionByName(
        px.withColumn("Table_Name", F.lit(tables.PROCEDURE.default_name))
    )


# ---------------------------------------------------------------- claims ----
# claim codes of a part, only the branch of the claim's version is evaluated
CLAIM_DX = f"case when ver = 10 then {T.dx10('p_partkey', 'q26')} else {T.dx9('p_partkey', 'r10', 'q10')} end"
CLAIM_PX = f"case when ver = 10 then {T.px10('p_partkey', 'q26')} else {T.px9('p_partkey')} end"
CLAIM_PARTS = {"r10": "p_partkey % 10", "q10": T.tens("p_partkey"), "q26": T.letters("p_partkey")}
# claim line order (line number, part key) as one orderable number
SEQ_SCALE = 10**12
CLAIM_FY_OF_SERVICE = (
    "cast(year(service_date) + case when month(service_date) >= 10 then 1 else 0 end as integer)"
)


def claim_headers(spark, sf):
    o = T.read_table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("claim_id"),
        F.col("o_orderdate").cast("date").alias("service_date"),
        F.expr("cast(o_custkey % 100 as int)").alias("age"),
        F.expr("case when o_custkey % 2 = 0 then 'F' else 'M' end").alias("sex"),
        F.expr("cast(o_orderkey % 10 as int) * 24").alias("los_hours"),
    )


def claim_rel(spark, sf):
    """Claim headers with the release of their service date (broadcast manifest)."""
    return claims.claims_with_release(claim_headers(spark, sf), T.adapter_manifest(spark, "dx"))


def claim_codes(spark, sf, grouped=False):
    """Long claim codes carrying their claim's header: each line item gives its
    part's diagnosis and procedure code in the claim's ICD version.  Lines meet
    their header in one join; ``grouped``: in tasks of so many lines that each
    can hold all its codes in hash tables (:func:`claims.claim_tasks`)."""
    li = T.read_table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_linenumber")
    rel = claim_rel(spark, sf)
    tasks = claims.claim_tasks(li) if grouped else None
    if tasks:
        li, rel = li.repartition(tasks, "l_orderkey"), rel.repartition(tasks, "claim_id")
    header = ["service_date", "age", "sex", "los_hours", "CMS_Fiscal_Year", "ICD_Version"]
    j = li.join(rel, li.l_orderkey == rel.claim_id).select(
        "claim_id", "p_partkey", (F.col("l_linenumber").cast("bigint") * SEQ_SCALE + F.col("p_partkey")).alias("seq"), *header,
        F.expr(f"case when {CLAIM_FY_OF_SERVICE} >= {T.ICD10_FROM} then 10 else 9 end").alias("ver"),
        *(F.expr(e).alias(n) for n, e in CLAIM_PARTS.items()),
    )
    # both code types of a line from one pass over the joined lines
    both = [F.struct(F.lit(t).alias("t"), F.expr(T.spark_sql(e)).alias("c")) for t, e in (("D", CLAIM_DX), ("P", CLAIM_PX))]
    return j.select("claim_id", "seq", *header, F.explode(F.array(*both)).alias("_c")).select(
        "claim_id", "seq", F.col("_c.t").alias("ICD_Code_Type"), F.col("_c.c").alias("ICD_Code"), *header
    )


def claim_principal(spark, sf):
    """Principal line of each claim straight from ``lineitem``: every line
    carries a diagnosis, so the lowest (line number, part) is the principal
    (a hash aggregate on one number, no join)."""
    li = T.read_table(spark, sf, "lineitem")
    seq = F.col("l_linenumber").cast("bigint") * SEQ_SCALE + F.col("l_partkey")
    return li.groupBy(F.col("l_orderkey").alias("claim_id")).agg(F.min(seq).alias("Principal_Seq"))


def q_claim_edits(spark, sf):
    return claims.apply_edits(claim_codes(spark, sf), mce_rows(spark, sf), principal=claim_principal(spark, sf), edit_rows=T.release_rows(spark, sf, mce=True)).select(
        "claim_id", "CMS_Fiscal_Year", "ICD_Code_Type", "ICD_Code", "Is_Principal", "MCE_Edit_Type"
    )


def q_invalid_code(spark, sf):
    return claims.invalid_codes(claim_codes(spark, sf), code_tables(spark, sf), 2 * T.release_rows(spark, sf)).select(
        "claim_id", "CMS_Fiscal_Year", "ICD_Version", "ICD_Code_Type", "ICD_Code"
    )


def q_dup_pdx(spark, sf):
    return claims.duplicate_principal(claim_codes(spark, sf, grouped=True), claim_principal(spark, sf))


def q_external_pdx(spark, sf):
    # the claim codes carry their release columns: no join back to the claims
    return claims.external_cause_principal(claim_codes(spark, sf), None, EXTERNAL_PREFIXES, claim_principal(spark, sf))


QUERIES: dict[str, Query] = {
    "scan_fixed_width": q_scan_fixed_width,
    "scan_quoted_bar": q_scan_quoted_bar,
    "scan_tab2": q_scan_tab2,
    "scan_tab3_skip": q_scan_tab3_skip,
    "scan_tab8_reorder": q_scan_tab8_reorder,
    "reject_rows": q_reject_rows,
    "release_manifest": q_release_manifest,
    "release_filter": q_release_filter,
    "attach_release": q_attach_release,
    "version_mismatch": q_version_mismatch,
    "asof_release": q_asof_release,
    "fiscal_year": q_fiscal_year,
    "dx_load_icd9": q_dx_load_icd9,
    "dx_load_icd10": q_dx_load_icd10,
    "dx_load_union": q_dx_load_union,
    "proc_load": q_proc_load,
    "poa_load_icd9": q_poa_load_icd9,
    "poa_load_icd10": q_poa_load_icd10,
    "poa_load_union": q_poa_load_union,
    "mce_load": q_mce_load,
    "rename_columns": q_rename_columns,
    "code_period": q_code_period,
    "pk_violations": q_pk_violations,
    "not_null_violations": q_not_null_violations,
    "length_violations": q_length_violations,
    "slice_replace": q_slice_replace,
    "edit_join": q_edit_join,
    "wide_dim": q_wide_dim,
    "poa_flag": q_poa_flag,
    "edit_pivot": q_edit_pivot,
    "fd_check": q_fd_check,
    "edit_orphans": q_edit_orphans,
    "desc_discrepancy": q_desc_discrepancy,
    "desc_changes": q_desc_changes,
    "range_expand": q_range_expand,
    "release_delta": q_release_delta,
    "delta_unapply": q_delta_unapply,
    "release_identity": q_release_identity,
    "length_profile": q_length_profile,
    "delta_chain": q_delta_chain,
    "delta_compose": q_delta_compose,
    "identity_by_fingerprint": q_identity_by_fingerprint,
    "code_spans": q_code_spans,
    "invalid_reason": q_invalid_reason,
    "claim_edits": q_claim_edits,
    "invalid_code": q_invalid_code,
    "dup_pdx": q_dup_pdx,
    "external_pdx": q_external_pdx,
}
