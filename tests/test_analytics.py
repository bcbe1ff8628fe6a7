"""Range expansion and release deltas against brute force."""

import random

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from icdforge.operators import analytics, joins
from icdforge.operators.joins import expand_ranges, range_problems


def test_range_join_matches_brute_force(spark):
    rnd = random.Random(7)
    alpha = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    codes = sorted({rnd.choice("ABVWXZ") + "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 6))) for _ in range(400)})
    ranges = []
    for _ in range(40):
        a, b = sorted(rnd.sample(codes, 2))
        ranges.append((a, b))
    ranges += [("A00", "B99"), ("V1", "V2"), ("Z9", "A0")]  # cross-prefix, short bounds, empty
    cdf = spark.createDataFrame([(c,) for c in codes], "Diagnosis_Code STRING")
    rdf = spark.createDataFrame(ranges, "Range_Lo STRING, Range_Hi STRING")
    got = sorted(tuple(r) for r in expand_ranges(cdf, rdf, "Diagnosis_Code").select("Range_Lo", "Range_Hi", "Diagnosis_Code").collect())
    want = sorted((lo, hi, c) for lo, hi in ranges for c in codes if lo <= c <= hi)
    assert got == want
    odd = spark.createDataFrame([("a01",), ("A-1",), ("",), (None,), ("A0123456",)], "Diagnosis_Code STRING")
    mixed = spark.createDataFrame([("a00", "B99"), ("?", "B"), ("Z9", "A0"), (None, "B")], "Range_Lo STRING, Range_Hi STRING")
    got = [tuple(r) for r in expand_ranges(odd, mixed, "Diagnosis_Code").select("Range_Lo", "Range_Hi", "Diagnosis_Code").collect()]
    assert got == [("a00", "B99", "a01")]
    left_out = sorted((r.side, r.reason) for r in range_problems(odd, mixed, "Diagnosis_Code").collect())
    assert left_out == [("code", "not_a_code")] * 4 + [("range", "low_above_high")] + [("range", "not_a_code")] * 2


dims = st.dictionaries(
    st.tuples(st.sampled_from([2001, 2002, 2003]), st.sampled_from(["A01", "A02", "B10", "C20", "D30"])),
    st.sampled_from(["x", "y", "z"]),
    max_size=15,
)


@settings(max_examples=3, deadline=None)
@given(dims)
def test_delta_unapply_is_inverse(spark, rows):
    data = [(2001 + 0 * fy, 10, fy, code, desc) for (fy, code), desc in rows.items()]
    df = spark.createDataFrame(
        [(fy, 10, code, desc) for (_, _, fy, code, desc) in data] or [(2001, 10, "Q", "q")],
        "CMS_Fiscal_Year INT, ICD_Version INT, Diagnosis_Code STRING, Code_Desc_Long STRING",
    )
    man = spark.createDataFrame([(10, 2001), (10, 2002), (10, 2003)], "ICD_Version INT, CMS_Fiscal_Year INT")
    pairs = analytics.release_pairs(man)
    delta = analytics.release_delta(df, pairs, "Diagnosis_Code")
    rebuilt = sorted(tuple(r) for r in analytics.unapply_delta(df, delta, pairs, "Diagnosis_Code").collect())
    actual = sorted(tuple(r) for r in df.filter("CMS_Fiscal_Year < 2003").select("ICD_Version", "CMS_Fiscal_Year", "Diagnosis_Code", "Code_Desc_Long").collect())
    assert rebuilt == actual


def test_range_expansion_equals_brute_force(spark, monkeypatch):
    import random as _r

    from icdforge.operators import joins

    monkeypatch.setattr(joins, "BLOCK", 4)
    rnd = _r.Random(3)
    alpha = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = lambda: "".join(rnd.choice(alpha[:3] + alpha[10:13]) for _ in range(rnd.randint(1, 5)))
    codes = [word() for _ in range(150)] + ["A", "A", "a1", "", None, "A-1", "ABCDEFGH", "ZZZZZZZ", "0"]
    ranges = [(min(a, b), max(a, b)) for a, b in ((word(), word()) for _ in range(60))]
    ranges += [("0", "ZZZZZZZ"), ("A", "A"), ("A", "A"), ("B", "A"), ("a", "b"), (None, "A"), ("A", None), ("", "Z"), ("A.1", "B"), ("ZZZ", "ZZZZ")]
    c = spark.createDataFrame([(k, v) for k, v in enumerate(codes)], "id INT, code STRING")
    r = spark.createDataFrame([(k, *v) for k, v in enumerate(ranges)], "rid INT, Range_Lo STRING, Range_Hi STRING")
    got = sorted((x.id, x.rid) for x in joins.expand_ranges(c, r, "code").select("id", "rid").collect())
    fits = lambda v: bool(v) and len(v) <= 7 and all(ch in alpha for ch in v.upper())
    want = sorted((k, n) for k, v in enumerate(codes) for n, (lo, hi) in enumerate(ranges) if fits(v) and fits(lo) and fits(hi) and lo.upper() <= v.upper() <= hi.upper())
    assert got == want and len(want) > 500
    assert joins.expand_ranges(c.limit(0), r, "code").count() == 0 and joins.expand_ranges(c, r.limit(0), "code").count() == 0


def test_a_range_over_all_codes_is_dealt_over_blocks(spark):
    from icdforge.operators import joins

    c = spark.range(5_000).selectExpr("lpad(conv(cast(id as string), 10, 36), 5, 'A') AS code")
    r = spark.createDataFrame([("0", "ZZZZZZZ")], "Range_Lo STRING, Range_Hi STRING")
    jobs = spark.sparkContext.statusTracker()
    before = set(jobs.getJobIdsForGroup())
    spark.sparkContext.setJobGroup("build", "no job while the query is built")
    df = joins.expand_ranges(c, r, "code")
    assert not jobs.getJobIdsForGroup("build") and before is not None
    spark.sparkContext.setJobGroup("run", "run")
    assert df.count() == 5_000
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _edits(spark, rows):
    return spark.createDataFrame(
        rows,
        "CMS_Fiscal_Year INT, ICD_Version INT, ICD_Code_Type STRING, ICD_Code STRING, MCE_Section INT, "
        "MCE_Subsection STRING, MCE_Edit_Type STRING",
    )


def test_dependency_violation_and_pivot_zero_fill(spark):
    e = _edits(
        spark,
        [
            (2019, 10, "D", "A1", 4, "A", "Newborn_Only"),
            (2019, 10, "D", "A2", 4, "A", "Pediatric_Only"),  # same section, other type: violation
            (2020, 10, "D", "A1", 8, "A", "Principal_Questionable_Admit"),
            (2019, 10, "D", "A3", 8, "_", "Principal_Questionable_Admit"),
        ],
    )
    rep = {(r.key_kind, r.CMS_Fiscal_Year, r.key): r.n_distinct for r in analytics.section_type_dependency(e).collect()}
    assert rep[("section->type", 2019, "4|A")] == 2
    assert rep[("type->section", 2019, "Principal_Questionable_Admit|D")] == 1
    piv = {(r.MCE_Section, r.MCE_Subsection, r.MCE_Edit_Type): (r.FY_2019, r.FY_2020) for r in analytics.edit_pivot(e, [2019, 2020]).collect()}
    assert piv[(8, "_", "Principal_Questionable_Admit")] == (1, 0) and piv[(8, "A", "Principal_Questionable_Admit")] == (0, 1)
    with pytest.raises(Exception, match="fiscal year without a column: 2020"):
        analytics.edit_pivot(e, [2019]).collect()
    assert piv[(4, "A", "Newborn_Only")] == (1, 0)


def test_identity_and_discrepancy_classes(spark):
    poa = spark.createDataFrame(
        [
            (2012, 9, "A1", "A1", "x y"),
            (2013, 9, "A1", "A1", "x y"),
            (2014, 9, "A1", "A1", "x  y"),
        ],
        "CMS_Fiscal_Year INT, ICD_Version INT, Diagnosis_Code STRING, Diagnosis_Code_With_Period STRING, Code_Desc_Long STRING",
    )
    man = spark.createDataFrame([(9, 2012), (9, 2013), (9, 2014)], "ICD_Version INT, CMS_Fiscal_Year INT")
    ident = {
        (r.From_FY, r.To_FY): r.Is_Identical
        for r in analytics.release_identity(
            poa, analytics.release_pairs(man), ["Diagnosis_Code", "Diagnosis_Code_With_Period", "Code_Desc_Long"]
        ).collect()
    }
    assert ident == {(2012, 2013): "Y", (2013, 2014): "N"}
    dx = spark.createDataFrame(
        [(2014, 9, "A1", "x y"), (2013, 9, "A1", "X Y"), (2012, 9, "A1", "z")],
        "CMS_Fiscal_Year INT, ICD_Version INT, Diagnosis_Code STRING, Code_Desc_Long STRING",
    )
    got = {r.CMS_Fiscal_Year: (r.Difference, r.Edit_Distance) for r in analytics.description_discrepancies(poa, dx).collect()}
    assert got == {2014: ("spacing", 1), 2013: ("case", 2), 2012: ("wording", 3)}


def test_spelling_variants_are_a_class_of_their_own(spark):
    pairs = [
        ("Fracture of the tibia", "Fractur of the tibia", "spelling"), ("Tumour of oesophagus", "Tumor of esophagus", "spelling"), ("Anaemia  of pregnancy", "anemia of pregnancy", "spelling"),
        ("Fever stage 2", "Fever stage 3", "wording"), ("Pain in arm", "Pain in leg", "wording"), ("Fever", "Fever of unknown origin", "wording"),
        ("Disorder of eye", "Disorders of the eye", "wording"), ("left hand", "hand left", "wording"), ("x y", "x  y", "spacing"), ("x y", "X y", "case"),
        ("Complication unspecified", "Complications unspecifed", "spelling"), ("Burn of to", "Burn of of", "wording"),
    ]
    rows = [(2014, 9, f"A{k}", f"A{k}", a) for k, (a, _, _) in enumerate(pairs)]
    poa = spark.createDataFrame(rows, "CMS_Fiscal_Year INT, ICD_Version INT, Diagnosis_Code STRING, Diagnosis_Code_With_Period STRING, Code_Desc_Long STRING")
    dx = spark.createDataFrame([(2014, 9, f"A{k}", b) for k, (_, b, _) in enumerate(pairs)], "CMS_Fiscal_Year INT, ICD_Version INT, Diagnosis_Code STRING, Code_Desc_Long STRING")
    got = {r.Diagnosis_Code: r.Difference for r in analytics.description_discrepancies(poa, dx).collect()}
    assert got == {f"A{k}": kind for k, (_, _, kind) in enumerate(pairs)}
