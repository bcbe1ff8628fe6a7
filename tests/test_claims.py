"""Claim edits on the FIXTURES.md section 5 claims."""

import datetime as dt

from pyspark.sql import functions as F

from icdforge.operators import claims, releases

EDITS = [
    (2019, 10, "D", "P000", 4, "A", "Newborn_Only"),
    (2019, 10, "D", "A000", 6, "_", "Principal_Manifestation"),
    (2019, 10, "P", "0UT9", 5, "B", "Female_Only"),
]
CLAIMS = [
    (1, dt.date(2018, 10, 1), 40, "F", 48, ["P000"], []),
    (2, dt.date(2019, 9, 30), 0, "M", 48, ["A000", "P000"], ["0UT9"]),
    (3, dt.date(2019, 1, 15), 0, "F", 48, ["P000", "A000"], ["0UT9"]),
    (4, dt.date(2018, 9, 30), 40, "F", 48, ["P000"], []),
]


def _frames(spark):
    edits = spark.createDataFrame(
        EDITS,
        "CMS_Fiscal_Year INT, ICD_Version INT, ICD_Code_Type STRING, ICD_Code STRING, MCE_Section INT, "
        "MCE_Subsection STRING, MCE_Edit_Type STRING",
    )
    cl = spark.createDataFrame(
        CLAIMS,
        "claim_id BIGINT, service_date DATE, age INT, sex STRING, los_hours INT, dx ARRAY<STRING>, px ARRAY<STRING>",
    )
    codes = claims.claim_codes_from_arrays(cl)
    rel = claims.claims_with_release(cl.drop("dx", "px"), releases.manifest(spark, releases.DIAGNOSIS_RELEASES))
    return edits, codes, rel


def test_expected_flags(spark):
    edits, codes, rel = _frames(spark)
    ctx = claims.claim_code_context(codes, rel)
    got = sorted((r.claim_id, r.MCE_Edit_Type) for r in claims.apply_edits(ctx, edits).collect())
    assert got == [(1, "Newborn_Only"), (2, "Female_Only"), (2, "Principal_Manifestation")]


def test_principal_and_duplicates(spark):
    _, codes, rel = _frames(spark)
    p = {r.claim_id: r.Principal_Code for r in claims.principal_diagnoses(codes).collect()}
    assert p == {1: "P000", 2: "A000", 3: "P000", 4: "P000"}
    dup_codes = codes.unionByName(codes.filter("claim_id = 3 AND seq = 0").withColumn("seq", F.lit(5)))
    d = claims.duplicate_principal(dup_codes).collect()
    assert [(r.claim_id, r.Principal_Code, r.n_occurrences) for r in d] == [(3, "P000", 2)]
    ext = claims.external_cause_principal(codes, rel, {10: ["A"]}).collect()
    assert [r.claim_id for r in ext] == [2]


def test_invalid_codes(spark):
    edits, codes, rel = _frames(spark)
    dims = edits.select("CMS_Fiscal_Year", "ICD_Version", "ICD_Code_Type", "ICD_Code")
    inv = claims.invalid_codes(claims.claim_code_context(codes, rel), dims).collect()
    # claims 1-3 are FY 2019 (all codes known); claim 4 is FY 2018 (none known)
    assert sorted({r.claim_id for r in inv}) == [4]


def test_release_of_date_any_interval(spark):
    man = spark.createDataFrame(
        [
            (10, 2016, dt.date(2015, 10, 1), dt.date(2016, 3, 31)),
            (10, 2016, dt.date(2016, 4, 1), dt.date(2018, 9, 30)),
        ],
        "ICD_Version INT, CMS_Fiscal_Year INT, Effective_Date DATE, End_Date DATE",
    )
    d = spark.createDataFrame(
        [(1, dt.date(2016, 1, 1)), (2, dt.date(2016, 4, 1)), (3, dt.date(2017, 12, 1)), (4, dt.date(2019, 1, 1))],
        "id INT, d DATE",
    )
    got = {r.id: (str(r.Effective_Date) if r.Effective_Date else None) for r in releases.release_of_date(d, "d", man).collect()}
    assert got == {1: "2015-10-01", 2: "2016-04-01", 3: "2016-04-01", 4: None}


def test_unchecked_marker(spark):
    edits, _, _ = _frames(spark)
    cl = spark.createDataFrame(
        [(9, dt.date(2019, 1, 1), None, None, None, ["P000"], ["0UT9"])],
        "claim_id BIGINT, service_date DATE, age INT, sex STRING, los_hours INT, dx ARRAY<STRING>, px ARRAY<STRING>",
    )
    rel = claims.claims_with_release(cl.drop("dx", "px"), releases.manifest(spark, releases.DIAGNOSIS_RELEASES))
    ctx = claims.claim_code_context(claims.claim_codes_from_arrays(cl), rel)
    assert claims.apply_edits(ctx, edits).count() == 0
    got = sorted((r.MCE_Edit_Type, r.Edit_Status) for r in claims.apply_edits(ctx, edits, include_unchecked=True).collect())
    assert got == [("Female_Only", "unchecked"), ("Newborn_Only", "unchecked")]


def test_hot_code_and_large_tables(spark, monkeypatch):
    """One diagnosis on half of all lines, by broadcast and by the salted join."""
    from icdforge.operators import joins

    n = 4000
    rows = [(i // 4, i % 4, "D", "HOT" if i % 2 else f"C{i % 50}", 2019, 10, 30, "M", 24) for i in range(n)]
    codes = spark.createDataFrame(rows, "claim_id long, seq int, ICD_Code_Type string, ICD_Code string, CMS_Fiscal_Year int, ICD_Version int, age int, sex string, los_hours int")
    edits = spark.createDataFrame([(2019, 10, "D", "HOT", "Female_Only"), (2019, 10, "D", "C2", "Principal_Unacceptable")], "CMS_Fiscal_Year int, ICD_Version int, ICD_Code_Type string, ICD_Code string, MCE_Edit_Type string")
    out = []
    for limit in (joins.BROADCAST_ROWS, 0):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
        fired = claims.apply_edits(codes, edits)
        invalid = claims.invalid_codes(codes, edits)
        out.append((sorted((r.claim_id, r.ICD_Code, r.MCE_Edit_Type) for r in fired.collect()), invalid.count()))
        assert ("_salt" in fired._jdf.queryExecution().toString()) is (limit == 0)
    want = sorted((c, code, "Female_Only") for c, s, _, code, *_ in rows if code == "HOT") + [(c, code, "Principal_Unacceptable") for c, s, _, code, *_ in rows if code == "C2" and s == 0]
    assert out[0] == out[1] == (sorted(want), sum(r[3] not in ("HOT", "C2") for r in rows))


def test_many_lines_are_grouped_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from icdforge.plans import catalog

    lines = spark.range(800).select(
        F.expr("id div 2").alias("l_orderkey"), F.expr("if(id % 8 = 1, id - 1, id) * 97 % 5000").alias("l_partkey"), F.expr("cast(id % 2 as int)").alias("l_linenumber")
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(400).select(F.col("id").alias("o_orderkey"), F.lit(dt.datetime(2000, 1, 5)).alias("o_orderdate"), F.col("id").alias("o_custkey"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")

    def found():
        return sorted(map(tuple, catalog.q_dup_pdx(spark, str(tmp_path)).collect()))

    expected = found()
    assert len(expected) == 100 and {n for _, _, n in expected} == {2}
    monkeypatch.setattr(claims, "LINES_PER_TASK", 20)
    assert found() == expected
    tasks = catalog.claim_codes(spark, str(tmp_path), grouped=True).groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("claim_id").alias("n")).collect()
    assert len(tasks) > 30 and max(r.n for r in tasks) < 40  # 400 claims; 8 tasks at most before
