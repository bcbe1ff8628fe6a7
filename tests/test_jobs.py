"""Loads of fixture release files (FIXTURES.md section 3) and table actions."""

import pytest

from icdforge.plans import jobs
from icdforge.plans.jobs import LoadCheckError
from tests import fixture_files as FX


def rows(spark, table, cols):
    return sorted(tuple(r) for r in spark.table(table).select(*cols).collect())


def test_diagnosis_load_both_layouts(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    res = jobs.load_diagnosis(spark, str(tmp_path), table="dx_t1", releases_=FX.DX_RELEASES)
    assert res.rows == 5 and res.rejects == 0
    got = rows(spark, "dx_t1", ["CMS_Fiscal_Year", "ICD_Version", "Diagnosis_Code", "Code_Desc_Short", "Code_Desc_Long"])
    assert got == [
        (2012, 9, "0413", "Fever Mén", "Fever of Ménière"),
        (2012, 9, "66070", "Say aah", 'Say "aah" | wide'),
        (2012, 9, "V1919", "Short V", "Long V"),
        (2018, 10, "O0910", "Short one", "Long one"),
        (2018, 10, "T82857D", 'Short ""two""', 'Long ""two""'),
    ]
    dates = spark.table("dx_t1").filter("CMS_Fiscal_Year = 2018").select("Effective_Date", "End_Date").first()
    assert str(dates[0]) == "2017-10-01" and str(dates[1]) == "2018-09-30"
    # VARCHAR limits come from DDL
    types = dict(spark.table("dx_t1").dtypes)
    assert types["Diagnosis_Code"] in ("string", "varchar(7)")


def test_accent_check_after_load(spark, tmp_path):
    from icdforge.operators import quality

    FX.write_dx(str(tmp_path))
    jobs.load_diagnosis(spark, str(tmp_path), table="dx_acc", releases_=FX.DX_RELEASES)
    got = [(r.Diagnosis_Code, r.Has_Accents) for r in quality.accent_check(spark.table("dx_acc")).collect()]
    assert got == [("0413", "Y")]


def test_poa_semi_anti(spark, tmp_path):
    from icdforge.operators import analytics

    FX.write_dx(str(tmp_path))
    FX.write_poa(str(tmp_path))
    jobs.load_diagnosis(spark, str(tmp_path), table="dx_sa", releases_=FX.DX_RELEASES)
    jobs.load_poa_exempt(spark, str(tmp_path), table="poa_sa", releases_=FX.POA_RELEASES)
    dx, poa = spark.table("dx_sa"), spark.table("poa_sa")
    exempt = {r.Diagnosis_Code for r in analytics.poa_exempt_only(dx, poa).collect()}
    required = {r.Diagnosis_Code for r in analytics.poa_required_only(dx, poa).collect()}
    assert exempt == {"V1919"} and required == {"0413", "66070", "O0910", "T82857D"}
    flags = {r.Diagnosis_Code: r.Is_POA_Exempt for r in analytics.poa_flag(dx, poa).collect()}
    assert flags["V1919"] == "Y" and flags["0413"] == "N"


def test_rejects_are_captured(spark, tmp_path):
    FX.write_dx(str(tmp_path), rejects=True)
    with pytest.raises(LoadCheckError):
        jobs.load_diagnosis(spark, str(tmp_path), table="dx_t2", releases_=FX.DX_RELEASES, reject_table="dx_rejects")
    want = {("field_count", 2012), ("field_too_long:ICD_Code", 2012), ("line_too_short", 2018)}
    assert {(r.reason, r.CMS_Fiscal_Year) for r in spark.table("dx_rejects").collect()} == want
    # within the allowed reject budget the load goes on; without a named table the rejects are kept too
    for _ in range(2):  # a repeated load replaces its own slice
        res = jobs.load_diagnosis(spark, str(tmp_path), table="dx_t2", releases_=FX.DX_RELEASES, max_rejects=3)
        assert res.rows == 5 and res.rejects == 3
        kept = spark.table("dx_t2_rejects").collect()
        assert len(kept) == 3 and {(r.reason, r.CMS_Fiscal_Year) for r in kept} == want


def test_version_choice_and_field_names(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    names = {"CMS_Fiscal_Year": "FY", "Diagnosis_Code": "Code"}
    res = jobs.load_diagnosis(spark, str(tmp_path), table="dx_t3", which="09", field_names=names, releases_=FX.DX_RELEASES)
    assert res.rows == 3
    assert {"FY", "Code"} <= set(spark.table("dx_t3").columns)
    with pytest.raises(ValueError):
        jobs.load_diagnosis(spark, str(tmp_path), table="dx_t3", which="11", releases_=FX.DX_RELEASES)


def test_table_actions(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    t = "dx_actions"
    jobs.load_diagnosis(spark, str(tmp_path), table=t, releases_=FX.DX_RELEASES)
    # APPEND of the same releases collides with the kept keys: nothing written
    with pytest.raises(LoadCheckError):
        jobs.load_diagnosis(spark, str(tmp_path), table=t, action="APPEND", releases_=FX.DX_RELEASES)
    assert spark.table(t).count() == 5
    # DELETE_ICD10 drops the ICD-10 slice, then reloads only ICD-10
    jobs.load_diagnosis(spark, str(tmp_path), table=t, action="DELETE_ICD10", which="10", releases_=FX.DX_RELEASES)
    assert spark.table(t).groupBy("ICD_Version").count().orderBy("ICD_Version").collect() == [(9, 3), (10, 2)]
    # DELETE_ICD9 with a load of version 9 only
    jobs.load_diagnosis(spark, str(tmp_path), table=t, action="DELETE_ICD9", which="9", releases_=FX.DX_RELEASES)
    assert spark.table(t).count() == 5
    jobs.load_diagnosis(spark, str(tmp_path), table=t, action="TRUNCATE", which="10", releases_=FX.DX_RELEASES)
    assert spark.table(t).count() == 2
    with pytest.raises(ValueError):
        jobs.load_diagnosis(spark, str(tmp_path), table=t, action="MERGE", releases_=FX.DX_RELEASES)
    with pytest.raises(ValueError):
        jobs.load_diagnosis(spark, str(tmp_path), table="no_such_table", action="TRUNCATE", releases_=FX.DX_RELEASES)


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.load_diagnosis(spark, str(tmp_path), table="dx_missing", releases_=FX.DX_RELEASES)


def test_poa_load_period_and_shared_file(spark, tmp_path):
    FX.write_poa(str(tmp_path))
    res = jobs.load_poa_exempt(spark, str(tmp_path), table="poa_t1", releases_=FX.POA_RELEASES)
    assert res.rows == 12
    got = rows(spark, "poa_t1", ["CMS_Fiscal_Year", "Diagnosis_Code", "Diagnosis_Code_With_Period", "Code_Desc_Long"])
    fy12 = [r[1:] for r in got if r[0] == 2012]
    assert fy12 == [
        ("755", "755", "Three digits"),
        ("75530", "755.30", "Five digits"),
        ("E800", "E800", "E four"),
        ("E8302", "E830.2", "E five"),
        ("V1919", "V19.19", "Lower v"),
    ]
    assert [r[1:] for r in got if r[0] == 2013] == fy12
    assert [r[1:] for r in got if r[0] == 2019] == [
        ("O0910", "O09.10", "Plain"),
        ("T8379XD", "T83.79XD", "Cut, open"),
    ]


def test_poa_faults(spark, tmp_path):
    FX.write_poa(str(tmp_path), faults=True)
    with pytest.raises(LoadCheckError) as e:
        jobs.load_poa_exempt(spark, str(tmp_path), table="poa_t2", releases_=FX.POA_RELEASES, max_rejects=10)
    # X123 has no period rule: NOT NULL violation of the period column
    assert "nulls" in e.value.report
    told = spark.table(e.value.check_table).filter("check_name = 'nulls'").collect()
    assert len(told) == e.value.report["nulls"] and all("Diagnosis_Code_With_Period" in r.detail for r in told)


def test_mce_load_and_checks(spark, tmp_path):
    FX.write_mce(str(tmp_path))
    res = jobs.load_mce_edits(spark, str(tmp_path), table="mce_t1", releases_=FX.MCE_RELEASES_)
    assert res.rows == 3
    got = rows(spark, "mce_t1", ["ICD_Version", "ICD_Code_Type", "ICD_Code", "MCE_Section", "MCE_Subsection", "MCE_Edit_Type"])
    assert got == [
        (10, "D", "A000", 6, "_", "Principal_Manifestation"),
        (10, "D", "P000", 4, "A", "Newborn_Only"),
        (10, "P", "0UT9", 5, "B", "Female_Only"),
    ]
    assert "MCE_Version" not in spark.table("mce_t1").columns
    # version mismatch
    FX.write_mce(str(tmp_path), [b"36\t9\t18\t_\tWrong_Performed\tD\tZ000\tWrong version"])
    with pytest.raises(LoadCheckError) as e:
        jobs.load_mce_edits(spark, str(tmp_path), table="mce_t2", releases_=FX.MCE_RELEASES_)
    assert "version_mismatch" in e.value.report
    # repeated key
    FX.write_mce(str(tmp_path), [b"36\t10\t4\tA\tNewborn_Only\tD\tP000\tAgain"])
    with pytest.raises(LoadCheckError) as e:
        jobs.load_mce_edits(spark, str(tmp_path), table="mce_t3", releases_=FX.MCE_RELEASES_)
    assert "duplicate_keys" in e.value.report
    # empty section: NULL into a NOT NULL column
    FX.write_mce(str(tmp_path), [b"36\t10\t\t_\tWrong_Performed\tD\tZ001\tNo section"])
    with pytest.raises(LoadCheckError):
        jobs.load_mce_edits(spark, str(tmp_path), table="mce_t4", releases_=FX.MCE_RELEASES_)
    # subsection longer than the column
    FX.write_mce(str(tmp_path), [b"36\t10\t18\tAB\tWrong_Performed\tD\tZ002\tLong subsection"])
    with pytest.raises(LoadCheckError) as e:
        jobs.load_mce_edits(spark, str(tmp_path), table="mce_t5", releases_=FX.MCE_RELEASES_)
    assert "MCE_Subsection" in spark.table(e.value.check_table).filter("check_name = 'lengths'").first().detail


def test_cli_load(spark, tmp_path, capsys):
    from icdforge.plans import cli

    FX.write_mce(str(tmp_path))
    import icdforge.operators.releases as R

    # the CLI uses the default release list; point it at the fixture release
    orig = jobs.load_mce_edits.__defaults__
    try:
        jobs.load_mce_edits.__defaults__ = orig[:-1] + (FX.MCE_RELEASES_,)
        assert cli.main(["mce_edits", "--source-dir", str(tmp_path), "--table", "mce_cli"]) == 0
    finally:
        jobs.load_mce_edits.__defaults__ = orig
    out = capsys.readouterr().out.strip().splitlines()[-1]
    assert '"rows": 3' in out
    assert spark.table("mce_cli").count() == 3
    assert R.MCE_RELEASES[0][0] == "33"


def _dim_rows(spark, codes, fy=2019):
    import datetime as dt

    rows = [(fy, dt.date(fy - 1, 10, 1), dt.date(fy, 9, 30), 10 if fy > 2015 else 9, c, "s", "l") for c in codes]
    return spark.createDataFrame(
        rows,
        "CMS_Fiscal_Year INT, Effective_Date DATE, End_Date DATE, ICD_Version INT, Diagnosis_Code STRING, "
        "Code_Desc_Short STRING, Code_Desc_Long STRING",
    )


def test_large_release_is_spread_over_files(spark, monkeypatch):
    import glob

    from icdforge.operators import tables
    from icdforge.plans import sinks

    monkeypatch.setattr(sinks, "MAX_RECORDS_PER_FILE", 100)
    name = sinks.publish(spark, _dim_rows(spark, [f"A{i:05d}" for i in range(400)]), "dx_large", tables.DIAGNOSIS, "DROP_CREATE")
    assert spark.table(name).count() == 400
    loc = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type
    assert len(glob.glob(loc.replace("file:", "") + "/ICD_Version=10/CMS_Fiscal_Year=2019/*.parquet")) == 4


def test_all_violations_are_kept(spark, tmp_path):
    """More than twenty of each kind; keys compare without case and trailing blanks."""
    lines = [f"36\t10\t4\tA\tNewborn_Only\tD\tP{i:03d}\tx".encode() for i in range(30)]
    lines += [f"36\t10\t4\tA\tNewborn_Only\tD\tp{i:03d}  \tx".encode() for i in range(30)]
    lines += [f"36\t10\t\t_\tWrong_Performed\tD\tN{i:03d}\tx".encode() for i in range(25)]
    lines += [f"36\t10\t18\tAB\tWrong_Performed\tD\tL{i:03d}\tx".encode() for i in range(26)]
    lines += [f"36\t9\t18\t_\tWrong_Performed\tD\tV{i:03d}\tx".encode() for i in range(27)]
    FX.write_mce(str(tmp_path), lines)
    for _ in range(2):
        with pytest.raises(LoadCheckError) as e:
            jobs.load_mce_edits(spark, str(tmp_path), table="mce_many", releases_=FX.MCE_RELEASES_)
        report = e.value.report
        assert report["duplicate_keys"] >= 30 and report["nulls"] == 25 and report["lengths"] == 26 and report["version_mismatch"] == 27
        assert spark.table(e.value.check_table).count() == sum(report.values())
    assert not spark.catalog.tableExists("mce_many")


def test_keys_collide_without_case(spark):
    from icdforge.operators import quality, tables

    new, old = _dim_rows(spark, ["a1", "B2", "c3 "]), _dim_rows(spark, ["A1", "b9", "C3"])
    assert {r.Diagnosis_Code for r in quality.key_collisions(new, old, tables.DIAGNOSIS.keys).collect()} == {"A1", "C3"}
    twice = quality.key_violations(_dim_rows(spark, ["A1", "a1", "b", "B  ", "c"]), tables.DIAGNOSIS.keys).collect()
    assert {(r.Diagnosis_Code, r.n_rows) for r in twice} == {("A1", 2), ("B", 2)}


@pytest.mark.parametrize("action", ["DROP_CREATE", "TRUNCATE", "DELETE_ICD9", "DELETE_ICD10", "APPEND"])
def test_failed_insert_leaves_the_table(spark, monkeypatch, action):
    from icdforge.operators import tables
    from icdforge.plans import sinks

    t = f"dx_keep_{action.lower()}"
    both = _dim_rows(spark, ["A1", "B2"]).unionByName(_dim_rows(spark, ["4011"], 2012))
    sinks.publish(spark, both, t, tables.DIAGNOSIS, "DROP_CREATE")
    before = sorted(map(tuple, spark.table(t).collect()))
    new = _dim_rows(spark, ["Z9"], 2020 if action != "DELETE_ICD9" else 2013)
    insert = sinks.insert

    def torn(df, *a, **k):
        from pyspark.sql import functions as F

        insert(df.withColumn("Code_Desc_Short", F.raise_error(F.lit("disk full")).cast("string")), *a, **k)

    monkeypatch.setattr(sinks, "insert", torn)
    with pytest.raises(Exception, match="disk full"):
        sinks.publish(spark, new, t, tables.DIAGNOSIS, action)
    assert sorted(map(tuple, spark.table(t).collect())) == before
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith(t + "__")]
    monkeypatch.setattr(sinks, "insert", insert)
    sinks.publish(spark, new, t, tables.DIAGNOSIS, action)
    after = {r.Diagnosis_Code for r in spark.table(t).collect()}
    assert after == {
        "DROP_CREATE": {"Z9"}, "TRUNCATE": {"Z9"}, "DELETE_ICD9": {"A1", "B2", "Z9"}, "DELETE_ICD10": {"4011", "Z9"}, "APPEND": {"A1", "B2", "4011", "Z9"},
    }[action]


def test_append_of_a_new_release_and_quoted_names(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    spark.sql("CREATE DATABASE IF NOT EXISTS `2020_codes`")
    kw = dict(table="10_select", schema="2020_codes", releases_=FX.DX_RELEASES)
    jobs.load_diagnosis(spark, str(tmp_path), which="9", **kw)
    jobs.load_diagnosis(spark, str(tmp_path), which="10", action="APPEND", **kw)
    assert spark.table("`2020_codes`.`10_select`").groupBy("ICD_Version").count().orderBy("ICD_Version").collect() == [(9, 3), (10, 2)]


def test_lines_of_an_unknown_file_are_rejects(spark):
    from icdforge.plans.pipeline import standardize
    from icdforge.operators import releases
    from icdforge.sources.parse import REASON

    lines = spark.createDataFrame([("V191\tx", "known.txt"), ("V202\ty", "other.txt")], "value STRING, CMS_File_Name STRING")
    rows = standardize(lines, releases.manifest(spark, [(9, 2012, "known.txt")]), "poa", 9).select("Diagnosis_Code", REASON).collect()
    assert {tuple(r) for r in rows} == {("V191", None), ("V202", "unknown_release")}


def test_names_that_differ_in_case_only_raise(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    first = next(f for f in tmp_path.iterdir())
    other = tmp_path / first.name.swapcase()
    other.write_bytes(first.read_bytes())
    with pytest.raises(ValueError, match="differ in case"):
        jobs.load_diagnosis(spark, str(tmp_path), table="dx_case", releases_=FX.DX_RELEASES)


def test_staged_copies_are_removed(spark, tmp_path):
    import glob

    FX.write_dx(str(tmp_path))
    jobs.load_diagnosis(spark, str(tmp_path), table="dx_staged", releases_=FX.DX_RELEASES)
    assert not glob.glob(spark.conf.get("spark.checkpoint.dir").replace("file:", "") + "/icdforge-load-*")
