"""Keyed copies: joins on the primary key without an exchange of stored rows."""

import re

import pytest
from pyspark.sql import functions as F

from icdforge.operators import analytics, quality, tables
from icdforge.plans import jobs, keyed
from tests import fixture_files as FX
from tests.test_jobs import _dim_rows

KEYS = list(tables.DIAGNOSIS.keys)


@pytest.fixture
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    return len(re.findall(r"\bExchange\b", _plan(df)))


def _codes(spark, rows):
    return spark.createDataFrame(rows, "CMS_Fiscal_Year int, ICD_Version int, ICD_Code_Type string, ICD_Code string, Code_Desc_Short string")


def _edits(spark, rows):
    return spark.createDataFrame(rows, "CMS_Fiscal_Year int, ICD_Version int, ICD_Code_Type string, ICD_Code string, MCE_Section int, MCE_Subsection string, MCE_Edit_Type string")


def test_no_exchange_of_the_kept_side(spark, no_broadcast):
    kept = keyed.save_keyed(_dim_rows(spark, ["A1", "b2 ", "C3"]), "dx_keyed_kept", KEYS, buckets=4)
    new = _dim_rows(spark, ["a1", "B2", "Z9", "Z9"])
    found = quality.key_collisions(new, kept, KEYS)
    plan = _plan(found)
    assert _exchanges(found) == 1 and "Bucketed: true" in plan and "BroadcastHashJoin" not in plan
    assert sorted(r.Diagnosis_Code for r in found.collect()) == ["A1", "B2"]
    assert _exchanges(quality.key_collisions(new, _dim_rows(spark, ["A1"]), KEYS)) == 2
    # a key index alone, and duplicates within a keyed table, need no exchange of it either
    index = keyed.save_key_index(_dim_rows(spark, ["A1", "a1 "]), "dx_key_index", KEYS, buckets=4)
    assert _exchanges(quality.key_collisions(new, index, KEYS)) == 1
    twice = quality.key_violations(index, KEYS)
    assert _exchanges(twice) == 0 and [tuple(r)[2:] for r in twice.collect()] == [("A1", 2)]


def test_edit_join_of_loaded_tables_without_exchange(spark, tmp_path, no_broadcast):
    FX.write_dx(str(tmp_path))
    jobs.load_diagnosis(spark, str(tmp_path), table="dx_for_keys", releases_=FX.DX_RELEASES)
    codes = analytics.code_dimension(spark.table("dx_for_keys"))
    edits = _edits(spark, [(2018, 10, "D", "o0910 ", 1, "A", "x"), (2018, 10, "D", "O0910", 2, "B", "y"), (2012, 9, "P", "0413", 1, "A", "z"), (2012, 9, "D", None, 1, "A", "w")])
    a = keyed.save_keyed(codes, "codes_keyed", analytics.EDIT_KEYS, buckets=4)
    b = keyed.save_keyed(edits, "edits_keyed", analytics.EDIT_KEYS, buckets=4)
    joined = analytics.edit_join(a, b)
    assert _exchanges(joined) == 0 and _plan(joined).count("Bucketed: true") == 2
    plain = analytics.edit_join(codes, edits.withColumn("ICD_Code", F.upper(F.rtrim("ICD_Code"))))
    assert joined.columns == plain.columns and _exchanges(plain) == 2
    order = lambda df: sorted(map(str, df.collect()))
    assert order(joined) == order(plain) and joined.filter("MCE_Edit_Type IS NOT NULL").count() == 2


def test_appends_stay_in_their_buckets(spark, no_broadcast):
    keyed.save_keyed(_dim_rows(spark, [f"A{i}" for i in range(50)]), "dx_keyed_append", KEYS, buckets=4)
    keyed.append_keyed(_dim_rows(spark, [f"B{i}" for i in range(50)], 2020), "dx_keyed_append")
    assert keyed.bucket_spec(spark, "dx_keyed_append") == (4, ["CMS_Fiscal_Year", "ICD_Version", "Key_Diagnosis_Code"])
    kept = spark.table("dx_keyed_append")
    files = {f.rsplit("/", 1)[-1] for f in kept.inputFiles()}
    assert kept.count() == 100 and len(files) <= 8 and len({f.split("_")[-1].split(".")[0] for f in files}) == 4
    found = quality.key_collisions(_dim_rows(spark, ["b7", "A7"], 2020), kept, KEYS)
    assert _exchanges(found) == 1 and [r.Diagnosis_Code for r in found.collect()] == ["B7"]
    with pytest.raises(ValueError, match="not a keyed table"):
        _dim_rows(spark, ["A1"]).write.mode("overwrite").saveAsTable("dx_not_keyed")
        keyed.append_keyed(_dim_rows(spark, ["A1"]), "dx_not_keyed")
    with pytest.raises(ValueError, match="in use"):
        keyed.with_keys(kept, KEYS)


def test_an_empty_keyed_table(spark, no_broadcast):
    empty = keyed.save_keyed(_dim_rows(spark, ["A1"]).limit(0), "dx_keyed_empty", KEYS, buckets=4)
    assert quality.key_collisions(_dim_rows(spark, ["A1"]), empty, KEYS).collect() == []
