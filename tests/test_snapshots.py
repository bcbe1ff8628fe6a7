"""The versioned store: one commit per table action."""

import threading

import pytest

from icdforge.operators import analytics, history, tables
from icdforge.plans import jobs, sinks
from icdforge.plans.jobs import LoadCheckError
from icdforge.plans.snapshots import ConcurrentLoad, SnapshotStore
from tests import fixture_files as FX
from tests.test_jobs import _dim_rows

SPEC = tables.DIAGNOSIS


def _codes(df):
    return sorted((r.CMS_Fiscal_Year, r.Diagnosis_Code) for r in df.collect())


def _both(spark):
    return _dim_rows(spark, ["A1", "B2"]).unionByName(_dim_rows(spark, ["4011"], 2012))


@pytest.mark.parametrize("action, fy, after", [
    ("DROP_CREATE", 2020, {"Z9"}), ("TRUNCATE", 2020, {"Z9"}), ("DELETE_ICD9", 2013, {"A1", "B2", "Z9"}),
    ("DELETE_ICD10", 2020, {"4011", "Z9"}), ("APPEND", 2020, {"A1", "B2", "4011", "Z9"}), ("DELETE_ICD9", 2019, {"A1", "B2", "Z9"}),
])
def test_readers_see_the_old_rows_or_the_new(spark, tmp_path, action, fy, after):
    store = SnapshotStore(spark, str(tmp_path / "t"))
    base = store.publish(_both(spark), SPEC, "DROP_CREATE")
    seen, stop = set(), threading.Event()

    def reader():
        own = SnapshotStore(spark, store.root)
        while not stop.is_set():
            seen.add(frozenset(c for _, c in _codes(own.read())))

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        snap = store.publish(_dim_rows(spark, ["Z9"], fy), SPEC, action, base)
    finally:
        stop.set()
        thread.join()
    assert seen <= {frozenset({"A1", "B2", "4011"}), frozenset(after)}
    assert {c for _, c in _codes(store.read())} == after
    assert {c for _, c in _codes(store.read(base.number))} == {"A1", "B2", "4011"}  # the earlier snapshot stays readable
    assert sum(r.rows for r in snap.releases.values()) == len(after)


def test_failed_repeated_and_concurrent_loads(spark, tmp_path):
    from pyspark.sql import functions as F

    store = SnapshotStore(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        store.publish(_both(spark), SPEC, "TRUNCATE")
    with pytest.raises(ValueError):
        store.publish(_both(spark), SPEC, "MERGE")
    base = store.publish(_both(spark), SPEC, "APPEND")
    torn = _dim_rows(spark, ["Z9"]).withColumn("Code_Desc_Short", F.raise_error(F.lit("disk full")).cast("string"))
    with pytest.raises(Exception, match="disk full"):
        store.publish(torn, SPEC, "DELETE_ICD10", base)
    assert store.current() == base and _codes(store.read()) == [(2012, "4011"), (2019, "A1"), (2019, "B2")]
    # no repair: the repeated load just goes on
    snap = store.publish(_dim_rows(spark, ["Z9"]), SPEC, "DELETE_ICD10", base)
    assert _codes(store.read()) == [(2012, "4011"), (2019, "Z9")]
    with pytest.raises(ConcurrentLoad):
        store.publish(_dim_rows(spark, ["Q1"], 2021), SPEC, "APPEND", base)
    assert store.current() == snap
    with pytest.raises(ValueError, match="columns"):
        store.publish(_dim_rows(spark, ["Q1"], 2021).withColumnRenamed("Code_Desc_Short", "Short"), SPEC.renamed({"Code_Desc_Short": "Short"}), "APPEND", snap)
    # what no record names goes, once it is old enough
    assert store.vacuum(keep=1) == []
    gone = store.vacuum(keep=1, grace_seconds=-10)
    assert len(gone) >= 2 and store.numbers() == [snap.number] and _codes(store.read()) == [(2012, "4011"), (2019, "Z9")]


def test_stored_fingerprints_tell_identical_releases(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "t"))
    cols = [c for c in SPEC.names if c not in ("ICD_Version", "CMS_Fiscal_Year", "Effective_Date", "End_Date")]
    first = store.publish(_dim_rows(spark, ["A", "B"], 2018).unionByName(_dim_rows(spark, ["B", "A"], 2019)), SPEC, "DROP_CREATE")
    snap = store.publish(_dim_rows(spark, ["A"], 2020), SPEC, "APPEND", first)
    snap = store.publish(_dim_rows(spark, ["B"], 2020), SPEC, "APPEND", snap)  # a release in two loads
    every = [c for c in SPEC.names if c not in ("ICD_Version", "CMS_Fiscal_Year")]
    fresh = {tuple(r) for r in history.release_fingerprints(store.read(), every).collect()}
    assert {tuple(r) for r in store.fingerprints().collect()} == fresh
    pairs = analytics.release_pairs(store.fingerprints())
    dates_differ = {r.From_FY: r.Is_Identical for r in history.identical_releases(store.fingerprints(), pairs).collect()}
    assert dates_differ == {2018: "N", 2019: "N"}  # validity dates are part of the rows
    prints = history.release_fingerprints(store.read(), cols)
    assert {r.From_FY: r.Is_Identical for r in history.identical_releases(prints, pairs, store.read(), cols).collect()} == {2018: "Y", 2019: "Y"}


def test_loads_publish_into_a_store(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    FX.write_dx(str(files))
    kw = dict(store_dir=str(tmp_path / "store"), table="dx_store", releases_=FX.DX_RELEASES)
    assert jobs.load_diagnosis(spark, str(files), which="9", **kw).rows == 3
    assert jobs.load_diagnosis(spark, str(files), which="10", action="APPEND", **kw).rows == 2
    store = SnapshotStore(spark, kw["store_dir"])
    assert store.read().groupBy("ICD_Version").count().orderBy("ICD_Version").collect() == [(9, 3), (10, 2)]
    with pytest.raises(LoadCheckError) as e:
        jobs.load_diagnosis(spark, str(files), which="10", action="APPEND", **kw)
    assert e.value.report == {"keys_already_in_table": 2}
    jobs.load_diagnosis(spark, str(files), which="10", action="DELETE_ICD10", **kw)
    assert store.numbers() == [1, 2, 3] and store.read().count() == 5
    assert not spark.catalog.tableExists("dx_store")


@pytest.mark.parametrize("load_id", ["o'brien", "a/b c", "back\\slash", "'", 'say "x"', " "])
def test_load_ids_are_kept_as_they_are(spark, tmp_path, load_id):
    FX.write_mce(str(tmp_path), [b"36\t10\t4\tA\tNewborn_Only\tD\tP000\tAgain"])
    t = "mce_ids"
    for _ in range(2):
        with pytest.raises(LoadCheckError) as e:
            jobs.load_mce_edits(spark, str(tmp_path), table=t, load_id=load_id, releases_=FX.MCE_RELEASES_)
        assert e.value.report["duplicate_keys"] == 1
    kept = spark.table(e.value.check_table).collect()
    assert sum(r.Load_Id == load_id for r in kept) == 1
    FX.write_mce(str(tmp_path))
    jobs.load_mce_edits(spark, str(tmp_path), table=t, load_id=load_id, releases_=FX.MCE_RELEASES_)
    assert spark.table(e.value.check_table).filter(spark.table(e.value.check_table).Load_Id == load_id).count() == 0
    spark.sql(f"DROP TABLE {t}")
    with pytest.raises(ValueError):
        sinks.record(spark, spark.range(0), "x", "", "id LONG")
