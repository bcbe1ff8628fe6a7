"""Counts observed during the staging write, and loads of changed files only."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from icdforge.operators import tables
from icdforge.plans import jobs
from icdforge.plans.jobs import LoadCheckError
from icdforge.plans.snapshots import Snapshot, SnapshotStore
from icdforge.sources.parse import REASON
from tests import fixture_files as FX


@pytest.fixture
def scanned(monkeypatch):
    """Base names of the files that loads inspect and parse."""
    seen = {"inspected": [], "parsed": []}

    def watch(name, key):
        real = getattr(jobs, name)

        def call(spark, paths, *args, **kw):
            paths = list(paths)
            seen[key] += [p.rsplit("/", 1)[-1].replace("%20", " ") for p in paths]
            return real(spark, paths, *args, **kw)

        monkeypatch.setattr(jobs, name, call)

    watch("code_pages", "inspected")
    watch("read_lines", "parsed")
    return seen


def _clear(seen):
    for v in seen.values():
        v.clear()


def _rows(df):
    return sorted((r.CMS_Fiscal_Year, r.Diagnosis_Code, r.Code_Desc_Long) for r in df.collect())


def _later(path):
    at = os.stat(path).st_mtime + 10
    os.utime(path, (at, at))


def test_a_refresh_reads_new_and_changed_files_only(spark, tmp_path, scanned):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    FX.write_dx(str(src))
    load = lambda **kw: jobs.load_diagnosis(spark, str(src), table="dx_refresh", store_dir=root, releases_=FX.DX_RELEASES, action="REFRESH", **kw)
    first = load()
    assert first.rows == 5 and set(first.files) == {FX.DX9_NAME, FX.DX10_NAME}
    store = SnapshotStore(spark, root)
    before = store.current()
    assert {k: r.source["file"] for k, r in before.releases.items()} == {"9/2012": FX.DX9_NAME, "10/2018": FX.DX10_NAME}
    assert Snapshot.parse(before.text()) == before

    _clear(scanned)  # nothing changed: no file is opened, nothing is published
    assert load().files == () and scanned == {"inspected": [], "parsed": []} and store.current() == before

    _later(src / FX.DX10_NAME)  # another time, the same lines: inspected, not parsed
    assert load().files == () and scanned == {"inspected": [FX.DX10_NAME], "parsed": []} and store.current() == before

    _clear(scanned)  # another line
    with open(src / FX.DX10_NAME, "ab") as f:
        f.write(FX.fixed10("4", "Z999", "1", "New short", "New long") + FX.CRLF)
    res = load()
    assert res.files == (FX.DX10_NAME,) and res.rows == 3 and res.releases == [(10, 2018)]
    assert scanned == {"inspected": [FX.DX10_NAME], "parsed": [FX.DX10_NAME]}
    after = store.current()
    assert after.releases["9/2012"] == before.releases["9/2012"] and after.releases["10/2018"].folders != before.releases["10/2018"].folders
    whole = jobs.load_diagnosis(spark, str(src), table="dx_refresh", store_dir=str(tmp_path / "whole"), releases_=FX.DX_RELEASES)
    assert whole.rows == 6 and _rows(store.read()) == _rows(SnapshotStore(spark, str(tmp_path / "whole")).read())


def test_a_file_of_two_releases_and_a_failed_refresh(spark, tmp_path, scanned):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    FX.write_poa(str(src))
    load = lambda rel: jobs.load_poa_exempt(spark, str(src), table="poa_refresh", store_dir=root, releases_=rel, action="REFRESH")
    store = SnapshotStore(spark, root)
    load(FX.POA_RELEASES[:1] + FX.POA_RELEASES[2:])
    _clear(scanned)
    res = load(FX.POA_RELEASES)  # the second year of a known file is a new release
    assert res.files == (FX.POA9_NAME,) and res.releases == [(9, 2013)] and set(store.current().releases) == {"9/2012", "9/2013", "10/2019"}
    good = store.current()
    path = src / FX.POA9_NAME
    text = path.read_bytes()
    path.write_bytes(text + text.splitlines()[1] + FX.CRLF)  # a code twice
    with pytest.raises(LoadCheckError):
        load(FX.POA_RELEASES)
    assert store.current() == good
    path.write_bytes(text + b"9999\tOne more" + FX.CRLF)
    assert load(FX.POA_RELEASES).releases == [(9, 2012), (9, 2013)]
    assert store.read().filter("Diagnosis_Code = '9999'").count() == 2
    # rows appended from elsewhere have no single file: the next refresh replaces the release
    snap = store.current()
    assert snap.releases["9/2012"].plus(snap.releases["9/2012"]).source is None


def test_refresh_is_for_stores(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    with pytest.raises(ValueError, match="REFRESH"):
        jobs.load_diagnosis(spark, str(tmp_path), table="dx_no_refresh", action="REFRESH", releases_=FX.DX_RELEASES)


COUNTS = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from icdforge.operators import tables
from icdforge.plans import jobs
from icdforge.sources.parse import REASON

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1])
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
i = F.col("id")
rows = spark.range(0, 1000, 1, 4).select(
    F.when(i % 3 == 0, 2012).otherwise(2018).alias("CMS_Fiscal_Year"), F.lit("2017-10-01").cast("date").alias("Effective_Date"),
    F.lit("2018-09-30").cast("date").alias("End_Date"), F.lit(10).alias("ICD_Version"), i.cast("string").alias("Diagnosis_Code"),
    F.when(i % 10 == 0, None).when(i % 7 == 0, F.repeat(F.lit("x"), 61)).otherwise("s").alias("Code_Desc_Short"), F.lit("l").alias("Code_Desc_Long"),
    F.when(i % 13 == 0, "line_too_short").alias(REASON))

def torn(batches):
    for n, b in enumerate(batches):
        yield b
    c = TaskContext.get()
    if c.attemptNumber() < 2 and c.partitionId() % 2 == 0:
        raise IOError("lost")

staged, path, seen = jobs._stage(rows.mapInArrow(torn, rows.schema), jobs._counts(tables.DIAGNOSIS, False, [2012, 2018]))
good = F.col(REASON).isNull()
again = staged.agg(*jobs._counts(tables.DIAGNOSIS, False, [2012, 2018])).first().asDict()
assert seen == again, (seen, again)
assert seen["good"] == 923 and seen["rejects"] == 77 and seen["good_2012"] + seen["good_2018"] == 923, seen
print("equal")
spark.stop()
"""


def test_counts_of_repeated_tasks(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", COUNTS, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=root, env={**os.environ, "PYTHONPATH": root})
    assert run.returncode == 0 and "equal" in run.stdout, run.stderr[-2000:]


def test_counts_of_no_rows(spark):
    empty = spark.createDataFrame([], "CMS_Fiscal_Year int, Effective_Date date, End_Date date, ICD_Version int, Diagnosis_Code string, Code_Desc_Short string, Code_Desc_Long string").withColumn(REASON, F.lit(None).cast("string"))
    staged, path, seen = jobs._stage(empty, jobs._counts(tables.DIAGNOSIS, False, [2012]))
    assert seen == {"good": 0, "rejects": 0, "nulls": 0, "lengths": 0, "good_2012": 0} and staged.count() == 0
    jobs._unstage(spark, path)
