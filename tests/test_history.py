"""Chains of deltas, release fingerprints and validity spans."""

import itertools
import random

import pytest

from icdforge.operators import analytics, history, releases

DIM = "CMS_Fiscal_Year INT, ICD_Version INT, Diagnosis_Code STRING, Code_Desc_Long STRING"
YEARS = (2011, 2012, 2013, 2014)


def _dim(spark, seed=1):
    r = random.Random(seed)
    rows = [(fy, v, f"C{k}", r.choice("xyz")) for v in (9, 10) for k in range(40) for fy in YEARS if r.random() < 0.6]
    return spark.createDataFrame(rows, DIM)


def _pairs(spark):
    man = spark.createDataFrame([(v, fy) for v in (9, 10) for fy in YEARS], "ICD_Version INT, CMS_Fiscal_Year INT")
    return analytics.release_pairs(man)


def _rows(df):
    return sorted(map(tuple, df.select("ICD_Version", "CMS_Fiscal_Year", "Diagnosis_Code", "Code_Desc_Long").collect()))


def test_releases_are_rebuilt_from_the_newest_and_the_deltas(spark):
    dim, pairs = _dim(spark), _pairs(spark)
    delta = analytics.release_delta(dim, pairs, "Diagnosis_Code")
    newest = dim.filter("CMS_Fiscal_Year = 2014")
    assert _rows(history.rebuild_releases(newest, delta, pairs, "Diagnosis_Code")) == _rows(dim.filter("CMS_Fiscal_Year < 2014"))
    # one release only, nothing to go back to; no rows at all
    assert history.rebuild_releases(newest, delta.limit(0), pairs.limit(0), "Diagnosis_Code").count() == 0
    assert history.rebuild_releases(newest.limit(0), delta.limit(0), pairs, "Diagnosis_Code").count() == 0


@pytest.mark.parametrize("fault, message", [
    ("newest", "last change contradicts"), ("text", "last description"), ("middle", "changes contradict"), ("twice", "changes contradict"), ("rows", "two newest rows"),
])
def test_contradicting_chains_fail(spark, fault, message):
    pairs = _pairs(spark).filter("ICD_Version = 9")
    steps = [(9, 2011, 2012, "A", "added", None, "x"), (9, 2012, 2013, "A", "revised", "x", "y")]
    newest = [(2014, 9, "A", "y")]
    if fault == "newest":
        newest = []
    elif fault == "text":
        newest = [(2014, 9, "A", "z")]
    elif fault == "middle":
        steps[1] = (9, 2012, 2013, "A", "revised", "q", "y")
    elif fault == "twice":
        steps.append(steps[1])
    else:
        newest = newest * 2
    delta = spark.createDataFrame(steps, "ICD_Version INT, From_FY INT, To_FY INT, Diagnosis_Code STRING, Change STRING, Old_Desc STRING, New_Desc STRING")
    with pytest.raises(Exception, match=message):
        history.rebuild_releases(spark.createDataFrame(newest, DIM), delta, pairs, "Diagnosis_Code").collect()


def test_composed_deltas_equal_the_direct_one(spark):
    dim, pairs = _dim(spark, 2), _pairs(spark)
    delta = analytics.release_delta(dim, pairs, "Diagnosis_Code")
    for a, b in itertools.combinations(YEARS, 2):
        direct = analytics.release_delta(dim, pairs.selectExpr("ICD_Version", f"{a} AS From_FY", f"{b} AS To_FY").distinct(), "Diagnosis_Code")
        cols = ["ICD_Version", "Diagnosis_Code", "Change", "Old_Desc", "New_Desc"]
        got = sorted(map(tuple, history.compose_deltas(delta, "Diagnosis_Code", a, b).select(*cols).collect()), key=str)
        assert got == sorted(map(tuple, direct.select(*cols).collect()), key=str)


def test_fingerprints_tell_releases_apart(spark):
    rows = [(2011, 9, "A", "x"), (2011, 9, "B", "y"), (2012, 9, "B", "y"), (2012, 9, "A", "x"), (2013, 9, "A", "x"), (2013, 9, "A", "x"), (2013, 9, "B", "y"),
            (2014, 9, "AB", None), (2011, 10, "A", ""), (2012, 10, "A", None), (2013, 10, "1", "2:x"), (2014, 10, "12", ":x")]
    dim, pairs = spark.createDataFrame(rows, DIM), _pairs(spark)
    cols = ["Diagnosis_Code", "Code_Desc_Long"]
    prints = history.release_fingerprints(dim.repartition(5), cols)
    got = {(r.ICD_Version, r.From_FY): (r.n_old, r.n_new, r.Is_Identical) for r in history.identical_releases(prints, pairs).collect()}
    assert got == {(9, 2011): (2, 2, "Y"), (9, 2012): (2, 3, "N"), (9, 2013): (3, 1, "N"), (10, 2011): (1, 1, "N"), (10, 2012): (1, 1, "N"), (10, 2013): (1, 1, "N")}
    # a stale fingerprint that agrees is settled by the rows
    stale = prints.withColumn("n_rows", prints.n_rows * 0).withColumns({f"Sum_{k}": prints["Sum_1"] * 0 for k in range(1, 5)})
    settled = {(r.ICD_Version, r.From_FY): r.Is_Identical for r in history.identical_releases(stale, pairs, dim, cols).collect()}
    assert settled == {k: v[2] for k, v in got.items()}
    same = analytics.release_identity(dim, pairs, cols).collect()
    assert {(r.ICD_Version, r.From_FY): r.Is_Identical for r in same} == settled


def test_validity_spans_and_reasons(spark):
    man = releases.manifest(spark, [(9, fy, f"f{fy}") for fy in (2009, 2010, 2012, 2013, 2014, 2015)])  # no release of 2011
    held = {"A": (2010, 2012), "B": (2009, 2013, 2014), "C": (2012,), "D": ()}
    codes = spark.createDataFrame([(fy, 9, c) for c, fys in held.items() for fy in fys] + [(2012, 9, "C")], "CMS_Fiscal_Year INT, ICD_Version INT, ICD_Code STRING")
    spans = history.code_spans(codes, man, ["ICD_Code"])
    got = {(r.ICD_Code, r.From_FY, r.To_FY, str(r.Valid_From), str(r.Valid_To), r.n_releases) for r in spans.collect()}
    assert got == {("A", 2010, 2012, "2009-10-01", "2012-09-30", 2), ("B", 2009, 2009, "2008-10-01", "2009-09-30", 1),
                   ("B", 2013, 2014, "2012-10-01", "2014-09-30", 2), ("C", 2012, 2012, "2011-10-01", "2012-09-30", 1)}
    headers = spark.createDataFrame([(2014, 9, "H"), (2014, 9, "C")], codes.schema)
    used = spark.createDataFrame([(fy, 9, c) for c in "ABCDH" for fy in (2009, 2010, 2012, 2014, 2015)], codes.schema)
    for limit in (None, 10**9):  # broadcast, and dealt over salts
        told = {(r.ICD_Code, r.CMS_Fiscal_Year): r.Reason for r in history.invalid_reasons(used, spans, ["ICD_Code"], headers, span_rows=limit).collect()}
        assert told == {
            ("A", 2009): "not_yet", ("A", 2014): "no_longer", ("A", 2015): "no_longer", ("B", 2010): "suspended", ("B", 2012): "suspended", ("B", 2015): "no_longer",
            ("C", 2009): "not_yet", ("C", 2010): "not_yet", ("C", 2014): "header_code", ("C", 2015): "no_longer",
            ("H", 2014): "header_code", **{("H", fy): "never_valid" for fy in (2009, 2010, 2012, 2015)}, **{("D", fy): "never_valid" for fy in (2009, 2010, 2012, 2014, 2015)},
        }
