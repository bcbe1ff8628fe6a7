"""Column functions and their properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from icdforge.functions import drop_periods, fiscal_year, icd9_add_period, icd9_period_problem, sql_trim

codes = st.one_of(
    st.from_regex(r"E[0-9]{3,4}", fullmatch=True),
    st.from_regex(r"V[0-9]{2,4}", fullmatch=True),
    st.from_regex(r"[0-9]{3,5}", fullmatch=True),
)


def test_period_rule_examples(spark):
    df = spark.createDataFrame(
        [("V1919",), ("E8302",), ("E800",), ("755",), ("75530",), ("E80",), ("X123",)], "c STRING"
    )
    got = {r.c: (r.p, r.why) for r in df.select("c", icd9_add_period("c").alias("p"), icd9_period_problem("c").alias("why")).collect()}
    assert got == {
        "V1919": ("V19.19", None),
        "E8302": ("E830.2", None),
        "E800": ("E800", None),
        "755": ("755", None),
        "75530": ("755.30", None),
        "E80": (None, "shorter_than_category"),
        "X123": (None, None),
    }


@settings(max_examples=1, deadline=None)
@given(st.lists(codes, min_size=1, max_size=200))
def test_remove_period_undoes_add_period(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c STRING")
    out = df.select("c", drop_periods(icd9_add_period("c")).alias("back")).collect()
    assert all(r.c == r.back for r in out)


def test_fiscal_year_and_trim(spark):
    df = spark.createDataFrame(
        [(dt.date(2015, 9, 30),), (dt.date(2015, 10, 1),), (dt.date(2016, 1, 1),)], "d DATE"
    )
    assert [r.fy for r in df.select(fiscal_year("d").alias("fy")).collect()] == [2015, 2016, 2016]
    t = spark.createDataFrame([("  a\tb  ",)], "s STRING").select(sql_trim("s").alias("t")).first().t
    assert t == "a\tb"
