"""Code pages of whole files, and loads of files in the wrong page."""

import pytest

from icdforge.plans import jobs
from icdforge.plans.jobs import LoadCheckError
from icdforge.sources import code_pages
from tests import fixture_files as FX

WORD = "Ménière’s"


def _expected(data: bytes) -> str:
    """The page by Python's own decoder, byte by byte."""
    body = data.removeprefix(b"\xef\xbb\xbf").replace(b"\r\n", b"\n")
    in_sequence, alone, i = 0, [], 0
    while i < len(body):
        for n in (4, 3, 2):
            part = body[i:i + n]
            try:
                one = len(part) == n and len(part.decode()) == 1
            except UnicodeDecodeError:
                one = False
            if one:
                in_sequence += n
                i += n
                break
        else:
            alone.append(body[i])
            i += 1
    high = in_sequence + sum(b >= 0x80 for b in alone)
    control = any(b < 0x20 and b not in b"\t\r\n" or b == 0x7F for b in body)
    if control or b"\xef\xbf\xbd" in body or any(b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) for b in alone):
        return "damaged"
    return "ascii" if not high else "utf-8" if in_sequence == high else "mixed" if in_sequence else "cp1252"


FILES = {
    "plain.txt": b"CODE\tText\r\nA\tplain\r\n",
    "windows.txt": f"CODE\r\n1 {WORD}\r\n".encode("cp1252"),
    "utf8.txt": f"CODE\r\n1 {WORD} 日\U0001f600\r\n".encode(),
    "bom only.txt": b"\xef\xbb\xbfCODE\r\nplain\r\n",
    "both+more.txt": f"1 {WORD}\r\n".encode("cp1252") + f"2 {WORD}\r\n".encode(),
    "lost.txt": "1 M�ni\r\n".encode(),
    "undefined.txt": b"1 \x81 x\r\n",
    "zero.txt": "CODE\r\n".encode("utf-16-le") * 2,
    "late.txt": b"x\r\n" * 5_000 + "é\r\n".encode(),
    "overlong.txt": b"\xc0\xaf and \xed\xa0\x80 and \xf4\x90\x80\x80\r\n",
    "cut.txt": "日".encode()[:2] + b"\r\n",
}


def test_pages_of_whole_files(spark, tmp_path):
    for name, data in FILES.items():
        (tmp_path / name).write_bytes(data)
    got = {r[0]: r for r in code_pages(spark, [str(tmp_path / n) for n in FILES]).collect()}
    assert {n: r.code_page for n, r in got.items()} == {n: _expected(d) for n, d in FILES.items()}
    assert {r.code_page for r in got.values()} == {"ascii", "cp1252", "utf-8", "mixed", "damaged"}
    assert got["late.txt"].n_lines == 5_001 and got["late.txt"].n_high == got["late.txt"].n_sequence == 2
    assert got["windows.txt"].n_high == 3 and got["windows.txt"].n_sequence == 0
    (tmp_path / "empty.txt").write_bytes(b"")
    assert code_pages(spark, [str(tmp_path / "empty.txt")]).collect() == []
    with pytest.raises(ValueError):
        code_pages(spark, [])


def test_a_file_in_another_page_is_rejected_before_publishing(spark, tmp_path):
    FX.write_dx(str(tmp_path))
    kw = dict(table="dx_page", releases_=FX.DX_RELEASES)
    assert jobs.load_diagnosis(spark, str(tmp_path), **kw).rows == 5
    before = sorted(map(tuple, spark.table("dx_page").collect()))
    nine = tmp_path / FX.DX9_NAME
    nine.write_bytes(nine.read_bytes().decode("cp1252").encode())  # saved as UTF-8; its accents are in no named code's row alone
    with pytest.raises(LoadCheckError) as e:
        jobs.load_diagnosis(spark, str(tmp_path), **kw)
    assert e.value.report == {"rejects": 3}
    rejects = spark.table("dx_page_rejects").collect()
    assert {(r.reason, r.CMS_Fiscal_Year) for r in rejects} == {("code_page:utf-8", 2012)} and len(rejects) == 3
    assert sorted(map(tuple, spark.table("dx_page").collect())) == before
    # within the allowance the other releases are loaded, the wrong file is not
    res = jobs.load_diagnosis(spark, str(tmp_path), max_rejects=3, **kw)
    assert res.rows == 2 and {r.CMS_Fiscal_Year for r in spark.table("dx_page").collect()} == {2018}


def test_names_that_differ_in_case_are_rejected_too(spark, tmp_path):
    FX.write_poa(str(tmp_path))
    ten = tmp_path / FX.POA10_DISK_NAME
    ten.write_bytes(ten.read_bytes() + b"3\tA00\tx\x00y\r\n")
    with pytest.raises(LoadCheckError) as e:
        jobs.load_poa_exempt(spark, str(tmp_path), table="poa_page", releases_=FX.POA_RELEASES)
    assert e.value.report == {"rejects": 3}
    assert {(r.reason, r.CMS_Fiscal_Year) for r in spark.table("poa_page_rejects").collect()} == {("code_page:damaged", 2019)}
