"""Fixture release files of FIXTURES.md, written as Windows-1252 with CRLF."""

from __future__ import annotations

import os

CRLF = b"\r\n"


def _write(path: str, lines: list[bytes]) -> str:
    with open(path, "wb") as f:
        f.write(CRLF.join(lines) + CRLF)
    return path


def fixed10(order: str, code: str, flag: str, short: str, long: str) -> bytes:
    line = f"{order:0>5} {code:<7} {flag} {short:<60} {long}"
    return line.encode("cp1252")


DX9_NAME = "CMS29_DESC_LONG_SHORT_DX 101111u021012 Sheet1.txt"
DX10_NAME = "icd10cm_order_2018.txt"
POA9_NAME = "POA_Exempt_Diagnosis_Codes_Oct12011_FY2012.txt"
POA10_DISK_NAME = "POAexemptCodes2019.txt"  # case differs from the manifest's name
POA10_NAME = "POAexemptcodes2019.txt"
MCE_NAME = "MCE_Simple_Code_Edits_v36.txt"

DX_RELEASES = ((9, 2012, DX9_NAME), (10, 2018, DX10_NAME))
POA_RELEASES = ((9, 2012, POA9_NAME), (9, 2013, POA9_NAME), (10, 2019, POA10_NAME))
MCE_RELEASES_ = (("36", 10, 2019),)


def write_dx(dir_: str, rejects: bool = False) -> None:
    l9 = [
        b'"CODE"|"LONG"|"SHORT"',
        b'"0413"|"Fever of M\xe9ni\xe8re"|"Fever M\xe9n"',
        b'" 66070 "|"Say ""aah"" | wide"|" Say aah "',
        b'"V1919XX"|"Long V"|"Short V"',
    ]
    l10 = [
        fixed10("1", "A00", "0", "Fixture header", "Fixture header"),
        fixed10("2", "O0910", "1", "Short one", "Long one"),
        fixed10("3", "T82857D", "1", 'Short ""two""', 'Long ""two""'),
    ]
    if rejects:
        l9 += [b'"99999"|"only two fields"', b'"ABCDEFGH"|"Long"|"Short"']
        l10 += [b"00004 B01     1 too short"]
    _write(os.path.join(dir_, DX9_NAME), l9)
    _write(os.path.join(dir_, DX10_NAME), l10)


def write_poa(dir_: str, faults: bool = False) -> None:
    l9 = [
        b"Code\tDescription",
        b"v1919\t Lower v ",
        b"e8302\tE five",
        b"E800\tE four",
        b"755\tThree digits",
        b"75530\tFive digits",
    ]
    if faults:
        l9 += [b"E80\tShorter than category", b"X123\tNo period rule"]
    l10 = [b"Order\tCode\tDescription", b'1\tt83.79xd\t"Cut, open"', b"2\tO09.10\tPlain"]
    _write(os.path.join(dir_, POA9_NAME), l9)
    _write(os.path.join(dir_, POA10_DISK_NAME), l10)


def write_mce(dir_: str, extra: list[bytes] | None = None) -> None:
    lines = [
        b"MCE_Version\tICD_Version\tMCE_Section\tMCE_Subsection\tMCE_Edit_Type\tICD_Code_Type\tICD_Code\tICD_Code_Desc",
        b"36\t10\t4\tA\tNewborn_Only\tD\tP000\tNewborn fixture",
        b"36\t10\t6\t_\tPrincipal_Manifestation\tD\tA000\tManifest fixture",
        b"36\t10\t5\tB\tFemale_Only\tP\t0UT9\tProcedure fixture",
    ] + (extra or [])
    _write(os.path.join(dir_, MCE_NAME), lines)
