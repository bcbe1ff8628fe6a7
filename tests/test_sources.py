"""Line scans: encoding, header skip per file, file names, layout parsers."""


from pyspark.sql import functions as F

from icdforge.sources import DESC_ICD9, DESC_ICD10, MCE_EDITS, POA_ICD10, parse, read_lines, split_rejects


def test_windows_1252_and_crlf(spark, tmp_path):
    p = tmp_path / "A DX+1 Sheet1.txt"
    p.write_bytes(b'"CODE"|"LONG"|"SHORT"\r\n"0413"|"Fever of M\xe9ni\xe8re \x93q\x94 \x80"|"Fever M\xe9n"\r\n')
    lines = read_lines(spark, [str(p)], header=True).collect()
    assert len(lines) == 1
    assert lines[0].value == '"0413"|"Fever of Ménière “q” €"|"Fever Mén"'
    assert lines[0].CMS_File_Name == "A DX+1 Sheet1.txt"
    assert not lines[0].value.endswith("\r")


def test_header_skipped_in_every_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.txt").write_bytes(b"HEADER\r\nrow one\r\nrow two\r\n")
    rows = read_lines(spark, [str(tmp_path / f"f{i}.txt") for i in range(3)], header=True)
    assert rows.count() == 6
    assert rows.filter(F.col("value") == "HEADER").count() == 0
    no_skip = read_lines(spark, [str(tmp_path / "f0.txt")], header=False)
    assert no_skip.count() == 3


def test_blanks_and_quotes_kept(spark, tmp_path):
    p = tmp_path / "x.txt"
    p.write_bytes(b'  lead\ttab  \r\n"open q\r\n')
    vals = [r.value for r in read_lines(spark, [str(p)], header=False).collect()]
    assert vals == ["  lead\ttab  ", '"open q']


def lines_df(spark, values):
    return spark.createDataFrame([(v, "f.txt") for v in values], "value STRING, CMS_File_Name STRING")


def test_quoted_bar_parse_and_rejects(spark):
    df = lines_df(
        spark,
        [
            '"66070"|"Say ""aah"" | wide"|"Say aah"',
            '"1"|"two fields"',
            '"12345678"|"a"|"b"',
            '"no end quote"|"a"|"b',
        ],
    )
    got = {r["_raw"]: r for r in parse(df, DESC_ICD9).collect()}
    good = got['"66070"|"Say ""aah"" | wide"|"Say aah"']
    assert (good.ICD_Code, good.Code_Desc_Long, good.Code_Desc_Short) == ("66070", 'Say ""aah"" | wide', "Say aah")
    assert good._reject_reason is None
    assert got['"1"|"two fields"']._reject_reason == "field_count"
    assert got['"12345678"|"a"|"b"']._reject_reason == "field_too_long:ICD_Code"
    assert got['"no end quote"|"a"|"b']._reject_reason == "bad_quoting"


def test_fixed_width_fields(spark):
    line = "00002 O0910   1 " + "Short one".ljust(60) + " Long one"
    r = parse(lines_df(spark, [line, "too short"]), DESC_ICD10).orderBy("_raw").collect()
    assert r[0].ICD_Code == "O0910  " and r[0].Code_Is_HIPAA_Valid == "1"
    assert r[0].Code_Desc_Short == "Short one".ljust(60) and r[0].Code_Desc_Long == "Long one"
    assert r[1]._reject_reason == "line_too_short"


def test_tab_layouts(spark):
    poa = parse(lines_df(spark, ['1\tt83.79xd\t"Cut, open"']), POA_ICD10).first()
    assert poa.Diagnosis_Code_With_Period == "t83.79xd" and poa.Code_Desc_Long == '"Cut, open"'
    assert "ICD_Code_Order" not in poa.asDict()
    mce = parse(
        lines_df(spark, ["36\t10\t4\tA\tNewborn_Only\tD\tP000\tNewborn fixture", "36\t10\tX\tA\tT\tD\tP\td"]),
        MCE_EDITS,
    ).orderBy("_raw").collect()
    assert list(mce[0].asDict())[1:9] == [
        "ICD_Version", "ICD_Code_Type", "ICD_Code", "ICD_Code_Desc",
        "MCE_Version", "MCE_Section", "MCE_Subsection", "MCE_Edit_Type",
    ]
    assert mce[1]._reject_reason == "not_an_integer:MCE_Section"
    good, bad = split_rejects(parse(lines_df(spark, ["36\t10\tX\tA\tT\tD\tP\td"]), MCE_EDITS))
    assert good.count() == 0 and bad.count() == 1


def test_control_bytes_kept(spark, tmp_path):
    p = tmp_path / "ctl.txt"
    p.write_bytes(b"a\x01b\x02c\tz\r\n")
    assert [r.value for r in read_lines(spark, [str(p)], header=False).collect()] == ["a\x01b\x02c\tz"]
