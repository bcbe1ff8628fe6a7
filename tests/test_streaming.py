"""Streaming claim edits give the batch operator's flags."""

from icdforge.operators import releases
from icdforge.streaming import flag_claims, read_claim_files
from tests.test_claims import CLAIMS, EDITS


def test_stream_matches_batch(spark, tmp_path):
    edits = spark.createDataFrame(
        EDITS,
        "CMS_Fiscal_Year INT, ICD_Version INT, ICD_Code_Type STRING, ICD_Code STRING, MCE_Section INT, "
        "MCE_Subsection STRING, MCE_Edit_Type STRING",
    )
    src = tmp_path / "claims"
    from icdforge.streaming import CLAIM_SCHEMA

    spark.createDataFrame(CLAIMS, CLAIM_SCHEMA).write.parquet(str(src))
    man = releases.manifest(spark, releases.DIAGNOSIS_RELEASES)
    q = (
        flag_claims(read_claim_files(spark, str(src)), edits, man)
        .writeStream.format("memory")
        .queryName("flags_test")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .outputMode("append")
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.claim_id, r.MCE_Edit_Type) for r in spark.sql("SELECT * FROM flags_test").collect())
    assert got == [(1, "Newborn_Only"), (2, "Female_Only"), (2, "Principal_Manifestation")]
