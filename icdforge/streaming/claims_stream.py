"""Single-code edits on a stream of submitted claims.

Claims arrive whole (one record per claim with its diagnosis and procedure
code arrays, principal diagnosis first), so flagging is stateless: explode
the codes, stamp the release of the service date, and join the static edit
table (stream-static inner joins are supported and need no state store).
Nothing is held per claim between micro-batches, so there is no watermark to
tune and no state to lose; the sink's checkpoint makes the output exactly
once across restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import claims as C
from ..session import checkpoint_dir

CLAIM_SCHEMA = (
    "claim_id BIGINT, service_date DATE, age INT, sex STRING, los_hours INT, dx ARRAY<STRING>, px ARRAY<STRING>"
)


def flag_claims(claims_stream: DataFrame, edits: DataFrame, manifest_df: DataFrame, **rule_params) -> DataFrame:
    """Streaming (or batch) DataFrame of firing edits for array-shaped claims.

    Same output as :func:`icdforge.operators.claims.apply_edits`; the
    principal is position 0 of ``dx``, so no aggregation is needed.
    """
    # one record in, its codes out, carrying the header columns
    header = ["service_date", "age", "sex", "los_hours"]
    ctx = C.claim_codes_from_arrays(claims_stream, keep=header)
    ctx = ctx.withColumn(
        "Is_Principal", F.when((F.col("ICD_Code_Type") == "D") & (F.col("seq") == 0), "Y").otherwise("N")
    )
    ctx = C.claims_with_release(ctx, manifest_df)
    return C.apply_edits(ctx, edits, **rule_params).select(
        "claim_id", "service_date", "CMS_Fiscal_Year", "ICD_Version", "ICD_Code_Type", "ICD_Code",
        "Is_Principal", "MCE_Edit_Type",
    )


def read_claim_files(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of claim files landing in ``path`` (schema fixed, never inferred)."""
    r = spark.readStream.format(fmt).schema(CLAIM_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start_flagging(
    spark: SparkSession,
    claims_path: str,
    edits: DataFrame,
    manifest_df: DataFrame,
    output_path: str,
    query_name: str = "mce_claim_edits",
    checkpoint_location: str | None = None,
    trigger_seconds: int | None = None,
    **rule_params,
) -> StreamingQuery:
    """Start the stream: claim files in, firing edits appended as Parquet.

    The checkpoint lives under the session's shared ``spark.checkpoint.dir``
    unless given."""
    loc = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/{query_name}"
    flags = flag_claims(read_claim_files(spark, claims_path), edits, manifest_df, **rule_params)
    w = (
        flags.writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", loc)
        .queryName(query_name)
        .outputMode("append")
    )
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
