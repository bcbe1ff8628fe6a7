"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers only fill in settings that are *unset*, so a cluster's own
configuration (shuffle partitions, checkpoint folder, AQE) always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for good plans; applied only when unset.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_recommended_conf(spark: SparkSession) -> None:
    for key, value in RECOMMENDED_CONF.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints / staged tables.

    Uses ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the session runs in local mode (tests, a laptop) a private folder is
    created and registered; on a cluster an unset folder is an error, because
    a machine-local folder is not visible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or object storage)")
    local = tempfile.mkdtemp(prefix="icdforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def local_session(app: str = "icdforge", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarking (UI off, small shuffle width)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ICDFORGE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
