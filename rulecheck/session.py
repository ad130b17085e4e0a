"""Spark session defaults for local runs (tests, bench). On a cluster, use
the cluster's session; only unset settings are filled in."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle partitions to the advisory size (64 MB), not to the core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rulecheck") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; only a
    local session that has none gets a scratch folder (tests)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.conf.get("spark.master", "local").startswith("local[") and spark.conf.get("spark.master", "local") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="rulecheck-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle (Spark Connect)
        pass
    return current
