"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: the
checkpoint folder is read from the session (``spark.checkpoint.dir`` or an
explicit ``setCheckpointDir``).  Only when nothing is configured -- local runs
and tests -- a private temporary folder is created.
"""
from __future__ import annotations

import os
import tempfile

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "alertlens") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("ALERTLENS_DRIVER_MEM", "16g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def split_hot_alerts(spark: SparkSession) -> None:
    """Let a skewed join be split even if the aggregation above it is then
    shuffled once more: the alert joins are followed by aggregations on the
    same key, and one alert may hold a third of all transactions."""
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, "true")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running ordered operators on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="alertlens-ckpt-"))
    return sc.getCheckpointDir()


def written_once(df: DataFrame) -> DataFrame:
    """``df`` written as a table below the checkpoint folder and read back.

    Like ``checkpoint()`` it cuts the lineage and survives lost executors; the
    rows are computed once, stored by column and read with column pruning."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
