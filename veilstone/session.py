"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Results compare with other engines only in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # Run-time partition sizing, and splitting of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The wire format lets the last of two equal keys win.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: The state store that operators with state of their own need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS["spark.sql.streaming.stateStore.providerClass"] = STATE_STORE


def build_session(app: str = "veilstone", **extra: str) -> SparkSession:
    """Session with the settings above; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster. A scratch one is made where none is set in local mode; a cluster must name one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="veilstone-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a small intermediate table that is used more than once to the checkpoint folder, and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def stream_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), name)
