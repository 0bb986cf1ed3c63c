"""Writers for redacted texts, vaults and stream results."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.session import stream_dir


def write_vault(vault: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The vault by type of personal data, so that access can be granted per folder. Keep it apart from the texts."""
    vault.write.mode(mode).partitionBy("type").parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """A table bucketed by its key: vault and texts written alike rejoin without a shuffle."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def run_stream(spark: SparkSession, stream: DataFrame, name: str, output: str = "append") -> DataFrame:
    """Run a stream over what is there now into a Parquet table in the checkpoint folder, and read it back."""
    base = stream_dir(spark, f"{name}-{uuid.uuid4().hex}")
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/table")
        .option("checkpointLocation", f"{base}/progress")
        .outputMode(output)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def run_to_end(spark: SparkSession, stream: DataFrame, name: str, keys: Sequence[str], output: str = "update") -> DataFrame:
    """Run an aggregation over what is there now, and give every group as it stood at the end, open windows too.

    Each batch writes the groups it changed under its own number, so a batch that runs again replaces its first try;
    of the rows of one group the last batch's counts. `complete` is for what has no update mode, session windows.
    """
    base = stream_dir(spark, f"{name}-{uuid.uuid4().hex}")
    write = lambda df, batch: df.write.mode("overwrite").parquet(f"{base}/table/_batch={batch}")
    for_each_batch(stream, f"{base}/progress", write, output)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    rows = spark.read.schema(f"{fields}, _batch BIGINT").parquet(f"{base}/table")
    if output == "complete":
        return rows.where(F.col("_batch") == rows.select(F.max("_batch")).scalar()).drop("_batch")
    rest = [c for c in stream.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
    return latest.select(*keys, "_last.*").select(*stream.columns)


def for_each_batch(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], output: str = "append"
) -> None:
    """Hand every batch to `write` with its number, so that a batch that runs again can replace its first result."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(output)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
