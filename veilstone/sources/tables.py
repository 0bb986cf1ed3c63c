"""Readers for the tables the operators work on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give heavy per-row work one task per core when the input is a handful of files.

    A file with one row group is read by one task. Large inputs have files enough and pass through unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)


def read_text_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    return spread(read_table(spark, folder, name), key)


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The table as a stream of its files, be it one file or a folder of them; the schema comes from what is there."""
    # written as a glob, as a stream takes a plain path for a folder; it matches this one name
    path = os.path.join(folder, f"[{name[0]}]{name[1:]}.parquet")
    reader = spark.readStream.schema(read_table(spark, folder, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
