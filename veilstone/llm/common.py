"""What several operators share: the shared work folder, fold membership, gapless numbering."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from `spark.checkpoint.dir`; a local one is made only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def small_batches(spark: SparkSession, rows: int = 2_500) -> None:
    """Bounds what a Python worker holds: a batch of texts is there as Arrow, as strings and as what is made of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Paths that `stored` has written in the innermost open `scratch`.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table that was written for this run only."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `stored` writes inside go when it ends. What is to last must be stored after it."""
    outer, mine = _written.get(), []
    _written.set(mine)
    try:
        yield
    finally:
        _written.set(outer)
        for path in mine:
            removed(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: lineage ends there and lost executors cost nothing."""
    path = work_path(df.sparkSession, name)
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str | Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; NULL for a NULL key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string")) % parts


def is_fold(key: str | Column, parts: int, which: int) -> Column:
    """Whether the key falls in that fold; false for a NULL key."""
    return F.coalesce(fold(key, parts) == which, F.lit(False))


def bounded_sample(df: DataFrame, key: str, bound: int, seed: int = 7) -> DataFrame:
    """All rows if there are at most about `bound`, else as many, chosen by a hash of the key: alike on every run."""
    rows = df.count()
    if rows <= bound:
        return df
    share = bound / rows
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))


def numbered(df: DataFrame, group: str, order: list[str], name: str, rows_per_task: int = 20_000) -> DataFrame:
    """Gapless numbers from 0 in each group. Groups may be few and huge: each is split by a hash into parts that
    are numbered apart, and each part starts where the parts before it end. `df` must be a stored table."""
    parts = max(1, -(-df.count() // rows_per_task))
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sums = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    here = Window.partitionBy(group, "_part").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(here))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_slice"))
    return ranked.join(starts, same).withColumn(name, F.col("_start") + F.col("_rank") - 1).select(*df.columns, name)
