"""Whitening of embeddings with distributed block matrices.

Entries become whole numbers, so that sums are exact: x = floor(64 c) + 1000000. Rows are numbered without gaps, centred
exactly before anything is multiplied (n x - S in whole numbers, then divided by n), and laid out as a Spark MLlib
BlockMatrix. Its transpose times itself is the scatter; the middle dimension is split, so that no task multiplies more
than a share of the blocks though the product is one small matrix. The covariance, dimensions times dimensions, goes to the driver for
`numpy.linalg.eigh`; the whitening matrix comes back as a block, and a second block product projects all rows. All of it
runs in the JVM: rows do not pass through Python.

Defined results: rows whose vector is NULL, empty, or holds NULL or non-finite entries take no part, nor do vectors of
another length than the commonest (of equally common ones, the longer); repeated rows and rows without an id count and come
out as rows of their own; components come by falling eigenvalue, equal ones in the order that `eigh` gives them; components
without any variance cannot be scaled to it and are left out (`FLAT`); an empty table gives an empty one. Extra columns are not read. An
entry times 64 must fit a long, else the cast is an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.llm.common import read_table, stored

STEP = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Rows and columns of a block, and the blocks that a task multiplies.
BLOCK_ROWS = 4_096
BLOCK_COLUMNS = 1_024
BLOCKS_PER_TASK = 8
#: Components with less than this share of the variance are rounding, not variance.
FLAT = 1e-13
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole(rows: DataFrame, ident: str, column: str) -> DataFrame:
    """`id` and `x`, whole numbers, of the rows that can take part, all of one length."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    v = F.transform(column, lambda c: c.cast("double"))
    rows = rows.select(F.col(ident).alias("id"), v.alias("v")).where(F.size(column) > 0)
    rows = rows.where(F.coalesce(F.forall("v", finite), F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths:
        rows = rows.where(F.size("v") == lengths["dims"])
    return rows.select("id", F.transform("v", lambda c: F.floor(c * STEP).cast("long") + OFFSET).alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """Adds `row`, gapless from 0: places within the parts of a stored table, each part going on where the last one ended.
    What is broadcast has a row for each part."""
    placed = stored(rows.withColumn("place", F.monotonically_increasing_id()), "placed")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return placed.withColumn("part", part).join(F.broadcast(starts), "part").select("id", "x", (F.col("start") + within).alias("row"))


def blocks(rows: DataFrame, n: int, dims: int) -> BlockMatrix:
    """`row` and `v`, doubles, as blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("row", array_to_vector("v").alias("v")), "v")
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(BLOCK_ROWS, min(dims, BLOCK_COLUMNS))


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """A block product whose middle dimension is split among tasks, which the Python method has no argument for."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times matrix, dimensions times dimensions."""
    splits = max(1, n // (BLOCK_ROWS * BLOCKS_PER_TASK))
    return product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """`row` and `v` of a block matrix as a DataFrame, without a way through Python."""
    found = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = MLUtils.convertVectorColumnsToML(found, "vector")
    return found.select(F.col("index").alias("row"), vector_to_array("vector").alias("v"))


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; the ones with no variance left out."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > FLAT * max(np.trace(covariance), 0)]
    return values[order], vectors[:, order]


def whitened(rows: DataFrame, ident: str, column: str, most: int = COMPONENTS) -> DataFrame:
    """`id`, `n`, `deviation`, `whitened` (array, one number a component), `explained` (array) and `identity_error`."""
    spark = rows.sparkSession
    x = stored(numbered(whole(rows, ident, column)), "whole")
    first = x.first()
    dims = len(first["x"]) if first else 0
    total = x.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(dims)]).first()
    n, sums = total["n"], [total[f"s{i}"] for i in range(dims)]
    if n == 0:
        return spark.createDataFrame([], "id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    away = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in sums]), lambda a, s: a * F.lit(n).cast("long") - s)
    centred = x.select("id", "row", away.alias("away"))
    exact = F.aggregate("away", F.lit(0).cast("decimal(38,0)"), lambda t, a: (t + a.cast("decimal(19,0)") * a.cast("decimal(19,0)")).cast("decimal(38,0)"))
    centred = stored(
        centred.select("id", "row", exact.cast("long").alias("deviation"), F.transform("away", lambda a: a.cast("double") / n).alias("v")), "centred"
    )
    matrix = blocks(centred, n, dims).cache()
    covariance = scatter(matrix, n) / n
    values, vectors = components(covariance, most)
    kept = len(values)
    if kept == 0:
        matrix.blocks.unpersist()
        return centred.select("id", F.lit(n).cast("long").alias("n"), "deviation", F.expr("array()").cast("array<double>").alias("whitened"),
                              F.expr("array()").cast("array<double>").alias("explained"), F.lit(None).cast("double").alias("identity_error"))
    turn = vectors / np.sqrt(values)
    width = min(dims, BLOCK_COLUMNS)
    pieces = [((i, 0), Matrices.dense(*turn[at : at + width].shape, turn[at : at + width].ravel("F"))) for i, at in enumerate(range(0, dims, width))]
    whitening = BlockMatrix(spark.sparkContext.parallelize(pieces), width, kept, dims, kept)
    projected = stored(rows_of(product(matrix, whitening)), "projected")
    matrix.blocks.unpersist()

    means = projected.agg(*[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(kept)]).first()
    level = F.zip_with("v", F.array(*[F.lit(means[f"m{i}"]) for i in range(kept)]), lambda a, m: a - m)
    again = scatter(blocks(projected.select("row", level.alias("v")), n, kept), n) / n
    error = float(np.abs(again - np.eye(kept)).max())
    share = [float(e / np.trace(covariance)) for e in values]
    return centred.select("id", "row", "deviation").join(projected, "row").select(
        "id", F.lit(n).cast("long").alias("n"), "deviation", F.col("v").alias("whitened"),
        F.array(*[F.lit(s) for s in share]).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op12_block_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The whitened components of every embedding, one a row."""
    made = whitened(read_table(spark, folder, "embeddings"), "vec_id", "embedding")
    long = made.select("*", F.posexplode("whitened").alias("at", "value"))
    return long.select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.col("explained")[F.col("at")].alias("explained"),
        "identity_error",
    )
