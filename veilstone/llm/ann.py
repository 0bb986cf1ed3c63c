"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred on a reference point fitted on a bounded sample, scaled to length one, rotated at random, and kept as
one sign bit per dimension with three scalars: the distance to the centre, how far the code points along the vector,
and the vector's product with the centre. The inner product with a query is estimated from the packed bits and the
scalars; an error bound tells which vectors may still be among the nearest, and only those are ranked anew by exact
products in double precision.

All vectors are indexed and searched. Queries come in blocks of at most `QUERY_BLOCK` rows and candidates in blocks of
`BLOCK`; every block of queries meets every block of candidates, which is the stated query set against all rows. A task
holds one block of either kind. Each block of candidates gives the nearest of each query in it, and Spark ranks those.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite numbers take no part; vectors of another length
than the commonest, neither; a query's own row, known by its place, is no candidate; repeated ids are rows of their own;
ties go to the smaller id; rows without an id may be found, come last among ties, and ask nothing; extra columns are not
read; an empty table gives an empty one. The error bound holds with high probability, not
always: recall against brute force is measured in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.llm.common import bounded_sample, read_table, stored

BLOCK = 8_192
QUERY_BLOCK = 8_192
FIT_ROWS = 10_000
#: Width of the error bound in standard deviations.
BOUND = 3.0
#: Stands for a NULL id, beside a flag.
LAST = (1 << 63) - 1
FOUND = "query_id long, vec_id long, no_id boolean, score double"


def rotation(dims: int, seed: int = 1) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def usable(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose vector can take part, as doubles."""
    v = F.transform(column, lambda x: x.cast("double"))
    ordinary = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.withColumn(column, v).where(F.col(column).isNotNull() & (F.size(column) > 0))
    return rows.where(F.coalesce(ordinary, F.lit(False)) & F.exists(column, lambda x: x != 0))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the centre, product of code and vector, product of vector and centre."""
    away = vectors - centre
    distance = np.linalg.norm(away, axis=1)
    unit = (away / np.where(distance == 0, 1, distance)[:, None]) @ turn
    bits = unit > 0
    along = np.abs(unit).sum(1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), distance, np.where(along == 0, 1, along), vectors @ centre


def estimate(
    codes: tuple[np.ndarray, ...], queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, bound: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated products of all queries with all codes, and the bound on the error of each."""
    packed, distance, along, with_centre = codes
    dims = queries.shape[1]
    signs = np.unpackbits(packed, axis=1, count=dims).astype(np.float32) * 2 - 1
    turned = ((queries - centre) @ turn).astype(np.float32)
    # <o, q> = <q, c> + <o, c> - <c, c> + <o - c, q - c>, and the last is read off the code
    scale = (distance / along / np.sqrt(dims)).astype(np.float32)
    known = (queries @ centre)[:, None] + (with_centre - centre @ centre)[None, :]
    off = bound * np.sqrt(np.maximum(0, 1 - along**2)) / along / np.sqrt(max(1, dims - 1)) * distance
    return known + (turned @ signs.T) * scale, np.linalg.norm(turned, axis=1)[:, None] * off[None, :]


def index(rows: DataFrame, ident: str, column: str, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """The coded vectors as a stored table, and the centre."""
    spark = rows.sparkSession
    # pandas would turn ids beside a NULL into floating numbers
    told = F.coalesce(F.col(ident).cast("long"), F.lit(LAST)).alias("id"), F.col(ident).isNull().alias("no_id")
    rows = usable(rows.select(*told, F.col(column).alias("v")), "v")
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common["dims"] if common else 1
    rows = rows.where(F.size("v") == dims)
    sample = bounded_sample(rows, "id", FIT_ROWS).select("v").toPandas()["v"]
    centre = np.vstack(sample.to_list()).mean(0) if len(sample) else np.zeros(dims)

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(dims, seed)
        for frame in frames:
            if len(frame):
                packed, distance, along, with_centre = encode(np.vstack(frame["v"].to_list()), centre, turn)
                yield frame.assign(code=[p.tobytes() for p in packed], distance=distance, along=along, with_centre=with_centre)

    coded = rows.mapInPandas(code, "id long, no_id boolean, v array<double>, code binary, distance double, along double, with_centre double")
    return stored(coded.withColumn("row", F.monotonically_increasing_id()), "codes"), centre


def nearest(queries: DataFrame, coded: DataFrame, centre: np.ndarray, k: int, bound: float = BOUND, seed: int = 1) -> DataFrame:
    """`query_id`, `rank`, `vec_id` and exact `score` of the `k` nearest of each query. `queries`: rows of the index."""
    blocks = lambda n, size: max(1, -(-n // size))
    many, few = blocks(coded.count(), BLOCK), blocks(queries.count(), QUERY_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("row", "id", "v", F.pmod(F.xxhash64("row"), F.lit(few)).cast("int").alias("_q"), every(many).alias("_b"))
    right = coded.withColumn("_b", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(many)).cast("int")).withColumn("_q", every(few))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame(columns=["query", "query_id", "vec_id", "no_id", "score"])
        vectors, turn = np.vstack(held["v"].to_list()), rotation(len(centre), seed)
        packed = np.frombuffer(b"".join(held["code"]), np.uint8).reshape(len(held), -1)
        codes = (packed, *(held[c].to_numpy() for c in ("distance", "along", "with_centre")))
        rows, ids = held["row"].to_numpy(), held["id"]
        order, unknown = ids.to_numpy(), held["no_id"].to_numpy()
        who, which, scores = [], [], []
        for at in range(0, len(asked), 128):
            part = asked.iloc[at : at + 128]
            points = np.vstack(part["v"].to_list())
            near, off = estimate(codes, points, centre, turn, bound)
            own = part["row"].to_numpy()[:, None] == rows[None, :]
            near[own] = -np.inf
            least = near - off
            keep = min(k, len(held))
            edge = -np.partition(-least, keep - 1, axis=1)[:, keep - 1]
            again = (near + off >= edge[:, None]) & ~own
            for i in range(len(part)):
                open_ = np.flatnonzero(again[i])
                exact = (vectors[open_] * points[i]).sum(1)
                best = np.lexsort((order[open_], unknown[open_], -exact))[:k]
                who.append(np.full(len(best), at + i))
                which.append(open_[best])
                scores.append(exact[best])
        query = asked.iloc[np.concatenate(who)]
        return pd.DataFrame(
            {
                "query": query["row"].array, "query_id": query["id"].array,
                "vec_id": ids.iloc[np.concatenate(which)].array, "no_id": unknown[np.concatenate(which)], "score": np.concatenate(scores),
            }
        )

    pairs = left.groupBy("_q", "_b").cogroup(right.groupBy("_q", "_b")).applyInPandas(search, f"query long, {FOUND}")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "vec_id")
    first = pairs.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return first.select("query_id", "rank", F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score")


def op8_one_bit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    coded, centre = index(read_table(spark, folder, "embeddings"), "vec_id", "embedding")
    return nearest(coded.where("NOT no_id AND id % 20 = 0"), coded, centre, 20)
