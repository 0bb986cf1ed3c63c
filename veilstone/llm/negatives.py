"""Hard negatives for every anchor and each of its positives, by slots.

The negatives of a positive with score p are the best rows of another label with scores from `LEAST`% to 100% of p. The windows of an
anchor's positives overlap, but their upper limits cut the scores into disjoint slots: slot j holds the scores above the
limit of positive j + 1 and up to that of positive j. A window's best are the best of its slot and all lower ones, so the
best `k` of each slot are enough for all windows: combiners keep them in each task, Spark merges the tasks' lists, and one
descending merge from the lowest slot up answers every window. The lower limit cuts off the end of what is then in order.

Two passes over the same blocks: the first finds the positives, the second fills the slots. Anchors come in blocks of at
most about `ANCHOR_BLOCK` rows and all rows in blocks of at most about `BLOCK`; every block of anchors meets every block of
rows, which is the stated query set against all rows. A task holds one block of either kind, and the scores of `TILE`
anchors; rows are copied once for each block of anchors.

Scores are exact: entries are whole numbers, products run in double precision where all partial sums stay below 2^53, and in
64-bit integers otherwise.

Defined results: rows whose label or vector is NULL, whose vector is empty or holds NULL or non-finite entries, or one whose
scaled value does not fit 32 bits, take no part, nor do vectors of another length than the commonest (of equally common
ones, the longer). A row is told from an anchor by its place, not by its id: repeated rows are rows of their own, and a
copy of the anchor may be its positive. Rows without an id are no anchors, keep their label, may be found, and come last among ties. Ties of
score and id are between copies. Empty tables, anchors without positives and positives without negatives give no rows. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.llm.common import read_table, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST = 80
BLOCK = 65_536
ANCHOR_BLOCK = 16_384
#: Below `BLOCK` rows are still dealt to all cores, but not in smaller lots than this.
SMALLEST = 1_024
#: Anchors whose scores with a block are held at once.
TILE = 64
LAST = np.iinfo(np.int64).max
FOUND = "anchor long, slot int, row long, id long, no_id boolean, score long"

ORACLE = """
    WITH r AS (
        SELECT row_number() OVER () AS r, vec_id,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), s AS (
        SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
               list_dot_product(a.x, b.x)::BIGINT AS score
        FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.r <> b.r
    ), p AS (
        SELECT * FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) <= 5
    ), w AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
        FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
    )
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 5
"""


def usable(rows: DataFrame, ident: str, column: str, label: str) -> DataFrame:
    """`row`, `id`, `no_id`, `label` and `x` of the rows that take part, as a stored table."""
    number = F.transform(column, lambda c: c.cast("double"))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float((1 << 31) // SCALE)))
    rows = rows.where(F.col(label).isNotNull() & (F.size(column) > 0)).where(F.coalesce(F.forall(number, fits), F.lit(False)))
    lengths = rows.groupBy(F.size(column).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths:
        rows = rows.where(F.size(column) == lengths["dims"])
    kept = rows.select(
        F.coalesce(F.col(ident).cast("long"), F.lit(LAST)).alias("id"),
        F.col(ident).isNull().alias("no_id"),
        F.col(label).cast("long").alias("label"),
        F.transform(number, lambda c: F.floor(c * SCALE).cast("int")).alias("x"),
    )
    return stored(kept.withColumn("row", F.monotonically_increasing_id()), "rows")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of whole vectors."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def leading(scores: np.ndarray, held: pd.DataFrame, places: np.ndarray, k: int) -> np.ndarray:
    """Of some places, the `k` with the highest scores, ties by smaller id and rows without an id last."""
    if len(places) > 4 * k:
        edge = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= edge]
    ids, unknown, rows = (held[c].to_numpy()[places] for c in ("id", "no_id", "row"))
    return places[np.lexsort((rows, ids, unknown, -scores[places]))[:k]]


#: Gets an anchor, its scores with a block, which rows have its label, and the block; gives slots and places of rows.
Choose = Callable[[dict, np.ndarray, np.ndarray, pd.DataFrame], list[tuple[int, np.ndarray]]]


def meet(asked: DataFrame, held: DataFrame, choose: Choose) -> DataFrame:
    """What `choose` keeps of each block of rows for each anchor, as `FOUND`."""
    spark, n = held.sparkSession, held.count()
    many = max(-(-n // BLOCK), min(-(-n // SMALLEST), spark.sparkContext.defaultParallelism), 1)
    few = max(1, -(-asked.count() // ANCHOR_BLOCK))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    dealt = lambda parts, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts)).cast("int")
    # new names, so that the two sides share no column of the table they both come from
    left = asked.select(*[F.col(c).alias(c) for c in asked.columns], dealt(few, 1).alias("_a"), every(many).alias("_b"))
    right = held.withColumn("_b", dealt(many, 2)).withColumn("_a", every(few))

    def keep(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        made = []
        if len(anchors) and len(rows):
            points, vectors = np.vstack(anchors["x"].to_list()), np.vstack(rows["x"].to_list())
            labels, places = rows["label"].to_numpy(), rows["row"].to_numpy()
            for at in range(0, len(anchors), TILE):
                tile = anchors.iloc[at : at + TILE].to_dict("records")
                table = products(points[at : at + TILE], vectors)
                for anchor, scores in zip(tile, table, strict=True):
                    same, other = labels == anchor["label"], places != anchor["row"]
                    for slot, best in choose(anchor, scores, same & other, rows):
                        part = rows.iloc[best][["row", "id", "no_id"]]
                        made.append(part.assign(anchor=anchor["row"], slot=slot, score=scores[best]))
        names = [field.split()[0] for field in FOUND.split(", ")]
        return pd.concat(made)[names] if made else pd.DataFrame(columns=names)

    return left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInPandas(keep, FOUND)


def first_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The `k` first rows of each group, which tasks have already cut to as many each; `place` counts from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "no_id", "id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def positives(asked: DataFrame, held: DataFrame, k: int = POSITIVES) -> DataFrame:
    """The nearest other rows with the label of each anchor: `anchor`, `place`, `row`, `id`, `no_id`, `score`."""

    def choose(anchor: dict, scores: np.ndarray, same: np.ndarray, rows: pd.DataFrame) -> list[tuple[int, np.ndarray]]:
        return [(0, leading(scores, rows, np.flatnonzero(same), k))]

    return first_of(meet(asked, held, choose), ["anchor"], k).drop("slot")


def slotted(asked: DataFrame, held: DataFrame, k: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """The best `k` rows of other labels in each slot of the anchors' `limits`, scores of positives in falling order."""

    def choose(anchor: dict, scores: np.ndarray, same: np.ndarray, rows: pd.DataFrame) -> list[tuple[int, np.ndarray]]:
        limits = np.asarray(anchor["limits"], np.int64)
        stranger = rows["label"].to_numpy() != anchor["label"]
        # Python's integers, since a hundred times a score may not fit 64 bits
        floor = -(-int(limits[-1]) * least // 100)
        places = np.flatnonzero(stranger & (scores <= limits[0]) & (scores >= floor))
        slots = np.searchsorted(-limits, -scores[places], side="right") - 1  # limits at or above the score, less one
        return [(int(j), leading(scores, rows, places[slots == j], k)) for j in np.unique(slots)]

    return first_of(meet(asked, held, choose), ["anchor", "slot"], k)


def mined(rows: DataFrame, ident: str, column: str, label: str, every: int, k: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """For each anchor, a row whose id is divisible by `every`, and each of its positives, the first `k` hard negatives."""
    held = usable(rows, ident, column, label)
    asked = held.where(~F.col("no_id") & (F.col("id") % every == 0))
    near = stored(positives(asked, held), "positives")
    # at most POSITIVES entries an anchor, and k for each of its slots
    limits = near.groupBy("anchor").agg(F.sort_array(F.collect_list("score"), asc=False).alias("limits"))
    open_ = asked.join(limits, asked["row"] == limits["anchor"]).drop("anchor")
    kept = slotted(stored(open_, "anchors"), held, k, least)
    entry = F.struct((-F.col("score").cast("decimal(20,0)")).alias("down"), "no_id", "id", "row", "slot", "score")
    merged = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    windows = near.join(merged, "anchor").join(asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    big = lambda c: c.cast("decimal(20,0)")
    inside = F.filter(
        "entries", lambda e: (e["slot"] >= F.col("place") - 1) & (big(F.col("score")) * least <= big(e["score"]) * 100)
    )
    known = lambda unknown, value: F.when(~unknown, value)
    return windows.select(
        "anchor_id",
        known(F.col("no_id"), F.col("id")).alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.posexplode(F.slice(inside, 1, k)).alias("at", "negative"),
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        known(F.col("negative.no_id"), F.col("negative.id")).alias("negative_id"),
        "positive_score",
        F.col("negative.score").alias("negative_score"),
    )


def op13_slot_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth embedding for each of its positives; every seventh label is changed first."""
    rows = read_table(spark, folder, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mined(rows.select("vec_id", "embedding", changed.alias("label")), "vec_id", "embedding", "label", 100)
