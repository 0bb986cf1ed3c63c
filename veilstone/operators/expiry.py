"""Deduplication with a time to live: a verdict may be reused until so long after its scan, then the content is scanned anew.

Reads do not extend the time, so which rows are scanned is a chain: the first row of a content, then the first row more
than the time to live after it, and so on. The chain is not walked. Time is cut in slots as long as the time to live, so
a content is scanned once in a slot at most, and what a slot's scan is depends on the slot before only. Every instant
points to the instant that would be scanned next if it were itself a scan; an instant whose slot before is empty, or
that comes after a longer pause, is a scan whatever was before it. From those, pointer doubling finds all others in as many
rounds as the longest busy stretch has binary digits. Everything joins on content and time: no content is worked off in
one task, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilstone.functions.frames import computed_once
from veilstone.session import cut_lineage

#: Seconds that a verdict may be reused.
TIME_TO_LIVE = 300


def _slots(instants: DataFrame, ttl: int) -> DataFrame:
    """The instants with their slot, and of each the instant that is next scanned after it, if it is a scan itself."""
    timed = instants.withColumn("_slot", F.floor(F.col("_us") / ttl))
    slot = ("_hash", "_slot")
    seen = timed.groupBy(*slot).agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    # a row for each slot in which the content occurs: bounded by the time that the table covers, not by its rows
    line = Window.partitionBy("_hash").orderBy("_slot")
    seen = seen.select(
        *slot,
        "_first",
        F.lag("_slot").over(line).alias("_before"),
        F.lag("_last").over(line).alias("_pause_from"),
        *[F.lead(c, n).over(line).alias(f"{c}_{n}") for c in ("_slot", "_first") for n in (1, 2)],
    )
    opens = F.col("_before").isNull() | (F.col("_before") < F.col("_slot") - 1) | (F.col("_first") - F.col("_pause_from") > ttl)
    seen = seen.select("*", opens.alias("_opens"))

    # the ends of life of one slot's instants lie in the next slot: both in one order, latest first, ends before instants
    ends = timed.select("_hash", (F.col("_slot") + 1).alias("_slot"), (F.col("_us") + ttl).alias("_at"), "_us")
    both = ends.unionByName(timed.select(*slot, F.col("_us").alias("_at"), F.lit(None).cast("bigint").alias("_us")))
    after = Window.partitionBy(*slot).orderBy(F.desc("_at"), F.col("_us").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    here = both.withColumn("_next", F.min(F.when(F.col("_us").isNull(), F.col("_at"))).over(after)).where("_us IS NOT NULL")
    near = here.select("_hash", (F.col("_slot") - 1).alias("_slot"), "_us", "_next")
    # where the next slot has nothing late enough, the first instant of the one after it
    far = F.when(F.col("_slot_1") == F.col("_slot") + 1, F.col("_first_2")).otherwise(F.col("_first_1"))
    return near.join(seen, [*slot]).select(
        "_hash", "_us", F.coalesce("_next", far).alias("_next"), (F.col("_opens") & (F.col("_us") == F.col("_first"))).alias("_opens")
    )


def scans(requests: DataFrame, row_id: str, ts: str, key: str, seconds: int = TIME_TO_LIVE) -> DataFrame:
    """The requests that are scanned: `_hash`, `_us` (microseconds) and `_scan`, the smallest id of that instant."""
    ttl = seconds * 1_000_000
    instants = requests.groupBy(F.col(key).alias("_hash"), F.unix_micros(ts).alias("_us")).agg(F.min(row_id).alias("_scan"))
    instants = cut_lineage(instants.where("_hash IS NOT NULL AND _us IS NOT NULL"))
    pointed = cut_lineage(_slots(instants.select("_hash", "_us"), ttl))
    found = pointed.where("_opens").select("_hash", "_us")
    begun = found.withColumn("_root", F.lit(True))
    # a chain ends where the next one begins
    hops = pointed.where("_next IS NOT NULL").join(begun.withColumnRenamed("_us", "_next"), ["_hash", "_next"], "left")
    hops = cut_lineage(hops.where("_root IS NULL").select("_hash", "_us", "_next"))
    while not hops.isEmpty():
        reached = found.join(hops, ["_hash", "_us"]).select("_hash", F.col("_next").alias("_us"))
        grown = cut_lineage(found.unionByName(reached).distinct())
        if grown.count() == found.count():
            break
        onward = hops.select("_hash", F.col("_us").alias("_next"), F.col("_next").alias("_then"))
        hops = cut_lineage(hops.join(onward, ["_hash", "_next"]).select("_hash", "_us", F.col("_then").alias("_next")))
        found = grown
    else:
        grown = found
    return instants.join(grown, ["_hash", "_us"], "left_semi")


def dedup_within(
    requests: DataFrame,
    row_id: str,
    ts: str,
    key: Column,
    content: Sequence[str] = (),
    scan: Callable[[DataFrame], DataFrame] | None = None,
    outputs: Sequence[str] = (),
    seconds: int = TIME_TO_LIVE,
) -> DataFrame:
    """For each request whether it is `scanned`, the request `scan_id` whose verdict it has, and the `outputs` of it.

    `scan` adds the outputs to a table of the scanned requests with their `content`. A request without a time or content
    hash is scanned itself and shares nothing. Requests of one instant share the scan of the smallest id.
    """
    ttl = seconds * 1_000_000
    keyed = computed_once(requests, "content_hash", key).select(row_id, ts, *content, "content_hash")
    made = cut_lineage(scans(keyed, row_id, ts, "content_hash", seconds))
    slot = F.floor(F.col("_us") / ttl)
    by_slot = made.select(F.col("_hash").alias("content_hash"), slot.alias("_slot"), "_us", "_scan")
    placed = keyed.select(row_id, "content_hash", F.unix_micros(ts).alias("_at")).withColumn("_slot", F.floor(F.col("_at") / ttl))
    own = by_slot.select("content_hash", "_slot", F.col("_us").alias("_own_us"), F.col("_scan").alias("_own"))
    past = by_slot.select("content_hash", (F.col("_slot") + 1).alias("_slot"), F.col("_scan").alias("_past"))
    met = placed.join(own, ["content_hash", "_slot"], "left").join(past, ["content_hash", "_slot"], "left")
    scan_id = F.coalesce(F.when(F.col("_own_us") <= F.col("_at"), F.col("_own")), F.col("_past"), F.col(row_id))
    told = met.select(row_id, "content_hash", scan_id.alias("scan_id"), (scan_id == F.col(row_id)).alias("scanned"))
    if scan is None:
        return told
    # the scanned rows with their content: joined on their id, which is unique
    first = keyed.join(told.where("scanned").select(row_id), row_id, "left_semi").select(row_id, *content)
    verdicts = scan(first).select(F.col(row_id).alias("scan_id"), *outputs)
    return told.join(verdicts, "scan_id", "left").select(row_id, "content_hash", "scan_id", "scanned", *outputs)


def expiry_stats(deduplicated: DataFrame) -> DataFrame:
    """Hits, misses and hit rate of a cache with that time to live."""
    total = deduplicated.agg(F.count_if(~F.col("scanned")).alias("hits"), F.count_if("scanned").alias("misses"))
    asked = F.col("hits") + F.col("misses")
    return total.select("hits", "misses", F.when(asked > 0, F.col("hits") / asked).otherwise(F.lit(0.0)).alias("hit_rate"))
