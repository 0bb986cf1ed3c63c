"""Reliability of the scan service as its call log shows it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.functions.dims import rate_tiers
from veilstone.functions.frames import Running, hours, running

FAILURE_LIMIT = 5


def classify_outcome(status: Column, decoded: Column | None = None) -> Column:
    """ok, retryable (server or transport error, or an answer that could not be read) or final."""
    readable = F.lit(True) if decoded is None else F.coalesce(decoded, F.lit(False))
    return (
        F.when(status.isNull() | (status >= 500), "retryable")
        .when(status != 200, "final")
        .when(readable, "ok")
        .otherwise("retryable")
    )


def failure_runs(
    calls: DataFrame, keys: Sequence[str], order: Sequence[str], ok: Column, limit: int = FAILURE_LIMIT
) -> DataFrame:
    """Runs of failures in a row per endpoint: first, last, length, and whether the run reached the limit.

    A run is named by the number of successes before it. There are few endpoints, each with a large share of all
    calls, so successes are counted bucket by bucket and runs are folded by partial aggregation.
    """
    good = F.coalesce(ok, F.lit(False))
    numbered = running(
        calls.withColumn("_ok", good), keys, order, hours(F.col(order[0])),
        {"run": Running("sum", F.col("_ok").cast("bigint"))},
    )
    at = F.struct(*order)
    return (
        numbered.where(~F.col("_ok"))
        .groupBy(*keys, "run")
        .agg(F.count(F.lit(1)).alias("failures"), F.min(at).alias("first"), F.max(at).alias("last"))
        .withColumn("tripped", F.col("failures") >= limit)
    )


def degraded_rate(
    verdicts: DataFrame, ts: str, degraded: str, length: str = "1 hour", slide: str | None = None
) -> DataFrame:
    """Share of requests let through without a scan, per window; also runs on a stream with a watermark."""
    frame = F.window(ts, length, slide) if slide else F.window(ts, length)
    counted = verdicts.groupBy(frame.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(degraded).alias("n_degraded")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), "n", "n_degraded", (F.col("n_degraded") / F.col("n")).alias("rate")
    )


def calls_per_window(calls: DataFrame, ts: str, user: str, period: str) -> DataFrame:
    """Calls of each customer per minute or calendar month; minutes also run on a stream with a watermark."""
    if period == "minute":
        counted = calls.groupBy(user, F.window(ts, "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("calls"))
        return counted.select(user, F.col("w.start").alias("slot"), "calls")
    if period == "month":
        return calls.groupBy(user, F.date_trunc("month", ts).alias("slot")).agg(F.count(F.lit(1)).alias("calls"))
    raise ValueError(f"unknown period {period}")


def rate_limit_audit(
    calls: DataFrame, customers: DataFrame, ts: str = "ts", user: str = "user_id", tiers: DataFrame | None = None
) -> DataFrame:
    """Per customer and period: windows used, the fullest one, and windows above the tier's limit.

    `customers` gives the tier of each user. Calls shrink to one row per customer before any join. Users without a known
    tier are shown with a NULL tier; no window of theirs can be over a limit.
    """
    limits = tiers if tiers is not None else rate_tiers(calls.sparkSession)
    tiered = customers.join(limits, "tier", "left")
    found = []
    for period, column in (("minute", "per_minute"), ("month", "per_month")):
        counted = calls_per_window(calls, ts, user, period)
        limited = counted.join(tiered.select(user, "tier", F.col(column).alias("limit")), user, "left")
        found.append(
            limited.groupBy(user, "tier").agg(
                F.count(F.lit(1)).alias("windows"),
                F.max("calls").alias("max_calls"),
                F.count_if(F.col("calls") > F.col("limit")).alias("windows_over"),
            ).withColumn("period", F.lit(period))
        )
    return found[0].unionByName(found[1])
