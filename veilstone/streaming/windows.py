"""Windowed reports and deduplication on streams. Late rows fall to the watermark."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veilstone.operators import reliability
from veilstone.operators.expiry import TIME_TO_LIVE
from veilstone.session import STATE_STORE


def stream_degraded_rate(
    stream: DataFrame, ts: str, degraded: str, late: str = "10 minutes", length: str = "1 hour", slide: str | None = None
) -> DataFrame:
    """Share let through without a scan, per closed window."""
    return reliability.degraded_rate(stream.withWatermark(ts, late), ts, degraded, length, slide)


def stream_calls_per_minute(stream: DataFrame, ts: str, user: str, late: str = "10 minutes") -> DataFrame:
    """Calls of each customer per closed minute; join the result to the tiers to find who is over the limit."""
    return reliability.calls_per_window(stream.withWatermark(ts, late), ts, user, "minute")


def stream_session_counts(stream: DataFrame, ts: str, session: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Actions per stretch of activity of a session; a stretch ends after a pause of `gap`."""
    stretch = F.session_window(ts, gap).alias("w")
    counted = stream.withWatermark(ts, late).groupBy(session, stretch).agg(F.count(F.lit(1)).alias("actions"))
    return counted.select(session, F.col("w.start").alias("stretch_start"), F.col("w.end").alias("stretch_end"), "actions")


def stream_dedup(stream: DataFrame, ts: str, key: str, ttl: str = "5 minutes") -> DataFrame:
    """First request of each content within the time to live; the others may reuse its verdict.

    The time counts from the first request and reads do not extend it. A content never passes twice within `ttl`. It
    passes again once the watermark, which moves between batches, has cleared its state; within one batch a content
    passes once whatever its age.
    """
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])


class LastScan(StatefulProcessor):
    """Keeps the last scan of each content. A timer at its end of life lets the state go; a batch's rows are taken in the
    order of time, so a busy content is sorted as a whole once a batch."""

    OUTPUT = "id BIGINT, content_hash STRING, scan_id BIGINT, scanned BOOLEAN"

    def __init__(self, seconds: int) -> None:
        self.life = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us BIGINT, id BIGINT")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        at, scan = self.last.get() if self.last.exists() else (None, None)
        before = at
        given = pd.concat(list(rows)).sort_values(["us", "id"])
        scans = []
        for us, row in zip(given["us"].tolist(), given["id"].tolist(), strict=True):
            if at is None or us - at > self.life:
                at, scan = us, row
            scans.append(scan)
        if at != before:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((at + self.life) // 1_000 + 1)
            self.last.update((at, scan))
        out = pd.DataFrame({"id": given["id"].to_numpy(), "content_hash": key[0], "scan_id": scans})
        yield out.assign(scanned=out["id"] == out["scan_id"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_dedup_within(
    spark: SparkSession, stream: DataFrame, row_id: str, ts: str, key: str, seconds: int = TIME_TO_LIVE, late: str = "10 minutes"
) -> DataFrame:
    """Every request with the one whose verdict it has, as `expiry.dedup_within` tells, at any split into batches that
    follow time. Requests that come later than a scan of a later time share that scan; those beyond `late` are dropped.
    Needs the state store `session.STATE_STORE`, which is set here where another one is."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    narrow = stream.select(
        F.col(row_id).cast("bigint").alias("id"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("us"), F.col(key).cast("string").alias("content_hash")
    )
    return (
        narrow.withWatermark("ts", late)
        .groupBy("content_hash")
        .transformWithStateInPandas(statefulProcessor=LastScan(seconds), outputStructType=LastScan.OUTPUT, outputMode="Append", timeMode="EventTime")
    )
