"""Session risk on a stream: one record when a session is first locked, one when it first crosses the limit."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veilstone.operators.sessions import ROTATION_LIMIT
from veilstone.session import STATE_STORE

OUTPUT = "session_id STRING, reason STRING, request_id BIGINT, ts TIMESTAMP, risk DOUBLE"
#: A session that stays without a trigger so long, in the time of its events, leaves the state.
IDLE_HOURS = 48


class SessionRisk(StatefulProcessor):
    """Keeps what was reported of a session. Triggers come one by one and only the earliest of each kind is kept, so a busy
    session never has to fit in memory. A timer, moved on by every trigger, lets idle sessions go.

    This form takes frames, for `transformWithStateInPandas`. The stream takes rows, see `SessionRiskRows`."""

    def __init__(self, idle_ms: int | None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "locked BOOLEAN, crossed BOOLEAN, timer BIGINT")

    def report(self, triggers: Iterable[tuple]) -> list[tuple]:
        """Of a session's triggers, (reason, ts, request_id, risk), those to tell now."""
        # One read of the state and at most one write: every call to it is a round trip to the state server.
        held = self.state.get()
        locked, crossed, timer = held if held is not None else (False, False, None)
        reported = {"session_locked": locked, "risk_threshold_exceeded": crossed}
        found: dict[str, tuple[tuple, tuple]] = {}
        latest = None
        for trigger in triggers:
            reason, ts, request_id, _ = trigger
            if ts is not None and (latest is None or ts > latest):
                latest = ts
            if not reported[reason]:
                # the earliest by (ts, request_id), what is missing last, the first of equals
                order = (ts is None, ts, request_id is None, request_id)
                if reason not in found or order < found[reason][0]:
                    found[reason] = (order, trigger)
        then = None
        if self.idle_ms is not None and latest is not None:
            then = int(latest.timestamp() * 1_000) + self.idle_ms
        moved = then is not None and (timer is None or then > timer)
        if moved:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(then)
        if held is None or found or moved:
            told = (locked or "session_locked" in found, crossed or "risk_threshold_exceeded" in found)
            self.state.update((*told, then if moved else timer))
        return [trigger for _, trigger in found.values()]

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        fields = ["reason", "ts", "request_id", "risk"]
        frames = (chunk[fields].astype(object).where(chunk[fields].notna(), None) for chunk in rows)
        found = self.report(trigger for frame in frames for trigger in frame.itertuples(index=False, name=None))
        if found:
            yield pd.DataFrame(found, columns=fields).assign(session_id=key[0])[["session_id", "reason", "request_id", "ts", "risk"]]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class SessionRiskRows(SessionRisk):
    """The same on rows, for `transformWithState`: most sessions have a trigger or two, and a frame for them, in and out, takes
    several times as long as all the rest of the step."""

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        for reason, ts, request_id, risk in self.report((r.reason, r.ts, r.request_id, r.risk) for r in rows):
            yield Row(session_id=key[0], reason=reason, request_id=request_id, ts=ts, risk=risk)


def stream_session_state(spark: SparkSession, stream: DataFrame, idle_hours: int | None = IDLE_HOURS, late: str = "10 minutes") -> DataFrame:
    """`stream` has session_id, ts, request_id, risk and the raw threat type as `threat`.

    Only locks and crossings of the limit reach the state. A session that has none for `idle_hours` beyond the watermark is
    forgotten, and reported anew should it come back; with None none is. Turns are counted by `stream_session_counts`. Needs the state
    store `session.STATE_STORE`, which is set here where another one is.
    """
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    locked = F.coalesce(F.col("threat") == "session_locked", F.lit(False))
    over = F.coalesce((F.col("risk") >= ROTATION_LIMIT) & ~F.isnan(F.col("risk").cast("double")), F.lit(False))
    reason = F.when(locked, "session_locked").when(over, "risk_threshold_exceeded")
    risk = F.nanvl(F.col("risk").cast("double"), F.lit(None).cast("double"))  # a lock's risk may be NaN: none
    triggers = stream.select(
        F.col("session_id").cast("string").alias("session_id"), "ts", F.col("request_id").cast("bigint").alias("request_id"),
        risk.alias("risk"), reason.alias("reason"),
    ).where("reason IS NOT NULL")
    if idle_hours is not None:
        triggers = triggers.withWatermark("ts", late)
    return triggers.groupBy("session_id").transformWithState(
        statefulProcessor=SessionRiskRows(idle_hours * 3_600_000 if idle_hours is not None else None),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime" if idle_hours is not None else "None",
    )
