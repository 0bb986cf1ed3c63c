"""The session stream's step on rows: the same earliest triggers as on frames, without a frame per session."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Row

from veilstone.sources.sinks import run_stream
from veilstone.streaming import sessions

LOCKED, OVER = "session_locked", "risk_threshold_exceeded"


class _State:
    def __init__(self, calls):
        self.calls, self.value = calls, None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value


class _Handle:
    def __init__(self):
        self.calls = []

    def getValueState(self, name, schema):
        return _State(self.calls)

    def registerTimer(self, at):
        self.calls.append("register")

    def deleteTimer(self, at):
        self.calls.append("delete")


def _at(hour):
    return datetime(2024, 1, 1, hour, tzinfo=timezone.utc)


def _rows(*rows):
    return (Row(session_id="s", reason=reason, ts=ts, request_id=i, risk=risk) for reason, ts, i, risk in rows)


def _processor():
    processor, handle = sessions.SessionRiskRows(48 * 3_600_000), _Handle()
    processor.init(handle)
    return processor, handle


def test_rows_give_the_earliest_trigger_of_each_reason():
    processor, handle = _processor()
    rows = [(OVER, _at(5), 9, 0.9), (LOCKED, _at(3), 7, None), (OVER, _at(3), None, 0.8), (OVER, None, 1, 0.8), (OVER, _at(3), 4, 0.75), (OVER, _at(3), 4, 0.99)]
    got = list(processor.handleInputRows(("s",), _rows(*rows), None))
    assert all(isinstance(r, Row) for r in got)
    assert sorted(tuple(r.asDict().values()) for r in got) == [("s", OVER, 4, _at(3), 0.75), ("s", LOCKED, 7, _at(3), None)]
    assert handle.calls == ["get", "register", "update"] and processor.state.value[:2] == (True, True)
    assert processor.state.value[2] == int((_at(5) + timedelta(hours=48)).timestamp() * 1_000)
    # an earlier one tells nothing new and moves no timer, so that the state is only read; a later one moves the timer on
    handle.calls.clear()
    assert list(processor.handleInputRows(("s",), _rows((OVER, _at(1), 0, 0.9)), None)) == [] and handle.calls == ["get"]
    assert list(processor.handleInputRows(("s",), _rows((OVER, _at(6), 0, 0.9)), None)) == []
    assert handle.calls == ["get", "get", "delete", "register", "update"]


def test_frames_with_missing_values_tell_the_same():
    processor = sessions.SessionRisk(None)
    processor.init(_Handle())
    at = datetime(2024, 1, 1, 3)
    chunk = pd.DataFrame([("s", None, 1, 0.8, OVER), ("s", at, None, 0.9, OVER), ("s", at, 5, 0.7, OVER)], columns=["session_id", "ts", "request_id", "risk", "reason"])
    out = pd.concat(processor.handleInputRows(("s",), iter([chunk]), None))
    assert [(r.session_id, r.reason, r.request_id, r.ts, r.risk) for r in out.itertuples()] == [("s", OVER, 5, at, 0.7)]


def test_ids_and_times_come_through_the_stream_as_they_are(spark, tmp_path):
    """Long ids beside missing ones, missing sessions, and a zone that is not UTC. Frames made such ids floats."""
    schema = "session_id string, ts timestamp, request_id bigint, risk double, threat string"
    start = datetime(2024, 3, 10, 6, 30, 0, 123456, tzinfo=timezone.utc)
    rows = [(f"s{i % 3}" if i % 7 else None, start + timedelta(minutes=i), 2**60 + i, 0.7 + i / 100, "x") for i in range(21)]
    rows += [("s1", start, 5, None, LOCKED), ("s1", start, 3, float("nan"), LOCKED), ("s2", start, None, 0.9, LOCKED), ("s9", start, 4, float("nan"), "x")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        found = run_stream(spark, sessions.stream_session_state(spark, stream), "t-rows").selectExpr("session_id", "reason", "request_id", "unix_micros(ts) AS us", "risk").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    us = lambda t: (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    want = {(s, OVER): min(r for r in rows if r[0] == s and r[4] == "x" and r[0] != "s9") for s in ("s0", "s1", "s2")}
    want[None, OVER] = rows[0]
    got = {(r["session_id"], r["reason"]): (r["request_id"], r["us"], r["risk"]) for r in found}
    assert len(found) == len(got) and got == {
        **{k: (r[2], us(r[1]), r[3]) for k, r in want.items()},
        ("s1", LOCKED): (3, us(start), None),
        ("s2", LOCKED): (None, us(start), 0.9),
    }
