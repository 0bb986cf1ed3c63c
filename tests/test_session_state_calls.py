"""The session stream's per-key step: the same earliest triggers, one read of the state per key."""

from __future__ import annotations

from datetime import datetime

import pandas as pd

from veilstone.streaming.sessions import SessionRisk


class _State:
    def __init__(self, calls):
        self.calls, self.value = calls, None

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

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


def _chunk(rows):
    return pd.DataFrame(rows, columns=["session_id", "ts", "request_id", "risk", "reason"])


def test_earliest_trigger_of_each_reason_with_one_state_read():
    processor, handle = SessionRisk(48 * 3_600_000), _Handle()
    processor.init(handle)
    at = lambda h: datetime(2024, 1, 1, h)
    chunks = [
        _chunk([("s", at(5), 9, 0.9, "risk_threshold_exceeded"), ("s", at(3), 7, None, "session_locked"), ("s", at(3), 4, 0.8, "risk_threshold_exceeded")]),
        _chunk([("s", at(3), 2, 0.95, "risk_threshold_exceeded"), ("s", at(3), 8, None, "session_locked"), ("s", at(9), 1, 0.7, "risk_threshold_exceeded")]),
    ]
    out = pd.concat(processor.handleInputRows(("s",), iter(chunks), None))
    got = sorted((r.reason, r.request_id, r.ts) for r in out.itertuples())
    assert got == [("risk_threshold_exceeded", 2, at(3)), ("session_locked", 7, at(3))]
    assert list(out.columns) == ["session_id", "reason", "request_id", "ts", "risk"] and set(out["session_id"]) == {"s"}
    assert handle.calls == ["get", "register", "update"]
    # reported once: later triggers of the same session give nothing
    handle.calls.clear()
    assert list(processor.handleInputRows(("s",), iter([_chunk([("s", at(1), 0, 0.9, "risk_threshold_exceeded")])]), None)) == []
    assert handle.calls.count("get") == 1 and "exists" not in handle.calls
