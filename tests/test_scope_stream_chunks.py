"""Scope enforcement on a stream holds an agent's actions as arrays and gives results chunk by chunk."""

from __future__ import annotations

import json

import pandas as pd

from veilstone.streaming.scopes import Enforcement


class _State:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


class _Handle:
    def getValueState(self, name, schema):
        return _State()

    def listTimers(self):
        return iter(())

    def registerTimer(self, at):
        pass

    def deleteTimer(self, at):
        pass


def _declaration(us, seq, allowed=None, forbidden=None, seconds=None):
    fields = {"allowed": allowed, "forbidden": forbidden, "seconds": seconds, "renewable": None, "expires": None}
    return {"kind": 0, "us": us, "request_id": seq, "tool": None, "declaration": json.dumps(fields)}


def _action(us, rid, tool):
    return {"kind": 1, "us": us, "request_id": rid, "tool": tool, "declaration": None}


def test_results_leave_per_chunk_and_follow_the_declarations_in_time():
    processor = Enforcement()
    processor.init(_Handle())
    chunks = [
        pd.DataFrame([_action(5, 1, "run"), _action(20, 2, "send"), _action(10, 3, None)]),
        # the declaration comes after the actions that follow it in time; a later one may only narrow
        pd.DataFrame([_declaration(10, 1, ["read", "run"], ["send"], 1), _action(10, 4, "run"), _declaration(15, 2, ["read"])]),
        pd.DataFrame([_action(1_000_020, 5, "read"), _action(12, 6, "run"), _action(16, 7, "run"), _action(3, 8, "send")]),
    ]
    pieces = list(processor.handleInputRows(("a",), iter(chunks), None))
    assert [len(p) for p in pieces] == [3, 1, 4]
    got = {r.request_id: r.hold_reason for p in pieces for r in p.itertuples()}
    assert got == {1: None, 2: "forbidden", 3: "not_allowed", 4: None, 5: "expired", 6: None, 7: "not_allowed", 8: None}
    assert all(list(p.columns) == ["agent_id", "request_id", "tool", "hold_reason", "held_by_scope"] for p in pieces)
    assert [bool(b) for p in pieces for b in p["held_by_scope"]] == [v is not None for v in (None, "f", "n", None, "e", None, "n", None)]
