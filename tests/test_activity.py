from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilstone.functions.frames import Running, hours, running
from veilstone.operators import reliability, scopes, sessions

T0 = datetime(2024, 1, 1)


def _rotate(spark, threat, risk, session, own):
    table = spark.createDataFrame([(1, threat, risk, session, own)], "id int, threat string, risk double, session string, own string")
    row = sessions.evaluate_rotation(table, "id", "threat", "risk", "session", "own")
    return row.select("rotation", sessions.is_locked(F.col("rotation")).alias("locked"), sessions.rotation_next_id(F.col("rotation")).alias("next")).first()


@pytest.mark.parametrize("risk", [0.5, None, float("nan")])
def test_no_rotation(spark, risk):
    row = _rotate(spark, "sqli", risk, "m", "m")
    assert row["rotation"] is None and not row["locked"] and row["next"] is None


def test_own_session_is_rotated_and_a_foreign_one_advised(spark):
    own = _rotate(spark, None, 0.7, "m", "m")["rotation"]
    assert own["rotated"] and own["owner"] == "sdk_client" and own["previous_session_id"] == "m" and own["new_session_id"]
    row = _rotate(spark, None, 0.95, "c", "m")
    assert row["rotation"]["rotation_recommended"] and not row["rotation"]["rotated"] and row["rotation"]["owner"] == "caller"
    assert row["next"] == row["rotation"]["suggested_new_session_id"] and row["rotation"]["current_session_id"] == "c"


@pytest.mark.parametrize(("risk", "session", "owner"), [(None, "m", "sdk_client"), (0.95, "m", "sdk_client"), (0.95, "c", "caller")])
def test_a_lock_comes_first_and_offers_no_id(spark, risk, session, owner):
    row = _rotate(spark, "session_locked", risk, session, "m")
    assert row["locked"] and row["next"] is None
    assert row["rotation"]["owner"] == owner and row["rotation"]["triggering_risk_score"] == risk


def _history(n: int, keys: int) -> list[tuple]:
    rng = random.Random(3)
    # Key 0 holds most rows: it must not end up in one task, and results must not change for it.
    return [
        (0 if rng.random() < 0.7 else rng.randrange(keys), T0 + timedelta(minutes=rng.randrange(3000)), i, rng.choice([None, 1, 2, 9]))
        for i in range(n)
    ]


def test_running_values_match_a_plain_loop(spark):
    rows = _history(600, 5)
    table = spark.createDataFrame(rows, "k int, ts timestamp, id int, v int")
    spec = {
        "n": Running("count"), "total": Running("sum", F.col("v"), before=True), "top": Running("max", F.col("v")),
        "latest": Running("last", F.col("v"), before=True), "rare": Running("last", F.col("v"), sparse=True), "opening": Running("first", F.col("v")),
    }
    got = {r["id"]: r for r in running(table, ["k"], ["ts", "id"], hours(F.col("ts")), spec).collect()}
    assert len(got) == 600
    seen: dict[int, list] = {}
    for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        before = [x for x in seen.get(k, []) if x is not None]
        upto = [x for x in (*before, v) if x is not None]
        assert got[i]["n"] == len(seen.get(k, [])) + 1
        assert got[i]["total"] == sum(before)
        assert got[i]["top"] == (max(upto) if upto else None)
        assert got[i]["rare"] == (upto[-1] if upto else None)
        assert got[i]["latest"] == (before[-1] if before else None)
        seen.setdefault(k, []).append(v)
        assert got[i]["opening"] == seen[k][0]


def test_turns_count_per_user_session_and_agent(spark):
    rows = [(1, "a", "x", T0, 1, 0.2), (1, "a", "x", T0 + timedelta(hours=5), 2, 0.1), (1, "b", "x", T0 + timedelta(hours=6), 3, 0.0), (1, "a", "y", T0, 4, 0.3)]
    table = spark.createDataFrame(rows, "user_id int, session_id string, agent_id string, ts timestamp, request_id int, risk double")
    got = {r["request_id"]: (r["turn"], r["max_risk"], r["previous_risk"]) for r in sessions.session_timeline(table).collect()}
    assert got == {1: (1, 0.2, None), 2: (2, 0.2, 0.2), 3: (1, 0.0, None), 4: (1, 0.3, None)}


def test_holds_stay_in_their_session(spark):
    rows = [(1, "a", T0, 1, True), (1, "a", T0 + timedelta(hours=2), 2, False), (1, "b", T0 + timedelta(hours=3), 3, False)]
    table = spark.createDataFrame(rows, "user_id int, session_id string, ts timestamp, request_id int, blocked boolean")
    got = sessions.post_refusal_holds(table, ("user_id", "session_id")).collect()
    assert [(r["request_id"], r["refusal_id"], r["seconds_since_refusal"], r["refusals_before"]) for r in got] == [(2, 1, 7200, 1)]


NULLED = [(1, "a", None, T0 + timedelta(minutes=40 * i) if i else None, i, 0.1 * i, i == 1) for i in range(6)]
NULLED_SCHEMA = "user_id int, session_id string, agent_id string, ts timestamp, request_id int, risk double, blocked boolean"


def test_null_keys_and_times_keep_their_running_values(spark):
    table = spark.createDataFrame(NULLED, NULLED_SCHEMA)
    got = sessions.session_timeline(table).orderBy("request_id").collect()
    assert [r["turn"] for r in got] == [1, 2, 3, 4, 5, 6]
    assert [r["max_risk"] for r in got] == pytest.approx([0.1 * i for i in range(6)])
    assert [r["previous_risk"] for r in got][1:] == pytest.approx([0.1 * i for i in range(5)])
    held = sessions.post_refusal_holds(table, ("user_id", "session_id", "agent_id")).collect()
    assert sorted(r["request_id"] for r in held) == [2, 3, 4, 5]


def test_null_endpoints_have_runs_too(spark):
    rows = [(None, T0 + timedelta(minutes=40 * i), i, i == 2) for i in range(6)]
    table = spark.createDataFrame(rows, "endpoint string, ts timestamp, id int, ok boolean")
    found = reliability.failure_runs(table, ["endpoint"], ["ts", "id"], F.col("ok")).orderBy("first").collect()
    assert [(r["failures"], r["first"]["id"], r["last"]["id"]) for r in found] == [(2, 0, 1), (3, 3, 5)]


def test_users_without_a_tier_are_audited(spark):
    calls = spark.createDataFrame([(1, T0), (1, T0), (2, T0)], "user_id int, ts timestamp")
    customers = spark.createDataFrame([(1, "community")], "user_id int, tier string")
    got = {(r["user_id"], r["tier"], r["period"], r["max_calls"], r["windows_over"]) for r in reliability.rate_limit_audit(calls, customers).collect()}
    assert got == {(1, "community", p, 2, 0) for p in ("minute", "month")} | {(2, None, p, 1, 0) for p in ("minute", "month")}


def test_a_risk_that_is_no_number_triggers_nothing(spark):
    table = spark.createDataFrame([("a", T0, 1, float("nan"), "x"), ("b", T0, 2, 0.9, "x")], "session_id string, ts timestamp, request_id int, risk double, threat string")
    assert [r["session_id"] for r in sessions.session_triggers(table).collect()] == ["b"]


def _runs(spark, marks, limit=3):
    rows = [("e", T0 + timedelta(minutes=40 * i), i, m == "s") for i, m in enumerate(marks)]
    table = spark.createDataFrame(rows, "endpoint string, ts timestamp, id int, ok boolean")
    found = reliability.failure_runs(table, ["endpoint"], ["ts", "id"], F.col("ok"), limit).orderBy("first").collect()
    return [(r["failures"], r["first"]["id"], r["last"]["id"], r["tripped"]) for r in found]


def test_failure_runs(spark):
    assert _runs(spark, "fff") == [(3, 0, 2, True)]
    assert _runs(spark, "ffsff") == [(2, 0, 1, False), (2, 3, 4, False)]
    assert _runs(spark, "sss") == []


def test_outcomes(spark):
    table = spark.createDataFrame([(200, True), (200, False), (401, None), (500, None), (None, None)], "status int, decoded boolean")
    got = [r[0] for r in table.select(reliability.classify_outcome(F.col("status"), F.col("decoded"))).collect()]
    assert got == ["ok", "retryable", "final", "retryable", "retryable"]


SCOPE = "agent_id string, declared_at timestamp, seq int, allowed_tools array<string>, forbidden_tools array<string>, purpose string, max_duration_seconds int, expires_at timestamp, renewable_seconds int"


def _declare(spark, *rows):
    return spark.createDataFrame([("a", T0 + timedelta(hours=h), i, al, fo, pu, mx, None, rn) for i, (h, al, fo, pu, mx, rn) in enumerate(rows)], SCOPE)


def test_refresh_inherits_and_empty_is_not_unset(spark):
    table = _declare(spark, (0, ["read_file"], None, "p", 60, 86400), (1, None, ["x"], None, 7200, 5), (30, [], None, None, None, None))
    got = scopes.scope_merge(table).orderBy("seq").collect()
    assert [r["allowed_tools"] for r in got] == [["read_file"], ["read_file"], []]
    assert [r["forbidden_tools"] for r in got] == [None, ["x"], ["x"]]
    assert [r["max_duration_seconds"] for r in got] == [60, 7200, 7200]
    assert {r["renewable_seconds"] for r in got} == {86400} and {r["purpose"] for r in got} == {"p"}


def test_refused_declarations_leave_no_trace(spark):
    table = _declare(
        spark, (0, ["*"], None, "p", None, 7200), (0.5, ["a", "b"], None, None, None, None), (0.6, ["a", "b", "c"], None, "no", None, None),
        (0.7, ["b", "a"], ["z"], None, None, None), (0.8, ["a"], [], None, None, None), (0.9, ["*"], None, None, None, None),
        (1, ["a"], None, None, 9, None), (1.1, ["a", "b"], ["z"], None, None, None), (3, [], None, "late", None, None),
    )
    got = [r["status"] for r in scopes.scope_change_check(table).orderBy("seq").collect()]
    assert got == ["declared", "accepted", "widening", "accepted", "widening", "widening", "accepted", "widening", "ceiling_reached"]
    last = scopes.scope_history(table).orderBy("seq").collect()[-1]
    assert (last["allowed_tools"], last["forbidden_tools"], last["purpose"], last["max_duration_seconds"]) == (["a"], ["z"], "p", 9)


def test_scope_check_matches_a_sequential_walk(spark):
    rng = random.Random(5)
    tools = ["a", "b", "c", "d"]

    def some():
        return rng.choice([None, [], ["*"], *[sorted(rng.sample(tools, rng.randint(1, 4))) for _ in range(6)]])

    rows = [(f"g{g}", T0 + timedelta(hours=i), i, ["*"] if i == 0 else some(), rng.choice([None, ["a"], []]), None, None, None, 150_000 if g % 2 and i == 0 else None) for g in range(12) for i in range(60)]
    got = {(r["agent_id"], r["seq"]): r["status"] for r in scopes.scope_change_check(spark.createDataFrame(rows, SCOPE)).collect()}
    state: dict[str, tuple] = {}
    for agent, at, seq, allowed, forbidden, _, _, _, renewable in rows:
        if seq == 0:
            state[agent] = (set(allowed or []), set(forbidden or []), at + timedelta(seconds=renewable) if renewable else None)
            want = "declared"
        else:
            has, bars, ceiling = state[agent]
            fits = (allowed is None or "*" in has or set(allowed) <= has) and (forbidden is None or bars <= set(forbidden))
            want = "ceiling_reached" if ceiling and at > ceiling else "accepted" if fits else "widening"
            if want == "accepted":
                state[agent] = (has if allowed is None else set(allowed), bars if forbidden is None else set(forbidden), ceiling)
        assert got[(agent, seq)] == want, (agent, seq)


def test_enforcement(spark):
    history = scopes.scope_history(_declare(spark, (1, ["read", "write"], ["write"], None, 7200, None)))
    acts = [(0.5, "send", "allow", False), (1.5, "read", "allow", False), (1.6, "write", "allow", False), (1.7, "send", "block", True), (1.8, "send", "require_approval", True), (4, "read", "warn", False)]
    table = spark.createDataFrame([("a", T0 + timedelta(hours=h), i, t, ac, b) for i, (h, t, ac, b) in enumerate(acts)], "agent_id string, ts timestamp, request_id bigint, tool string, action string, blocked boolean")
    got = {r["request_id"]: (r["hold_reason"], r["action"], r["content_action"]) for r in scopes.scope_enforce(table, history).collect()}
    assert got == {
        0: (None, "allow", None), 1: (None, "allow", None), 2: ("forbidden", "require_approval", "allow"), 3: ("not_allowed", "block", None),
        4: ("not_allowed", "require_approval", "require_approval"), 5: ("expired", "require_approval", "warn"),
    }
    limited = scopes.scope_enforce(table.withColumn("tool", F.lit("read")), history.withColumn("most", F.lit(2)), "most")
    assert {r["request_id"]: r["hold_reason"] for r in limited.collect()} == {0: None, 1: None, 2: None, 3: "action_limit", 4: "action_limit", 5: "expired"}


def test_roots_of_chains_of_adopted_sessions(spark):
    chains = {f"c{c}-{i}": f"c{c}-{i - 1}" for c, n in enumerate([1, 2, 37, 64]) for i in range(1, n)}
    chains |= {f"fan{i}": "c2-3" for i in range(50)}
    table = spark.createDataFrame(list(chains.items()), "session_id string, previous_session_id string")

    def root(s, hops=0):
        return root(chains[s], hops + 1) if s in chains else (s, hops)

    got = {r["session"]: (r["root"], r["hops"]) for r in sessions.root_sessions(table).collect()}
    assert got == {s: root(s) for s in chains}
    assert sessions.root_sessions(table.where("false")).collect() == []
    with pytest.raises(ValueError, match="circle"):
        sessions.root_sessions(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], table.schema)).collect()


def test_state_of_a_chain_tells_locks_and_rotations(spark):
    rows = [
        ("s1", T0, 1, 0.9, "x", "s1"), ("s2", T0 + timedelta(hours=1), 2, 0.1, "x", "s2"), ("s2", T0 + timedelta(hours=2), 3, 0.8, "x", "s2"),
        ("t1", T0, 4, 0.95, "session_locked", "t1"), ("u1", T0, 5, 0.75, "x", "built-in"), ("v1", T0, 6, None, None, "v1"),
    ]
    table = spark.createDataFrame(rows, "session_id string, ts timestamp, request_id int, risk double, threat string, own string")
    judged = sessions.evaluate_rotation(table, "request_id", "threat", "risk", "session_id", "own")
    adopted = spark.createDataFrame([("s2", "s1")], "session_id string, previous_session_id string")
    got = {r["root"]: r for r in sessions.latest_rotated_state(judged, adopted, ["ts", "request_id"], ["risk"]).collect()}
    assert {k: (r["session"], r["sessions"], r["turns"], r["risk"]) for k, r in got.items()} == {
        "s1": ("s2", 2, 3, 0.8), "t1": ("t1", 1, 1, 0.95), "u1": ("u1", 1, 1, 0.75), "v1": ("v1", 1, 1, None),
    }
    assert {k: (r["locked"], r["rotated"], r["rotation_recommended"], r["next_id"] is None) for k, r in got.items()} == {
        "s1": (False, True, False, False), "t1": (True, False, False, True), "u1": (False, False, True, False), "v1": (False, False, False, True),
    }


def test_holds_last_to_the_release_or_the_last_action(spark):
    rng = random.Random(23)
    rows = [(rng.choice(["a", "a", "a", "b", None]), T0 + timedelta(minutes=rng.randrange(4_000)), i, rng.choice([True, False, False, None]), rng.choice([True, False, None])) for i in range(500)]
    table = spark.createDataFrame(rows, "session_id string, ts timestamp, request_id int, bad boolean, good boolean")
    got = sessions.session_holds(table, F.col("bad"), F.col("good"), ("session_id",)).collect()
    want = []
    for key in ("a", "b", None):
        hold = None
        for _, ts, i, bad, good in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            if hold and good and not bad:
                want.append((key, hold[0], i, True, hold[2], hold[3], (ts - hold[1]) // timedelta(seconds=1)))
                hold = None
            elif hold:
                hold = [hold[0], hold[1], hold[2] + bool(bad), hold[3] + 1, i, ts]
            elif bad:
                hold = [i, ts, 1, 0, i, ts]
        if hold:
            want.append((key, hold[0], hold[4], False, hold[2], hold[3], (hold[5] - hold[1]) // timedelta(seconds=1)))
    found = [(r["session_id"], r["started"]["request_id"], r["ended"]["request_id"], r["released"], r["refusals"], r["actions_held"], r["seconds"]) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr) and len(want) > 50


def test_verdicts_reused_in_other_sessions(spark):
    rows = [(1, "s1", "h"), (2, "s1", "h"), (3, "s2", "h"), (4, "s3", "h"), (5, "s2", "h"), (6, "s1", "g"), (7, "s1", "g"), (8, None, "f"), (9, None, "f")]
    requests = spark.createDataFrame([r[:2] for r in rows], "request_id int, session_id string")
    scans = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 8}
    told = spark.createDataFrame([(i, h, scans[i], scans[i] == i) for i, _, h in rows], "request_id int, content_hash string, scan_id int, scanned boolean")
    got = {r["content_hash"]: tuple(r)[1:] for r in sessions.reused_verdicts(told, requests).collect()}
    assert got == {"h": (5, 3, 2, 1), "f": (2, 1, 1, 0)}
