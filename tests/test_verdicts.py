from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from veilstone.functions import dims
from veilstone.functions import verdicts as V
from veilstone.operators import verdicts as ops


def _clean(spark, *raws):
    texts = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(raws)]
    rows = ops.sanitize_verdict(spark.createDataFrame(texts, "id int, raw string"), ["id"]).orderBy("id")
    return rows.withColumn("violations", F.to_json("violations")).withColumn("session_state", F.to_json("session_state")).collect()


def test_threat_types(spark):
    cases = {
        "prompt_injection": "prompt_injection", "instruction_override": "prompt_injection", "INJECTION": "prompt_injection",
        "jailbreak-attempt": "jailbreak", "sqli": "sql_injection", "toxicity": "toxic_content",
        "multi_turn_crescendo": "multi_turn_attack", "multi_turn_blocked_try": "multi_turn_attack", "": "unknown",
        "some_future_threat": "unknown", None: "unknown",
    }
    table = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r["raw"]: r["threat_type"] for r in ops.normalize_threat_type(table, "raw").collect()}
    assert got == cases
    assert sum(len(c) for c in dims.THREAT_CODES.values()) == 94
    assert set(dims.THREAT_CODES) | {"unknown"} == set(dims.SEVERITY) == set(dims.GUIDANCE)


@pytest.mark.parametrize(
    ("score", "want"), [(None, "medium"), (0.95, "high"), (0.9, "high"), (0.8, "medium"), (0.7, "medium"), (0.5, "low"), (0.0, "low"), (float("nan"), "low")]
)
def test_confidence(spark, score, want):
    table = spark.createDataFrame([(score,)], "s double")
    assert table.select(V.bucket_confidence(F.col("s")).alias("b")).first()["b"] == want


def test_severity(spark):
    rows = [("sql_injection", ""), ("sql_injection", "LOW"), ("jailbreak", "bogus"), ("nonsense", None)]
    table = spark.createDataFrame(rows, "raw string, severity_in string")
    got = [r["severity"] for r in ops.classify_threat(table, "raw", "severity_in").collect()]
    assert sorted(got) == sorted(["critical", "low", "high", "medium"])


@pytest.mark.parametrize(
    ("action", "safe", "want"),
    [("allow", True, False), ("warn", True, False), ("block", False, True), ("require_approval", False, True), (None, True, False),
     (None, False, True), ("quarantine", False, True), ("quarantine", True, False), ("BLOCK", True, False)],
)
def test_blocked(spark, action, safe, want):
    row = _clean(spark, {"safe": safe} | ({"action": action} if action else {}))[0]
    assert row["blocked"] == want


def test_safe_rows_keep_governance_only(spark):
    row = _clean(
        spark,
        {"safe": True, "action": "warn", "refuse_tier": "warn", "reason": "advice", "recovery": {"instruction": "x"},
         "session_state": {"session_risk_score": 0.3}, "content_type": "sql", "threat_type": "sqli", "confidence": 0.9},
    )[0]
    assert (row["action"], row["refuse_tier"], row["reason"], row["content_type"]) == ("warn", "warn", "advice", "sql")
    assert row["recovery"] is not None and json.loads(row["session_state"]) == {"session_risk_score": 0.3}
    assert row["threat_type"] is None and row["confidence"] is None and row["guidance"] is None


def test_unsafe_rows_lose_internals(spark):
    row = _clean(
        spark,
        {"safe": False, "action": "block", "confidence": 0.95, "policy_id": "p", "ai_reasoning": "r", "future_field": [1, {"a": 2}],
         "violations": [{"threat_type": "instruction_override", "severity": "high", "matched_pattern": "m", "policy_id": "q"}, "note", 3]},
    )[0]
    assert (row["threat_type"], row["severity"], row["confidence"]) == ("prompt_injection", "high", "high")
    assert row["reason"] == row["guidance"] == dims.GUIDANCE["prompt_injection"]
    assert json.loads(row["violations"]) == [{"threat_type": "instruction_override", "severity": "high"}]
    assert "policy_id" not in row.asDict() and "future_field" not in row.asDict()


def test_strict_types_and_malformed_text(spark):
    rows = _clean(
        spark,
        {"safe": "false"}, {"safe": 0}, {"safe": False, "confidence": "0.95"}, {"safe": False, "reason": 5, "severity": 7, "threat_type": 1},
        {"safe": False, "violations": []}, {"safe": False, "violations": ["x", 1]}, '{"safe": fal', "[1]", "null", "",
        '{"safe": true, "safe": false}', {"safe": False, "violations": [{"threat_type": "ssn"}, {"threat_type": "sqli"}], "threat_type": ""},
        {"safe": False, "violations": ["x", {"threat_type": "sqli"}]}, {"safe": False, "recovery": "text", "session_state": [1]},
    )
    assert [r["safe"] for r in rows[:2]] == [True, True]
    assert rows[2]["confidence"] == "medium"
    assert (rows[3]["reason"], rows[3]["severity"], rows[3]["threat_type"]) == (dims.GUIDANCE["unknown"], "medium", "unknown")
    assert rows[4]["violations"] is None and rows[5]["violations"] is None
    assert [r["parsed"] for r in rows[6:10]] == [False, False, True, False]
    assert rows[6]["safe"] is None and rows[8]["safe"] is True
    assert rows[10]["safe"] is False
    assert rows[11]["threat_type"] == "pii_exposure"
    assert rows[12]["threat_type"] == "unknown"
    assert rows[13]["recovery"] is None and rows[13]["session_state"] is None


def _feedback(spark, raw):
    clean = ops.sanitize_verdict(spark.createDataFrame([(0, json.dumps(raw))], "id int, raw string"), ["id"])
    names = ("action", "reason", "guidance", "threat_type", "recovery", "session_state")
    return clean.select(V.block_feedback(*[F.col(n) for n in names]).alias("t")).first()["t"].split("\n")


def test_feedback(spark):
    state = {"session_risk_score": 0.85, "session_turn_number": 4.9, "session_patterns": ["recon", 5, "b"]}
    raw = {"safe": False, "action": "block", "threat_type": "data_leak", "reason": "why", "session_state": state}
    assert _feedback(spark, raw) == [
        V.FEEDBACK_LEAD["block"], "Reason: why", "Threat type: data_exfiltration", "Session risk: 0.85 (turn 4)", "Patterns triggered: recon, b",
    ]
    recovery = {"instruction": "ask", "available_tools": ["session_status"], "patterns_triggered": ["step"]}
    raw = {"safe": True, "action": "Require_Approval", "recovery": recovery, "session_state": {"session_patterns": ["whole"], "session_risk_score": 1.0}}
    assert _feedback(spark, raw) == [
        V.FEEDBACK_LEAD["require_approval"], "Session risk: 1", "Patterns triggered: step", "Recovery: ask", "Available tools: session_status",
    ]
    assert _feedback(spark, {"action": "warn"}) == [V.FEEDBACK_LEAD["warn"]]


def test_unknown_channel_is_never_the_operator(spark):
    table = spark.createDataFrame([("prompt",), ("rag_context",), ("hologram",), (None,)], "channel string")
    got = [(r["content_origin"], r["attributable"]) for r in ops.attribute_origin(table).collect()]
    assert sorted(got) == sorted([("human_prompt", True), ("third_party", False), ("agent_action", False), ("agent_action", False)])


def test_lookups_are_broadcast_and_parse_happens_once(spark):
    table = spark.createDataFrame([(0, "{}")], "id int, raw string")
    plan = ops.sanitize_verdict(table, ["id"]).where("blocked")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("raw", ["{'safe':false}", '{"safe":true,"confidence":NaN}', '{"safe":true,"confidence":Infinity}', "null x", "[]"])
def test_what_json_lacks_is_no_verdict(spark, raw):
    table = spark.createDataFrame([(1, raw), (2, "\t null\r\n"), (3, '{"safe":true}')], "request_id int, raw string")
    got = {r["request_id"]: r["parsed"] for r in ops.sanitize_verdict(table, ["request_id"]).collect()}
    assert got == {1: False, 2: True, 3: True}
