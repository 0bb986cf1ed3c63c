"""Request, verdict, call and scope views derived from the given tables.

The expressions are plain SQL that Spark and DuckDB read alike, so both engines start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions.frames import computed_once
from veilstone.functions.requests import is_blank
from veilstone.sources.tables import read_table, read_text_table, spread


def _pick(index: str, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {index} {arms} END"


CHANNEL = (
    "CASE event_type WHEN 'view' THEN 'web_search' WHEN 'signup' THEN 'agent_card' WHEN 'error' THEN 'command' "
    "WHEN 'click' THEN 'sql' WHEN 'purchase' THEN 'file_path' END"
)
ACTION = _pick("event_id % 6", ["allow", "warn", "block", "require_approval", "quarantine", None])
ORIGIN = _pick("event_id % 5", ["human_prompt", "agent_output", "agent_action", "third_party", None])
THREAT = _pick(
    "event_id % 12",
    [
        "prompt_injection", "instruction_override", "INJECTION", "jailbreak-attempt", "sqli", "toxicity",
        "multi_turn_crescendo", "multi_turn_blocked_try", "some_future_threat", "session_locked", "", None,
    ],
)
VIOLATION_THREAT = _pick("k % 4", ["union_injection", "pii_leak", "Reverse-Shell", None])
TWO = "lpad(cast({} as string), 2, '0')"
RISK = "'0.' || " + TWO.format("cast(floor(least(value, 99.0)) as int)")


def _optional(name: str, value: str, when: str = "true") -> str:
    """`,"name":value` when both the condition and the value hold, else nothing."""
    return f"coalesce(CASE WHEN {when} THEN ',\"{name}\":' || {value} END, '')"


def _string(value: str) -> str:
    return f"'\"' || {value} || '\"'"


VIOLATION = (
    "'{\"user_message\":\"m' || cast(k % 5 as string) || '\",\"policy_id\":\"p' || cast(k as string) || "
    "'\",\"matched_pattern\":\"x\"' || "
    + _optional("threat_type", _string(VIOLATION_THREAT))
    + " || '}'"
)
RAW_PARTS = [
    "'{\"request\":' || cast(event_id as string)",
    _optional("safe", "CASE WHEN event_id % 97 = 0 THEN '\"false\"' WHEN event_type <> 'error' THEN 'true' "
              "ELSE 'false' END", "event_id % 89 <> 0"),
    _optional("action", _string(ACTION)),
    _optional("refuse_tier", _string(ACTION), "event_id % 10 <> 0"),
    _optional("confidence", f"CASE WHEN event_id % 91 = 0 THEN '\"0.95\"' ELSE '0.' || {TWO.format('k')} END",
              "k % 10 <> 0"),
    _optional("threat_type", _string(THREAT)),
    _optional("severity", "CASE k % 4 WHEN 0 THEN '\"HIGH\"' WHEN 1 THEN '\"severe\"' WHEN 2 THEN '7' END"),
    _optional("reason", "'\"r' || cast(k as string) || '\"'", "k % 5 = 0"),
    _optional("violations", f"CASE k % 7 WHEN 0 THEN '[\"note\",' || {VIOLATION} || ']' WHEN 1 THEN '[]' "
              f"WHEN 2 THEN '[1]' WHEN 3 THEN '\"none\"' ELSE '[' || {VIOLATION} || ',' || {VIOLATION} || ']' END",
              "k % 8 <> 0"),
    _optional("recovery", "'{\"instruction\":\"wait ' || cast(k % 9 as string) || '\"' || CASE WHEN k % 6 = 0 THEN "
              "',\"available_tools\":[\"read_file\",\"session_status\"],\"patterns_triggered\":[\"step_' || "
              "cast(k % 4 as string) || '\"]' ELSE '' END || '}'", "k % 3 = 0"),
    _optional("session_state", "'{\"session_risk_score\":' || " + RISK + " || ',\"session_turn_number\":' || "
              "cast(k % 9 + 1 as string) || ',\"session_patterns\":[\"a' || cast(k % 3 as string) || '\",\"b\"]}'",
              "event_id % 4 <> 0"),
    _optional("content_type", _string(CHANNEL), "k % 11 <> 0"),
    _optional("content_origin", _string(ORIGIN)),
    _optional("held_by_scope", "'true'", "event_id % 31 = 0"),
    _optional("content_verdict", "'{\"safe\":true}'", "event_id % 31 = 0"),
    _optional("policy_id", "'\"top\"'", "event_id % 13 = 0"),
    "CASE WHEN event_id % 83 = 0 THEN '' ELSE '}' END",
]
RAW = " || ".join(RAW_PARTS)

CONTEXT = (
    "CASE WHEN event_id % 23 = 0 THEN '\"plain\"' ELSE '{\"z\":1' || "
    + _optional("session_id", _string("'s' || cast(user_id as string)"), "event_id % 29 <> 0")
    + " || "
    + _optional("agent_id", _string("'a' || cast(user_id % 20 as string)"), "event_id % 37 <> 0")
    + " || "
    + _optional("source_application", _string("'app'"), "event_id % 41 <> 0")
    + " || '}' END"
)
ENDPOINT = (
    "CASE WHEN event_id % 4 = 0 THEN 'general' WHEN event_id % 16 = 5 THEN 'tool_schema' ELSE 'specialized' END"
)
BODY = (
    f"CASE {ENDPOINT} WHEN 'general' THEN '{{\"prompt\":\"hello\",\"scan_type\":\"' || "
    "CASE WHEN event_id % 28 = 0 THEN 'quick' ELSE 'full' END || '\",\"context\":' || " + CONTEXT + " || '}' "
    "WHEN 'tool_schema' THEN '{\"name\":\"n\"' || " + _optional("description", "'\"d\"'", "event_id % 48 <> 5") + " || "
    + _optional("content_type", "'\"sql\"'", "event_id % 32 = 5") + " || '}' "
    "ELSE '{\"content\":\"c\",\"content_type\":\"' || CASE WHEN event_id % 19 = 1 THEN 'hologram' ELSE " + CHANNEL
    + " END || '\",\"context\":' || " + CONTEXT + " || '}' END"
)

EVENT_COLUMNS = {
    "request_id": "event_id",
    "session_id": "'u' || cast(user_id as string) || '-' || day",
    "agent_id": "'a' || cast(user_id % 20 as string)",
    "channel": CHANNEL,
    "raw": RAW,
    "status": "CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 50 = 0 THEN 401 ELSE 200 END",
    "endpoint": "CASE WHEN event_type IN ('view', 'click') THEN 'general' ELSE 'specialized' END",
    "envelope_endpoint": ENDPOINT,
    "body": BODY,
    "tool": _pick("k % 5", ["read_file", "write_file", "run_command", "web_search", "send_mail"]),
    "k_blank": "k % 17 = 0",
    "risk": "least(value / 100.0, 1.0)",
    "content": f"{CHANNEL} || ' ' || cast(user_id % 7 as string) || ' ' || cast(k % 13 as string)",
}


def _with_raw(base: DataFrame) -> DataFrame:
    """`raw`, put together from a few of its parts at a time: the code for all at once is too long for Java to compile."""
    names = []
    for i in range(0, len(RAW_PARTS), 3):
        names.append(f"_raw_{i}")
        base = computed_once(base, names[-1], F.expr(" || ".join(RAW_PARTS[i : i + 3])))
    return computed_once(base, "raw", F.concat(*names)).drop(*names)


def event_columns(events: DataFrame, *columns: str) -> DataFrame:
    """Events, from a table or a stream, as scan requests: the named derived columns, behind ts and user_id."""
    base = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
    )
    if "raw" in columns:
        base = _with_raw(base)
    derived = [F.col("raw") if c == "raw" else F.expr(EVENT_COLUMNS[c]).alias(c) for c in ("request_id", *columns)]
    return base.select("ts", "user_id", *derived)


def event_requests(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return event_columns(spread(events, "event_id") if "raw" in columns else events, *columns)


EVENT_BASE = (
    "event_base AS (SELECT event_id, ts, user_id, event_type, value, "
    "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y%m%d') AS day FROM events)"
)


def events_cte() -> str:
    """DuckDB: `ev`, the event view with every derived column."""
    derived = ", ".join(f"{sql} AS {name}" for name, sql in EVENT_COLUMNS.items())
    return f"{EVENT_BASE}, ev AS (SELECT ts, user_id, {derived} FROM event_base)"


#: Events that stand for a scope declaration; all fields follow from the event, and half of them are left unset.
DECLARING = "event_type = 'signup'"
SCOPE_COLUMNS = {
    "agent_id": "'a' || cast(user_id % 20 as string)",
    "seq": "event_id",
    "allowed": "CASE WHEN event_id % 97 = 0 THEN '' ELSE CASE event_id % 7 WHEN 0 THEN "
    "'read_file,run_command,send_mail,web_search,write_file' WHEN 1 THEN '*' WHEN 2 THEN 'read_file,web_search,write_file' "
    "WHEN 3 THEN 'read_file,send_mail,write_file' END END",
    "forbidden": "CASE WHEN event_id % 5 = 0 THEN 'send_mail' WHEN event_id % 11 = 0 THEN 'run_command,send_mail' END",
    "purpose": "CASE WHEN event_id % 4 = 0 THEN 'p' || cast(event_id % 9 as string) END",
    "max_duration_seconds": "CASE event_id % 3 WHEN 0 THEN 864000 WHEN 1 THEN 20000 END",
    "renewable_seconds": "CASE WHEN event_id % 2 = 0 THEN 1300000 WHEN event_id % 13 = 0 THEN 99 END",
}


def scope_declarations(spark: SparkSession, folder: str) -> DataFrame:
    """A scope declaration for every event that declares one: as the events grow, so does each agent's history."""
    return declarations_of(read_table(spark, folder, "events"))


def declarations_of(events: DataFrame) -> DataFrame:
    """The declarations of a table or stream of events."""
    events = events.where(DECLARING)

    def tools(name: str) -> Column:
        text = F.expr(SCOPE_COLUMNS[name])
        listed = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))
        return F.when(text.isNotNull(), listed)

    at = F.col("ts").cast("timestamp")
    return events.select(
        *[F.expr(SCOPE_COLUMNS[c]).alias(c) for c in ("agent_id", "seq", "purpose", "max_duration_seconds", "renewable_seconds")],
        at.alias("declared_at"),
        F.when(F.col("event_id") % 19 == 0, at + F.expr("INTERVAL '3' DAY")).alias("expires_at"),
        tools("allowed").alias("allowed_tools"),
        tools("forbidden").alias("forbidden_tools"),
    )


def scopes_cte() -> str:
    """DuckDB: `decl`, the same declarations, with lists as comma-joined text and `n` in each agent's order."""
    derived = ", ".join(f"{sql} AS {name}" for name, sql in SCOPE_COLUMNS.items())
    return f"""decl AS (SELECT {derived}, ts AS declared_at,
  CASE WHEN event_id % 19 = 0 THEN ts + INTERVAL 3 DAY END AS expires_at,
  row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS n FROM events WHERE {DECLARING})"""


def document_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as file scans: a path and the body."""
    docs = read_text_table(spark, folder, "documents", "doc_id")
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", "lang", "source", path.alias("path"), "text")


def page_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Pages cut at paragraph marks: page, position and the non-blank chunk."""
    pages = spread(read_table(spark, folder, "pages"), "page_id")
    cut = pages.select("page_id", F.posexplode(F.split("html", "<p>")).alias("pos", "chunk"))
    return cut.where(~is_blank(F.col("chunk")))
