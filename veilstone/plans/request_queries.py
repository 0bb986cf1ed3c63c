"""Registered queries over scan requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions import requests as R
from veilstone.functions.dims import CHANNELS, values_table
from veilstone.operators import expiry
from veilstone.operators import requests as ops
from veilstone.operators import verdicts as vops
from veilstone.plans.duckdb_sql import quoted
from veilstone.plans.flows import prompt_guard as prompt_guard_of
from veilstone.plans.verdict_queries import READ
from veilstone.plans.views import document_envelopes, event_requests, events_cte, page_chunks
from veilstone.sources.tables import read_table, spread


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Page pieces between paragraph marks; every fifth is replaced by exotic white space."""
    pages = spread(read_table(spark, folder, "pages"), "page_id")
    cut = pages.select("page_id", F.posexplode(F.split("html", "<p>")).alias("pos", "chunk"))
    return cut.withColumn("chunk", F.when(F.col("pos") % 5 == 4, F.lit(" \t \n")).otherwise(F.col("chunk")))


def blank_gate(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder).select("page_id", "pos", R.is_blank(F.col("chunk")).alias("blank"))


def size_gate(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_envelopes(spark, folder)
    size = R.byte_size(F.col("path"), F.col("text"))
    gated = ops.size_gate(docs.select("doc_id", "path", "text"), size, F.lit("file_content"))
    return gated.select("doc_id", "bytes", "oversize", F.col("local_verdict.reason").alias("reason"))


def size_gate_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All texts of a source as one request: sizes are summed, the texts are never put together."""
    docs = read_table(spark, folder, "documents")
    sizes = docs.groupBy("source").agg(F.sum(F.octet_length("text")).alias("total"))
    gated = ops.size_gate(sizes, F.col("total"), F.lit("prompt"))
    return gated.select(
        "source", "bytes", "oversize", F.col("local_verdict.reason").alias("reason"),
        F.col("local_verdict.violations")[0]["description"].alias("violation"),
    )


def build_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as general requests: the text is the prompt, the text of the turn before the history."""
    turns = read_table(spark, folder, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("before"))
    asked = turns.join(before, ["conv_id", "turn"], "left")
    context = R.identity_context(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""), F.lit("none"), F.lit("agent-0")
    )
    body = R.general_envelope(F.col("text"), context, F.col("before"))
    return asked.select("conv_id", "turn", F.sha2(body, 256).alias("body_sha"), F.octet_length(body).alias("body_bytes"))


def channel_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Files as channel requests: the path is the content, the text of a file that has one goes into the context."""
    docs = document_envelopes(spark, folder)
    text = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    context = R.identity_context(
        F.lit(None).cast("string"), F.col("source"), F.lit("batch"), F.lit("agent-0"), extras=R.extras_map({"file_content": text})
    )
    body = R.channel_envelope(F.col("path"), R.route_channel(F.lit("file"), text), context)
    return docs.select("doc_id", F.sha2(body, 256).alias("body_sha"), F.octet_length(body).alias("body_bytes"))


def tool_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as tool schemas: the url names the tool, its text describes it."""
    pages = read_table(spark, folder, "pages")
    body = R.tool_schema_envelope(F.col("url"), F.col("html"), F.create_map(F.lit("page"), F.col("page_id").cast("string")))
    return pages.select("page_id", F.sha2(body, 256).alias("body_sha"), F.octet_length(body).alias("body_bytes"))


def resolve_identity(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    context = R.identity_context(
        F.when(F.col("event_id") % 3 == 0, user), F.when(F.col("event_id") % 4 == 0, user).otherwise(""),
        F.lit("default-session"), F.lit("default-agent"), F.when(F.col("event_id") % 5 == 0, F.lit("env-agent")),
        extras=R.extras_map({"role": F.when(F.col("event_id") % 2 == 0, F.lit("agent")),
                             "session_id": F.when(F.col("event_id") % 7 == 0, F.lit("extra"))}),
    )
    return events.select("event_id", F.explode(context).alias("key", "value"))


def route_channel(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    kind = F.element_at(
        F.array(*[F.lit(k) for k in ("file", "sql", "tool_schema", "file", "command", "a2a_message")]),
        (F.col("doc_id") % 6 + 1).cast("int"),
    )
    body = F.when(F.col("doc_id") % 4 != 0, F.col("text")).otherwise("")
    return docs.select("doc_id", R.route_channel(kind, body).alias("channel"))


#: Channel and options of an event, as SQL that both engines read.
CHANNEL_OPTIONS = {
    "channel": "CASE event_id % 8 WHEN 0 THEN 'command' WHEN 1 THEN 'sql' WHEN 2 THEN 'file_path' WHEN 3 THEN 'file_content' "
    "WHEN 4 THEN 'web_search' WHEN 5 THEN 'rag_context' WHEN 6 THEN 'a2a_message' ELSE 'agent_card' END",
    "cwd": "CASE WHEN user_id % 3 = 0 THEN '/home/u' || cast(user_id as string) WHEN user_id % 3 = 1 THEN '' END",
    "database": "CASE WHEN user_id % 2 = 0 THEN 'db<' || cast(user_id % 9 as string) || '>' END",
    "allow_destructive": "user_id % 4 = 0",
    "file_content": "'line ' || cast(user_id as string) || ' & \"quoted\"'",
    "query": "CASE WHEN user_id % 5 <> 0 THEN 'what is ' || event_type END",
    "sender_agent_id": "'s' || cast(user_id % 7 as string)",
    "receiver_agent_id": "CASE WHEN user_id % 3 <> 0 THEN 'r' || cast(user_id % 5 as string) END",
    "task_id": "CASE WHEN event_id % 5 = 0 THEN 't' || cast(event_id as string) ELSE '' END",
    "role": "CASE WHEN event_id % 3 = 0 THEN 'user' WHEN event_id % 3 = 1 THEN 'agent' END",
    "verify_signature": "user_id % 2 = 1",
}


def channel_contexts(spark: SparkSession, folder: str) -> DataFrame:
    """The context of every event's request, read back from the body: what reaches the service, key by key."""
    given = read_table(spark, folder, "events").selectExpr(
        "event_id", "user_id", "event_type", *[f"{sql} AS {name}" for name, sql in CHANNEL_OPTIONS.items()]
    )
    options = {name: F.col(name) for name in CHANNEL_OPTIONS if name != "channel"}
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    body = R.channel_request(
        F.col("channel"), F.col("event_type"), options, F.when(F.col("user_id") % 2 == 0, user), F.lit(""), F.lit("run"), F.lit("agent-0")
    )
    read = given.select("event_id", F.from_json(body, "content STRING, content_type STRING, context MAP<STRING, STRING>").alias("b"))
    return read.select("event_id", F.col("b.content_type").alias("channel"), F.col("b.content").alias("content"), F.explode("b.context").alias("key", "value"))


def encode_rag_chunks(spark: SparkSession, folder: str) -> DataFrame:
    done = ops.encode_rag_chunks(page_chunks(spark, folder), "page_id", "pos", "chunk")
    gated = ops.size_gate(done, F.col("content_bytes"), F.lit("rag_context"))
    return gated.select(
        "page_id", "n_chunks", F.sha2("content", 256).alias("content_sha"), "content_bytes", "oversize",
        (F.octet_length("content") == F.col("content_bytes")).alias("size_agrees"),
    )


def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_envelopes(spark, folder)
    return docs.select(
        "doc_id",
        R.wire_hash(F.lit("file_content:"), F.col("path")).alias("bare_hash"),
        R.content_hash(channel=F.lit("file_content"), path=F.col("path"), text=F.col("text")).alias("full_hash"),
    )


# The default rules, plus some that the documents do meet.
RULES = (
    *ops.DEFAULT_RULES,
    ops.Rule("sql", r"(?i)\bthe\b", "tautology", "warn", 0.5),
    ops.Rule("sql", r"[0-9]{4}", "stacked_query", "block", 0.8, "Numbers found"),
    ops.Rule("file_content", r"\bund\b|\betc\b", "sensitive_content", "require_approval", 0.75),
)


def _screened_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_envelopes(spark, folder)
    channel = F.element_at(F.array(F.lit("prompt"), F.lit("sql"), F.lit("file_content")), (F.col("doc_id") % 3 + 1).cast("int"))
    return docs.select("doc_id", channel.alias("channel"), F.col("text").alias("content"))


def _screen(df: DataFrame) -> DataFrame:
    clean = vops.sanitize_verdict(ops.rule_screen(df, rules=RULES), [c for c in df.columns])
    return clean


def rule_screen(spark: SparkSession, folder: str) -> DataFrame:
    return _screen(_screened_docs(spark, folder)).select("doc_id", "channel", "blocked", "action", "threat_type", "confidence")


def rule_screen_strictest(spark: SparkSession, folder: str) -> DataFrame:
    screened = ops.rule_screen(_screened_docs(spark, folder), rules=RULES, strictest=True)
    return screened.select("doc_id", F.get_json_object("raw", "$.action").alias("action"))


#: Rules drawn from the benchmark: the first three words of each item with a letter in them, whatever stands between.
TABLE_RULES = {
    "pos": "item_id",
    "channel": "CASE WHEN item_id % 5 = 0 THEN 'other' ELSE 'sql' END",
    "threat_type": "'leak_' || cast(item_id % 3 as string)",
    "action": "CASE item_id % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'warn' ELSE 'require_approval' END",
    "reason": "'item ' || cast(item_id as string)",
}


def _table_rules(spark: SparkSession, folder: str) -> DataFrame:
    words = F.slice(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), 1, 3)
    items = read_table(spark, folder, "benchmark").where(F.size(words) == 3)
    regex = F.concat(F.lit(r"(?i)\b"), F.array_join(words, r"\W+"), F.lit(r"\b"))
    confidence = F.lit(None).cast("double").alias("confidence")
    return items.select(*[F.expr(sql).alias(name) for name, sql in TABLE_RULES.items()], regex.alias("regex"), confidence)


def rule_screen_table(spark: SparkSession, folder: str) -> DataFrame:
    docs = _screened_docs(spark, folder).withColumn("channel", F.lit("sql"))
    screened = ops.rule_screen_table(docs.select("doc_id", "channel", "content"), _table_rules(spark, folder), strictest=True)
    return screened.select(
        "doc_id", F.get_json_object("raw", "$.action").alias("action"), F.get_json_object("raw", "$.reason").alias("reason")
    )


def dedup_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = _screened_docs(spark, folder).withColumn("channel", F.lit("sql"))
    key = R.content_hash(channel=F.col("channel"), text=F.col("content"))
    return ops.dedup_scans(
        docs, "doc_id", ["channel", "content"], key, lambda d: _screen(d), ["blocked", "action", "threat_type"]
    )


def dedup_stats(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_envelopes(spark, folder)
    return ops.dedup_stats(docs, R.content_hash(text=F.col("text"))).withColumn("hit_rate", F.round("hit_rate", 6))


def _expiring(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return event_requests(spark, folder, "content", *more).select("ts", "request_id", "content", *more)


def dedup_scans_expiring(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of one content share the verdict of the one that was scanned, for five minutes."""
    scan = lambda d: vops.sanitize_verdict(d, ["request_id"])
    told = expiry.dedup_within(
        _expiring(spark, folder, "raw"), "request_id", "ts", F.sha2("content", 256), ["raw"], scan, ["action", "blocked"]
    )
    return told.select("request_id", "content_hash", "scan_id", "scanned", "action", "blocked")


def dedup_expiry_stats(spark: SparkSession, folder: str) -> DataFrame:
    told = expiry.dedup_within(_expiring(spark, folder), "request_id", "ts", F.sha2("content", 256))
    return expiry.expiry_stats(told).withColumn("hit_rate", F.round("hit_rate", 6))


def _turn_parts(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations")
    return turns.select(
        "conv_id", "turn",
        F.when((F.col("conv_id") + F.col("turn")) % 11 == 0, "").otherwise(F.col("role")).alias("role"),
        F.when(F.col("turn") % 4 == 2, F.lit("text")).when(F.col("turn") % 4 == 3, F.lit("image")).alias("kind"),
        F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, "").otherwise(F.col("text")).alias("text"),
    )


def _extracted(style: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        said = ops.extract_user_content(_turn_parts(spark, folder), style=style, kind="kind")
        return said.select("conv_id", F.sha2("content", 256).alias("content_sha"), "content_bytes")

    return run


def _verdicts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    requests = event_requests(spark, folder, "channel", "k_blank")
    answered = event_requests(spark, folder, "raw", "status").where("status = 200")
    return requests, vops.sanitize_verdict(answered, ["request_id"]).where("parsed")


def guard_decision(spark: SparkSession, folder: str) -> DataFrame:
    requests, verdicts = _verdicts(spark, folder)
    asked = requests.select("request_id", F.col("k_blank").alias("blank"))
    decided = ops.guard_decision(asked, verdicts, "request_id", ("closed", "open"))
    n = F.when(F.col("outcome") == "blocked", F.coalesce(F.array_size("violations"), F.lit(0)))
    return decided.withColumn("n_violations", n).drop("violations")


def prompt_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations through the guard; every ninth is blown up beyond the size limit."""
    turns = _turn_parts(spark, folder)
    text = F.when(F.col("conv_id") % 9 == 0, F.repeat("text", F.lit(400))).otherwise(F.col("text"))
    return prompt_guard_of(turns.withColumn("text", text), kind="kind")


POLICIES = (
    ("sql_injection", "warn", 0.2), ("sql_injection", "block", 0.8), ("sql_injection", "require_approval", 0.5),
    ("jailbreak", "require_approval", 0.4), ("jailbreak", "warn", 0.9), ("toxic_content", "block", 0.95),
    ("prompt_injection", "block", 0.6), ("prompt_injection", "block", 0.3), ("made_up", "block", 0.0),
    ("toxic_content", "quarantine", 0.1), ("data_exfiltration", "quarantine", 0.0), ("jailbreak", "audit", 0.0),
)


def policy_match(spark: SparkSession, folder: str) -> DataFrame:
    read = vops.parse_verdict(event_requests(spark, folder, "raw"))
    scored = vops.normalize_threat_type(read, "raw_threat_type").select("request_id", "threat_type", "score")
    policies = values_table(spark, ("type", "action", "threshold"), POLICIES)
    return ops.policy_match(scored, policies).select("request_id", "threat_type", "policy_action")


def request_contract_audit(spark: SparkSession, folder: str) -> DataFrame:
    envelopes = event_requests(spark, folder, "envelope_endpoint", "body")
    return ops.request_contract_audit(envelopes, "request_id", "envelope_endpoint")


def missing_scans(spark: SparkSession, folder: str) -> DataFrame:
    requests, verdicts = _verdicts(spark, folder)
    return ops.missing_scans(requests.select("request_id", "channel"), verdicts, "request_id")


def unused_channels(spark: SparkSession, folder: str) -> DataFrame:
    return ops.unused_channels(event_requests(spark, folder, "channel"))


def _contexts_sql() -> str:
    """A row for each key: the three of identity, and the options of the channel that are set."""
    base = ", ".join(f"{sql} AS {name}" for name, sql in CHANNEL_OPTIONS.items())
    rows = [
        ("session_id", "CASE WHEN user_id % 2 = 0 THEN 'u' || cast(user_id as string) ELSE 'run' END", "true"),
        ("agent_id", "'agent-0'", "true"),
        ("source_application", "'veilstone'", "true"),
    ]
    for channel, (keys, _) in CHANNELS.items():
        rows += [(k, "'true'" if k in R.FLAGS else k, f"channel = '{channel}' AND " + (k if k in R.FLAGS else f"{k} <> ''")) for k in keys]
    parts = " UNION ALL ".join(f"SELECT event_id, channel, event_type AS content, '{k}' AS key, {v} AS value FROM b WHERE {when}" for k, v, when in rows)
    return f"WITH b AS (SELECT event_id, user_id, event_type, {base} FROM events) {parts}"


#: DuckDB: `shared`, each request with the one whose verdict it has: one step for each scan of a content.
EXPIRING = f"""{READ.replace('WITH ', 'WITH RECURSIVE ', 1)},
hashed AS (SELECT request_id, ts, sha256(content) AS content_hash FROM ev),
chain AS (SELECT content_hash, min(ts) AS ts FROM hashed WHERE content_hash IS NOT NULL GROUP BY content_hash
  UNION ALL SELECT c.content_hash, min(h.ts) FROM chain c JOIN hashed h ON h.content_hash = c.content_hash
    AND h.ts > c.ts + INTERVAL {expiry.TIME_TO_LIVE} SECOND GROUP BY c.content_hash, c.ts),
scans AS (SELECT content_hash, ts, min(request_id) AS scan_id FROM hashed JOIN chain USING (content_hash, ts) GROUP BY ALL),
shared AS (SELECT h.request_id, h.content_hash, coalesce(s.scan_id, h.request_id) AS scan_id
  FROM hashed h ASOF LEFT JOIN scans s ON h.content_hash = s.content_hash AND h.ts >= s.ts)"""

QUERIES = {
    "blank_gate": blank_gate,
    "size_gate": size_gate,
    "size_gate_sources": size_gate_sources,
    "build_envelope": build_envelope,
    "channel_envelopes": channel_envelopes,
    "tool_schemas": tool_schemas,
    "resolve_identity": resolve_identity,
    "route_channel": route_channel,
    "channel_contexts": channel_contexts,
    "encode_rag_chunks": encode_rag_chunks,
    "content_hash": content_hash,
    "rule_screen": rule_screen,
    "rule_screen_table": rule_screen_table,
    "rule_screen_strictest": rule_screen_strictest,
    "dedup_scans": dedup_scans,
    "dedup_scans_expiring": dedup_scans_expiring,
    "dedup_expiry_stats": dedup_expiry_stats,
    "dedup_stats": dedup_stats,
    "extract_user_content": _extracted("chat"),
    "extract_user_content_blocks": _extracted("blocks"),
    "extract_user_content_contents": _extracted("contents"),
    "guard_decision": guard_decision,
    "prompt_guard": prompt_guard,
    "policy_match": policy_match,
    "request_contract_audit": request_contract_audit,
    "missing_scans": missing_scans,
    "unused_channels": unused_channels,
}

_BLANK = (
    r"^[\t\n\v\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*$"
)
_ENVELOPES = (
    "docs AS (SELECT doc_id, lang, source, '/data/' || source || '/' || doc_id AS path, text FROM documents)"
)
_FULL_HASH = (
    "sha256('channel=' || strlen({c}) || ':' || {c} || 'path=' || strlen(path) || ':' || path "
    "|| 'text=' || strlen(text) || ':' || text)"
)


def _size_reason(label: str, size: str) -> str:
    return f"CASE WHEN {size} > 102400 THEN '{label} too large (' || ({size} // 1024) || 'KB > 100KB limit)' END"


_SCREENED = (
    f"{_ENVELOPES}, s AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'prompt' WHEN 1 THEN 'sql' ELSE 'file_content' END "
    "AS channel, text AS content FROM docs)"
)


def _rule_pick(what: str, order: str = "") -> str:
    ranked = list(enumerate(RULES))
    if order == "strictest":
        ranked.sort(key=lambda x: -ops.ACTION_RANK[x[1].action])
    arms = " ".join(
        f"WHEN channel = {quoted(r.channel)} AND regexp_matches(content, {quoted(r.regex)}) THEN {i}" for i, r in ranked
    )
    return f"CASE {arms} ELSE -1 END AS {what}"


def _by_rule(values: list[str | None], default: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {'NULL' if v is None else quoted(v)}" for i, v in enumerate(values))
    return f"CASE hit {arms} ELSE {default} END"


_RULE_TYPES = ["prompt_injection", "pii_exposure", "sql_injection", "path_traversal", "path_traversal",
               "sql_injection", "sql_injection", "secrets_exposure"]
_RULE_LEVEL = ["high", "high", "medium", "medium", "medium", "low", "medium", "medium"]
_ACTIONS = [r.action for r in RULES]
_BLOCKED = "hit >= 0 AND " + _by_rule(_ACTIONS, "'allow'") + " IN ('block', 'require_approval')"

_PARTS = """parts AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 11 = 0 THEN '' ELSE role END AS role,
  CASE turn % 4 WHEN 2 THEN 'text' WHEN 3 THEN 'image' END AS kind,
  CASE WHEN (conv_id + turn) % 7 = 0 THEN '' ELSE text END AS text FROM conversations)"""


def _extract_sql(wanted: str) -> str:
    return f"""WITH {_PARTS}, said AS (
  SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE {wanted}), '') AS content
  FROM parts GROUP BY conv_id)
SELECT conv_id, sha256(content) AS content_sha, strlen(content) AS content_bytes FROM said"""


def _decision(mode: str) -> str:
    lost = "proceed" if mode == "open" else "scan_error"
    degraded = "NOT blank AND c.request_id IS NULL" if mode == "open" else "false"
    return f"""SELECT r.request_id, blank, CASE WHEN blank THEN 'proceed' WHEN c.request_id IS NULL THEN '{lost}'
    WHEN blocked THEN 'blocked' ELSE 'proceed' END AS outcome,
  CASE WHEN NOT blank AND blocked THEN 'Request blocked: ' || coalesce(reason, '') WHEN blank THEN 'No content to scan'
    WHEN {degraded} THEN 'scan_unavailable_fail_open' END AS decision_reason,
  CASE WHEN NOT blank AND blocked THEN threat_type END AS threat_type,
  CASE WHEN NOT blank AND blocked THEN confidence END AS confidence, {degraded} AS degraded, '{mode}' AS fail_mode,
  CASE WHEN NOT blank AND blocked THEN CAST(CASE WHEN json_type(j, '$.violations') = 'ARRAY' THEN
    (SELECT count(*) FROM (SELECT unnest(json_extract(j, '$.violations[*]')) AS x) WHERE json_type(x) = 'OBJECT')
    ELSE 0 END AS INTEGER) END AS n_violations
FROM asked r LEFT JOIN answered c USING (request_id)"""


_ANSWERED = """answered AS (SELECT clean.* FROM clean JOIN ev USING (request_id) WHERE parsed AND status = 200),
asked AS (SELECT request_id, k_blank AS blank, channel FROM ev)"""

_J = "json_extract_string(body, '$.{}')"


def _lacks(name: str) -> str:
    return (
        f"envelope_endpoint <> 'tool_schema' AND (json_type(body, '$.context') <> 'OBJECT' "
        f"OR json_type(body, '$.context.{name}') IS NULL)"
    )


_KNOWN = ", ".join(quoted(c) for c in CHANNELS if c not in ("prompt", "mcp_schema"))
_BREAKS = {
    "missing_session_id": _lacks("session_id"),
    "missing_agent_id": _lacks("agent_id"),
    "missing_source_application": _lacks("source_application"),
    "context_not_object": "envelope_endpoint <> 'tool_schema' AND json_type(body, '$.context') <> 'OBJECT'",
    "wrong_scan_type": f"envelope_endpoint = 'general' AND {_J.format('scan_type')} <> 'full'",
    "unknown_channel": f"envelope_endpoint = 'specialized' AND {_J.format('content_type')} NOT IN ({_KNOWN})",
    "forbidden_content_type": f"envelope_endpoint = 'tool_schema' AND {_J.format('content_type')} IS NOT NULL",
    "missing_description": f"envelope_endpoint = 'tool_schema' AND {_J.format('description')} IS NULL",
}

_JSON = "replace(replace(replace(CAST(to_json({}) AS VARCHAR), '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')"
_ESC = "replace(replace(replace({}, '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')"

ORACLE = {
    "blank_gate": f"""WITH cut AS (SELECT page_id, string_split(html, '<p>') AS parts FROM pages),
listed AS (SELECT page_id, unnest(range(len(parts))) AS pos, parts FROM cut)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
  pos % 5 = 4 OR regexp_matches(parts[pos + 1], {quoted(_BLANK)}) AS blank FROM listed""",
    "size_gate": f"WITH {_ENVELOPES} SELECT doc_id, strlen(path) + strlen(text) AS bytes, "
    f"strlen(path) + strlen(text) > 102400 AS oversize, {_size_reason('File content', '(strlen(path) + strlen(text))')} AS reason FROM docs",
    "size_gate_sources": f"""WITH t AS (SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source)
SELECT source, bytes, bytes > 102400 AS oversize, {_size_reason('Content', 'bytes')} AS reason,
  CASE WHEN bytes > 102400 THEN 'Content exceeds maximum size of 100KB' END AS violation FROM t""",
    "build_envelope": f"""WITH t AS (SELECT c.*, b.text AS before FROM conversations c
  LEFT JOIN conversations b ON c.conv_id = b.conv_id AND c.turn = b.turn + 1),
e AS (SELECT conv_id, turn, '{{"context":{{"agent_id":"agent-0","session_id":"c' || conv_id ||
  '","source_application":"veilstone"}},' || CASE WHEN before <> '' THEN '"conversation_history":' || {_JSON.format('before')} || ',' ELSE '' END ||
  '"prompt":' || {_JSON.format('text')} || ',"scan_type":"full"}}' AS body FROM t)
SELECT conv_id, turn, sha256(body) AS body_sha, strlen(body)::INT AS body_bytes FROM e""",
    "channel_envelopes": f"""WITH {_ENVELOPES}, e AS (SELECT doc_id, '{{"content":"' || path || '","content_type":"' ||
  CASE WHEN doc_id % 3 <> 0 AND text <> '' THEN 'file_content' ELSE 'file_path' END || '","context":{{"agent_id":"' || source || '"' ||
  CASE WHEN doc_id % 3 <> 0 AND text <> '' THEN ',"file_content":' || {_JSON.format('text')} ELSE '' END ||
  ',"session_id":"batch","source_application":"veilstone"}}}}' AS body FROM docs)
SELECT doc_id, sha256(body) AS body_sha, strlen(body)::INT AS body_bytes FROM e""",
    "tool_schemas": f"""WITH e AS (SELECT page_id, '{{"description":' || {_JSON.format('html')} || ',"input_schema":{{"page":"' || page_id ||
  '"}},"name":' || {_JSON.format('url')} || '}}' AS body FROM pages)
SELECT page_id, sha256(body) AS body_sha, strlen(body)::INT AS body_bytes FROM e""",
    "resolve_identity": """WITH b AS (SELECT *, 'u' || user_id AS u FROM events)
SELECT event_id, 'session_id' AS key, CASE WHEN event_id % 7 = 0 THEN 'extra' WHEN event_id % 3 = 0 THEN u ELSE 'default-session' END AS value FROM b
UNION ALL SELECT event_id, 'agent_id', CASE WHEN event_id % 4 = 0 THEN u WHEN event_id % 5 = 0 THEN 'env-agent' ELSE 'default-agent' END FROM b
UNION ALL SELECT event_id, 'source_application', 'veilstone' FROM b
UNION ALL SELECT event_id, 'role', 'agent' FROM b WHERE event_id % 2 = 0""",
    "route_channel": """WITH t AS (SELECT doc_id, doc_id % 4 <> 0 AND coalesce(text, '') <> '' AS has_body,
  CASE doc_id % 6 WHEN 1 THEN 'sql' WHEN 2 THEN 'mcp_schema' WHEN 4 THEN 'command' WHEN 5 THEN 'a2a_message' END AS other FROM documents)
SELECT doc_id, coalesce(other, CASE WHEN has_body THEN 'file_content' ELSE 'file_path' END) AS channel FROM t""",
    "encode_rag_chunks": f"""WITH cut AS (SELECT page_id, string_split(html, '<p>') AS parts FROM pages),
listed AS (SELECT page_id, unnest(range(len(parts))) AS pos, parts FROM cut),
chunks AS (SELECT page_id, pos, parts[pos + 1] AS chunk FROM listed WHERE NOT regexp_matches(parts[pos + 1], {quoted(_BLANK)})),
enc AS (SELECT page_id, count(*) AS n, CASE WHEN count(*) = 1 THEN any_value(chunk)
  ELSE {_ESC.format('CAST(to_json(list(chunk ORDER BY pos)) AS VARCHAR)')} END AS content FROM chunks GROUP BY page_id)
SELECT page_id, n AS n_chunks, sha256(content) AS content_sha, strlen(content) AS content_bytes,
  strlen(content) > 102400 AS oversize, true AS size_agrees FROM enc""",
    "content_hash": f"WITH {_ENVELOPES} SELECT doc_id, sha256('file_content:' || path) AS bare_hash, "
    f"{_FULL_HASH.format(c=quoted('file_content'))} AS full_hash FROM docs",
    "rule_screen": f"""WITH {_SCREENED}, h AS (SELECT doc_id, channel, {_rule_pick('hit')} FROM s)
SELECT doc_id, channel, {_BLOCKED} AS blocked, {_by_rule(_ACTIONS, "'allow'")} AS action,
  {_by_rule(_RULE_TYPES, 'NULL')} AS threat_type, {_by_rule(_RULE_LEVEL, 'NULL')} AS confidence FROM h""",
    "rule_screen_table": f"""WITH w AS (SELECT *, list_slice(regexp_extract_all(text, '[A-Za-z]+'), 1, 3) AS words FROM benchmark),
rules AS (SELECT {', '.join(f"{sql} AS {name}" for name, sql in TABLE_RULES.items())},
  '(?i)\\b' || array_to_string(words, '\\W+') || '\\b' AS regex FROM w WHERE len(words) = 3),
hit AS (SELECT doc_id, action, reason FROM documents d JOIN rules r ON r.channel = 'sql' AND regexp_matches(d.text, r.regex)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE action WHEN 'block' THEN 0 WHEN 'require_approval' THEN 1 ELSE 2 END, pos) = 1)
SELECT doc_id, coalesce(action, 'allow') AS action, reason FROM documents LEFT JOIN hit USING (doc_id)""",
    "rule_screen_strictest": f"WITH {_SCREENED}, h AS (SELECT doc_id, {_rule_pick('hit', 'strictest')} FROM s) "
    f"SELECT doc_id, {_by_rule(_ACTIONS, quoted('allow'))} AS action FROM h",
    "dedup_scans": f"""WITH s AS (SELECT doc_id, 'sql' AS channel, text AS content FROM documents),
h AS (SELECT doc_id, content, {_rule_pick('hit')} FROM s)
SELECT doc_id, sha256('channel=3:sqltext=' || strlen(content) || ':' || content) AS content_hash, {_BLOCKED} AS blocked,
  {_by_rule(_ACTIONS, "'allow'")} AS action, {_by_rule(_RULE_TYPES, 'NULL')} AS threat_type FROM h""",
    "channel_contexts": _contexts_sql(),
    "dedup_scans_expiring": f"""{EXPIRING} SELECT request_id, content_hash, scan_id, scan_id = request_id AS scanned, action, blocked
FROM shared JOIN (SELECT request_id AS scan_id, action, blocked FROM clean) USING (scan_id)""",
    "dedup_expiry_stats": f"""{EXPIRING} SELECT count(*) FILTER (WHERE scan_id <> request_id) AS hits,
  count(*) FILTER (WHERE scan_id = request_id) AS misses, round(count(*) FILTER (WHERE scan_id <> request_id) / count(*), 6) AS hit_rate
FROM shared""",
    "dedup_stats": """SELECT count(*) - count(DISTINCT text) AS hits, count(DISTINCT text) AS misses, count(DISTINCT text) AS size,
  round((count(*) - count(DISTINCT text)) / count(*), 6) AS hit_rate FROM documents""",
    "extract_user_content": _extract_sql("role = 'user' AND ((kind IS NULL AND text <> '') OR kind = 'text')"),
    "extract_user_content_blocks": _extract_sql("role = 'user' AND (kind IS NULL OR kind = 'text')"),
    "extract_user_content_contents": _extract_sql("role IN ('', 'user') AND text <> ''"),
    "guard_decision": f"{READ}, {_ANSWERED} {_decision('closed')} UNION ALL {_decision('open')}",
    "prompt_guard": f"""WITH {_PARTS}, said AS (
  SELECT conv_id, coalesce(string_agg(CASE WHEN conv_id % 9 = 0 THEN repeat(text, 400) ELSE text END, chr(10) ORDER BY turn)
    FILTER (WHERE role = 'user' AND ((kind IS NULL AND text <> '') OR kind = 'text')), '') AS content
  FROM parts GROUP BY conv_id),
hit AS (SELECT conv_id, strlen(content) AS content_bytes, CASE WHEN regexp_matches(content, {quoted(_BLANK)}) THEN 'blank'
  WHEN strlen(content) > 102400 THEN 'over' WHEN contains(lower(content), 'ignore previous') THEN 'injection'
  WHEN regexp_matches(content, 'SSN|-') THEN 'pii' ELSE 'clear' END AS found FROM said)
SELECT conv_id, content_bytes, CASE WHEN found IN ('blank', 'clear') THEN 'proceed' ELSE 'blocked' END AS outcome,
  CASE found WHEN 'blank' THEN 'No content to scan'
    WHEN 'over' THEN 'Request blocked: Content too large (' || (content_bytes // 1024) || 'KB > 100KB limit)'
    WHEN 'injection' THEN 'Request blocked: Prompt injection detected' WHEN 'pii' THEN 'Request blocked: PII detected' END AS decision_reason,
  CASE found WHEN 'over' THEN 'size_limit_exceeded' WHEN 'injection' THEN 'prompt_injection' WHEN 'pii' THEN 'pii_exposure' END AS threat_type,
  CASE WHEN found IN ('over', 'injection', 'pii') THEN 'high' END AS confidence FROM hit""",
    "policy_match": f"""{READ}, policies(type, action, threshold) AS (VALUES {', '.join(f"('{t}', '{a}', {x})" for t, a, x in POLICIES)}),
met AS (SELECT request_id, max((CASE p.action WHEN 'allow' THEN '1' WHEN 'warn' THEN '2' WHEN 'require_approval' THEN '3'
    WHEN 'block' THEN '4' ELSE '0' END) || p.action) AS r
  FROM named n JOIN policies p ON n.mapped_type = p.type AND n.score >= p.threshold GROUP BY request_id)
SELECT request_id, mapped_type AS threat_type, substr(r, 2) AS policy_action FROM named LEFT JOIN met USING (request_id)""",
    "request_contract_audit": f"WITH {events_cte()} " + " UNION ALL ".join(
        f"SELECT request_id, '{name}' AS rule FROM ev WHERE {rule}" for name, rule in _BREAKS.items()
    ),
    "missing_scans": f"{READ}, {_ANSWERED} SELECT request_id, channel FROM asked WHERE request_id NOT IN (SELECT request_id FROM answered)",
    "unused_channels": f"WITH {events_cte()} SELECT * FROM (VALUES {', '.join(f'({quoted(c)})' for c in CHANNELS)}) t(channel) "
    "EXCEPT SELECT channel FROM ev",
}
