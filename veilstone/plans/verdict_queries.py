"""Registered queries over raw verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions import dims
from veilstone.functions import verdicts as V
from veilstone.operators import verdicts as ops
from veilstone.plans.duckdb_sql import quoted
from veilstone.plans.views import events_cte, event_requests


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return event_requests(spark, folder, "raw").select("request_id", "raw")


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sanitize_verdict(_raw(spark, folder), ["request_id"])


def parse_verdict(spark: SparkSession, folder: str) -> DataFrame:
    read = ops.parse_verdict(_raw(spark, folder))
    return read.select(
        "request_id", "parsed", F.col("safe").cast("string").alias("safe"), "action", "refuse_tier", "reason",
        "content_type", "content_origin", "raw_severity", F.round(F.col("score"), 6).alias("score"), "held_by_scope",
    )


def normalize_threat_type(spark: SparkSession, folder: str) -> DataFrame:
    typed = ops.parse_verdict(_raw(spark, folder)).select(
        "request_id", F.when(F.col("parsed"), V.text_of(F.col("v.threat_type"))).alias("raw_type")
    )
    return ops.normalize_threat_type(typed, "raw_type").select("request_id", "threat_type")


def derive_severity(spark: SparkSession, folder: str) -> DataFrame:
    read = ops.parse_verdict(_raw(spark, folder)).select("request_id", "raw_threat_type", "raw_severity")
    return ops.classify_threat(read, "raw_threat_type", "raw_severity").select("request_id", "severity")


def bucket_confidence(spark: SparkSession, folder: str) -> DataFrame:
    read = ops.parse_verdict(_raw(spark, folder))
    return read.select("request_id", V.bucket_confidence(F.col("score")).alias("confidence"))


def sanitize_violations(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sanitize_violations(_raw(spark, folder), "request_id")


def effective_threat_type(spark: SparkSession, folder: str) -> DataFrame:
    return ops.parse_verdict(_raw(spark, folder)).select("request_id", F.col("raw_threat_type").alias("threat_code"))


def fill_guidance(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).where(~F.col("safe")).select("request_id", "reason", "guidance")


def sanitize_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select(
        "request_id", "parsed", F.col("safe").cast("string").alias("safe"), "reason", "threat_type", "severity", "confidence", "guidance", "action",
        "refuse_tier", "content_type", "content_origin", "held_by_scope",
        F.coalesce(F.array_size("violations"), F.lit(0)).alias("n_violations"),
        V.text_of(V.field(F.col("recovery"), "instruction")).alias("instruction"),
        F.col("session_state").isNotNull().alias("has_session_state"),
        F.to_json("content_verdict").alias("content_verdict"),
    )


def is_blocked(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).where("parsed").select("request_id", "blocked")


def attribute_origin(spark: SparkSession, folder: str) -> DataFrame:
    requests = event_requests(spark, folder, "channel").select("request_id", "channel")
    odd = F.when(F.col("request_id") % 17 == 0, F.lit("hologram")).otherwise(
        F.when(F.col("request_id") % 3 == 0, F.lit("rag_context")).otherwise(
            F.when(F.col("request_id") % 7 == 0, F.lit("prompt")).otherwise(F.col("channel"))
        )
    )
    return ops.attribute_origin(requests.withColumn("channel", odd))


def block_feedback(spark: SparkSession, folder: str) -> DataFrame:
    clean = _clean(spark, folder).where("parsed")
    text = V.block_feedback(
        *[F.col(c) for c in ("action", "reason", "guidance", "threat_type", "recovery", "session_state")]
    )
    return clean.select("request_id", text.alias("feedback"))


def verdict_contract_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ops.verdict_contract_audit(_raw(spark, folder))


def verdict_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rolled = ops.verdict_rollup(_clean(spark, folder).where("parsed"), ["threat_type", "severity", "action"])
    return rolled.withColumn("blocked_rate", F.round("blocked_rate", 6))


def verdict_rollup_origin(spark: SparkSession, folder: str) -> DataFrame:
    rolled = ops.verdict_rollup(_clean(spark, folder).where("parsed"), ["content_origin", "content_type"])
    return rolled.withColumn("blocked_rate", F.round("blocked_rate", 6))


def top_threats(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_threats(_clean(spark, folder), 5)


QUERIES = {
    "parse_verdict": parse_verdict,
    "normalize_threat_type": normalize_threat_type,
    "derive_severity": derive_severity,
    "bucket_confidence": bucket_confidence,
    "sanitize_violations": sanitize_violations,
    "effective_threat_type": effective_threat_type,
    "fill_guidance": fill_guidance,
    "sanitize_verdict": sanitize_verdict,
    "is_blocked": is_blocked,
    "attribute_origin": attribute_origin,
    "block_feedback": block_feedback,
    "verdict_contract_audit": verdict_contract_audit,
    "verdict_rollup": verdict_rollup,
    "verdict_rollup_origin": verdict_rollup_origin,
    "top_threats": top_threats,
}


def _text(path: str, source: str = "j") -> str:
    return (
        f"CASE WHEN json_type({source}, '{path}') = 'VARCHAR' "
        f"THEN nullif(json_extract_string({source}, '{path}'), '') END"
    )


def _values(columns: str, rows: list[tuple[str, ...]], name: str) -> str:
    body = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


_CODES = _values("code, mapped", [(c, n) for n, cs in dims.THREAT_CODES.items() for c in cs], "codes")
_NAMES = _values("name, default_severity, guide", [(n, s, dims.GUIDANCE[n]) for n, s in dims.SEVERITY.items()], "names")


def mapped_sql(raw: str) -> str:
    return (
        f"coalesce((SELECT mapped FROM codes WHERE code = replace(lower({raw}), '-', '_')), "
        f"CASE WHEN starts_with(replace(lower({raw}), '-', '_'), 'multi_turn_') THEN 'multi_turn_attack' END, 'unknown')"
    )


_BUCKET = (
    "CASE WHEN score IS NULL THEN 'medium' WHEN score >= 0.9 THEN 'high' WHEN score >= 0.7 THEN 'medium' "
    "ELSE 'low' END"
)

READ = f"""WITH {events_cte()},
{_CODES}, {_NAMES},
loaded AS (SELECT *, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS j FROM ev),
fields AS (
  SELECT request_id, ts, session_id, agent_id, channel, tool, j, json_valid(raw) AS parsed,
    CASE WHEN json_valid(raw) THEN CASE WHEN json_type(j, '$.safe') = 'BOOLEAN'
         THEN CAST(json_extract_string(j, '$.safe') AS BOOLEAN) ELSE true END END AS safe,
    {_text('$.action')} AS action, {_text('$.refuse_tier')} AS refuse_tier, {_text('$.reason')} AS given_reason,
    {_text('$.content_type')} AS content_type, {_text('$.content_origin')} AS content_origin,
    {_text('$.severity')} AS raw_severity, {_text('$.threat_type')} AS top_type,
    coalesce({_text('$.threat_type')}, {_text('$.violations[0].threat_type')}) AS raw_threat_type,
    CASE WHEN json_type(j, '$.confidence') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
         THEN CAST(json_extract_string(j, '$.confidence') AS DOUBLE) END AS score,
    coalesce(json_type(j, '$.held_by_scope') = 'BOOLEAN' AND json_extract_string(j, '$.held_by_scope') = 'true',
             false) AS held_by_scope
  FROM loaded),
named AS (SELECT *, {mapped_sql('raw_threat_type')} AS mapped_type FROM fields),
clean AS (
  SELECT n.*, CASE WHEN NOT safe THEN mapped_type END AS threat_type,
    CASE WHEN NOT safe THEN CASE WHEN lower(raw_severity) IN ('critical', 'high', 'medium', 'low')
         THEN lower(raw_severity) ELSE default_severity END END AS severity,
    CASE WHEN NOT safe THEN {_BUCKET} END AS confidence,
    CASE WHEN NOT safe THEN guide END AS guidance,
    coalesce(given_reason, CASE WHEN NOT safe THEN guide END) AS reason,
    CASE WHEN action IN ('allow', 'warn') THEN false WHEN action IN ('block', 'require_approval') THEN true
         ELSE NOT safe END AS blocked
  FROM named n JOIN names ON n.mapped_type = names.name)"""

_INTERNAL = ", ".join(quoted(k) for k in dims.INTERNAL_KEYS)
_TIERS = ", ".join(quoted(t) for t in dims.TIERS)
_ORIGINS = ", ".join(quoted(t) for t in dims.ORIGINS)


def _items(path: str) -> str:
    return (
        f"CASE WHEN json_type(j, '{path}') = 'ARRAY' AND json_array_length(j, '{path}') > 0 "
        f"THEN array_to_string(CAST(json_extract(j, '{path}') AS VARCHAR[]), ', ') END"
    )


FEEDBACK = f"""concat_ws(chr(10),
  CASE lower(action) WHEN 'warn' THEN {quoted(V.FEEDBACK_LEAD['warn'])}
    WHEN 'require_approval' THEN {quoted(V.FEEDBACK_LEAD['require_approval'])} ELSE {quoted(V.FEEDBACK_LEAD['block'])} END,
  'Reason: ' || coalesce(reason, guidance), 'Threat type: ' || threat_type,
  'Session risk: ' || regexp_replace(CAST(CAST(json_extract_string(j, '$.session_state.session_risk_score') AS DOUBLE) AS VARCHAR), '[.]0$', '')
    || ' (turn ' || json_extract_string(j, '$.session_state.session_turn_number') || ')',
  'Patterns triggered: ' || coalesce({_items('$.recovery.patterns_triggered')}, {_items('$.session_state.session_patterns')}),
  'Recovery: ' || {_text('$.recovery.instruction')}, 'Available tools: ' || {_items('$.recovery.available_tools')})"""

_RULES = {
    "missing_tier": "refuse_tier IS NULL",
    "unknown_tier": f"refuse_tier NOT IN ({_TIERS})",
    "missing_recovery": "coalesce(json_type(j, '$.recovery'), '') <> 'OBJECT'",
    "missing_session_state": "coalesce(json_type(j, '$.session_state'), '') <> 'OBJECT'",
    "unknown_origin": f"content_origin NOT IN ({_ORIGINS})",
    "internal_key": " OR ".join(f"json_exists(j, '$.{k}')" for k in dims.INTERNAL_KEYS),
}

_ROLLUP = """SELECT {shown}, count(*) AS n, count(*) FILTER (WHERE blocked) AS n_blocked,
  round(count(*) FILTER (WHERE blocked) / count(*), 6) AS blocked_rate
FROM (SELECT {named}, blocked FROM clean WHERE parsed) GROUP BY CUBE ({keys})"""


def _rollup(*keys: str) -> str:
    return f"{READ} " + _ROLLUP.format(
        shown=", ".join(f"CASE WHEN grouping({k}) = 1 THEN '(all)' ELSE {k} END AS {k}" for k in keys),
        named=", ".join(f"coalesce({k}, '(none)') AS {k}" for k in keys),
        keys=", ".join(keys),
    )


ORACLE = {
    "parse_verdict": f"{READ} SELECT request_id, parsed, CAST(safe AS VARCHAR) AS safe, action, refuse_tier, given_reason AS reason, content_type, "
    "content_origin, raw_severity, round(score, 6) AS score, held_by_scope FROM fields",
    "normalize_threat_type": f"{READ} SELECT request_id, {mapped_sql('top_type')} AS threat_type FROM fields",
    "derive_severity": f"{READ} SELECT request_id, CASE WHEN lower(raw_severity) IN ('critical', 'high', 'medium', 'low') "
    "THEN lower(raw_severity) ELSE default_severity END AS severity FROM named JOIN names ON mapped_type = name",
    "bucket_confidence": f"{READ} SELECT request_id, {_BUCKET} AS confidence FROM fields",
    "sanitize_violations": f"""{READ},
items AS (
  SELECT request_id, unnest(range(CAST(json_array_length(j, '$.violations') AS BIGINT))) AS idx, json_extract(j, '$.violations[*]') AS elems
  FROM fields WHERE json_type(j, '$.violations') = 'ARRAY'),
objects AS (
  SELECT request_id, idx, elems[idx + 1] AS item,
         row_number() OVER (PARTITION BY request_id ORDER BY idx) - 1 AS pos
  FROM items WHERE json_type(elems[idx + 1]) = 'OBJECT'),
fields_of AS (SELECT request_id, pos, item, unnest(json_keys(item)) AS field FROM objects)
SELECT request_id, CAST(pos AS INTEGER) AS pos, field, CAST(json_extract(item, '$.' || field) AS VARCHAR) AS value
FROM fields_of WHERE field NOT IN ({_INTERNAL})""",
    "effective_threat_type": f"{READ} SELECT request_id, raw_threat_type AS threat_code FROM fields",
    "fill_guidance": f"{READ} SELECT request_id, reason, guidance FROM clean WHERE NOT safe",
    "sanitize_verdict": f"""{READ} SELECT request_id, parsed, CAST(safe AS VARCHAR) AS safe, reason, threat_type, severity, confidence, guidance, action,
  refuse_tier, content_type, content_origin, held_by_scope,
  CAST(CASE WHEN json_type(j, '$.violations') = 'ARRAY' THEN
    (SELECT count(*) FROM (SELECT unnest(json_extract(j, '$.violations[*]')) AS x) WHERE json_type(x) = 'OBJECT')
    ELSE 0 END AS INTEGER) AS n_violations,
  {_text('$.recovery.instruction')} AS instruction,
  coalesce(json_type(j, '$.session_state') = 'OBJECT', false) AS has_session_state,
  CAST(json_extract(j, '$.content_verdict') AS VARCHAR) AS content_verdict FROM clean""",
    "is_blocked": f"{READ} SELECT request_id, blocked FROM clean WHERE parsed",
    "attribute_origin": f"""WITH {events_cte()}, {_values('ch, origin', [(c, o) for c, (_, o) in dims.CHANNELS.items()], 'origins')},
odd AS (SELECT request_id, CASE WHEN request_id % 17 = 0 THEN 'hologram' WHEN request_id % 3 = 0 THEN 'rag_context'
  WHEN request_id % 7 = 0 THEN 'prompt' ELSE channel END AS channel FROM ev)
SELECT request_id, channel, coalesce(origin, 'agent_action') AS content_origin,
  coalesce(origin, 'agent_action') = 'human_prompt' AS attributable FROM odd LEFT JOIN origins ON channel = ch""",
    "block_feedback": f"{READ} SELECT request_id, {FEEDBACK} AS feedback FROM clean WHERE parsed",
    "verdict_contract_audit": f"""{READ}, wide AS (SELECT coalesce(content_type, '(none)') AS channel, count(*) AS n,
  {', '.join(f'count(*) FILTER (WHERE {rule}) AS {name}' for name, rule in _RULES.items())}
  FROM fields WHERE parsed GROUP BY 1)
SELECT channel, n, rule, broken FROM (UNPIVOT wide ON {', '.join(_RULES)} INTO NAME rule VALUE broken)""",
    "verdict_rollup": _rollup("threat_type", "severity", "action"),
    "verdict_rollup_origin": _rollup("content_origin", "content_type"),
    "top_threats": f"{READ} SELECT threat_type, count(*) AS n FROM clean WHERE NOT safe GROUP BY 1 ORDER BY n DESC, threat_type LIMIT 5",
}
