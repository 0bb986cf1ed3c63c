"""Registered queries over agent activity: sessions, scopes, reliability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.functions import verdicts as V
from veilstone.functions.dims import values_table
from veilstone.operators import expiry, reliability, scopes, sessions
from veilstone.operators import verdicts as vops
from veilstone.plans.flows import action_scan as action_scan_of
from veilstone.plans.request_queries import EXPIRING
from veilstone.plans.verdict_queries import FEEDBACK, READ
from veilstone.plans.views import declarations_of, event_columns, event_requests, events_cte, scope_declarations, scopes_cte
from veilstone.sources.sinks import run_stream, run_to_end
from veilstone.sources.tables import read_table, stream_table
from veilstone.streaming import windows
from veilstone.streaming.scopes import stream_scope_enforce as stream_scope_enforce_of
from veilstone.streaming.sessions import stream_session_state as stream_session_state_of


def _stamp(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _rotations(spark: SparkSession, folder: str) -> DataFrame:
    read = vops.parse_verdict(event_requests(spark, folder, "raw", "session_id"))
    own = F.when(F.col("user_id") % 2 == 0, F.col("session_id")).otherwise("built-in")
    facts = read.select(
        "request_id", "session_id", own.alias("own_session_id"), "raw_threat_type",
        F.when(F.col("parsed"), V.number_of(V.field(F.col("v.session_state"), "session_risk_score"))).alias("risk"),
    )
    return sessions.evaluate_rotation(facts, "request_id", "raw_threat_type", "risk", "session_id", "own_session_id")


def evaluate_rotation(spark: SparkSession, folder: str) -> DataFrame:
    due = _rotations(spark, folder).where("rotation IS NOT NULL")
    return due.select("request_id", "rotation.*").drop("configured_threshold")


def rotation_next_id(spark: SparkSession, folder: str) -> DataFrame:
    record = F.col("rotation")
    return _rotations(spark, folder).select(
        "request_id", sessions.is_locked(record).alias("locked"), sessions.rotation_next_id(record).alias("next_id")
    )


def session_timeline(spark: SparkSession, folder: str) -> DataFrame:
    events = event_requests(spark, folder, "session_id", "agent_id", "risk")
    lined = sessions.session_timeline(events)
    return lined.select("request_id", "session_id", "turn", "max_risk", "previous_risk")


def latest_session_state(spark: SparkSession, folder: str) -> DataFrame:
    events = event_requests(spark, folder, "session_id", "agent_id", "risk", "tool")
    return sessions.latest_session_state(
        events, ["session_id", "agent_id"], ["ts", "request_id"], ["risk", "tool"]
    ).select("session_id", "agent_id", "turns", "request_id", "risk", "tool", _stamp("ts").alias("at"))


def latest_rotated_state(spark: SparkSession, folder: str) -> DataFrame:
    """A user's next session takes over where the newest verdict of the one before offers a new id."""
    read = vops.parse_verdict(event_requests(spark, folder, "raw", "session_id"))
    own = F.when(F.col("user_id") % 2 == 0, F.col("session_id")).otherwise("built-in")
    facts = read.select(
        "ts", "request_id", "user_id", "session_id", own.alias("own_session_id"), "raw_threat_type",
        F.when(F.col("parsed"), V.number_of(V.field(F.col("v.session_state"), "session_risk_score"))).alias("risk"),
    )
    judged = sessions.evaluate_rotation(facts, "request_id", "raw_threat_type", "risk", "session_id", "own_session_id")
    newest = judged.groupBy("user_id", "session_id").agg(F.max_by("rotation", F.struct("ts", "request_id")).alias("rotation"))
    line = Window.partitionBy("user_id").orderBy("session_id")  # a user's sessions: one for each day
    before = newest.select(
        "session_id", F.lag("session_id").over(line).alias("previous_session_id"),
        F.lag(sessions.rotation_next_id(F.col("rotation"))).over(line).alias("offered"),
    )
    state = sessions.latest_rotated_state(judged, before.where("offered IS NOT NULL"), ["ts", "request_id"], ["risk"])
    return state.select(
        "root", "session", "sessions", "turns", "request_id", "risk", "locked", "rotated", "rotation_recommended", "next_id",
        _stamp("ts").alias("at"),
    )


def session_holds(spark: SparkSession, folder: str) -> DataFrame:
    events = _blocked_events(spark, folder).select("request_id", "ts", "user_id", "session_id", "agent_id", "blocked", "action")
    held = sessions.session_holds(events, F.col("blocked"), F.col("action") == "allow")
    return held.select(
        "session_id", F.col("started.request_id").alias("first_id"), F.col("ended.request_id").alias("last_id"), "released",
        "refusals", "actions_held", "seconds",
    )


def _blocked_events(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    events = event_requests(spark, folder, "session_id", "agent_id", "raw", *more)
    keep = ["request_id", "ts", "user_id", "session_id", "agent_id", *more]
    return vops.sanitize_verdict(events, keep).where("parsed")


def post_refusal_holds(spark: SparkSession, folder: str) -> DataFrame:
    events = _blocked_events(spark, folder).select("request_id", "ts", "user_id", "session_id", "agent_id", "blocked")
    held = sessions.post_refusal_holds(events)
    return held.select("request_id", "session_id", "refusals_before", "refusal_id", "seconds_since_refusal")


def session_isolation_audit(spark: SparkSession, folder: str) -> DataFrame:
    events = event_requests(spark, folder, "session_id", "content")
    return sessions.session_isolation_audit(events.withColumn("content_hash", F.sha2("content", 256)), "content_hash")


def reused_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts that crossed sessions, as a cache with a time to live would have handed them out."""
    events = event_requests(spark, folder, "session_id", "content").where("content IS NOT NULL")
    told = expiry.dedup_within(events, "request_id", "ts", F.sha2("content", 256))
    return sessions.reused_verdicts(told, events)


def shared_session_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions named after the hour of the day and the user's group, so that users do share them."""
    shared = F.concat(F.lit("g"), (F.col("user_id") % 40).cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
    events = event_requests(spark, folder).withColumn("session_id", shared)
    return sessions.shared_session_audit(events)


def _scope_rows(df: DataFrame, *more: str) -> DataFrame:
    def text(c: str) -> Column:
        return F.array_join(F.array_sort(c), ",").alias(c)

    return df.select(
        "agent_id", F.col("seq").cast("bigint").alias("seq"), text("allowed_tools"), text("forbidden_tools"), "purpose",
        F.coalesce("max_duration_seconds", F.lit(-1)).cast("bigint").alias("max_duration_seconds"),
        _stamp("expires_at").alias("expires_at"), *more,
    )


def scope_merge(spark: SparkSession, folder: str) -> DataFrame:
    merged = scopes.scope_merge(scope_declarations(spark, folder))
    return _scope_rows(merged, "active_from", "renewable_seconds").withColumns(
        {"active_from": _stamp("active_from"),
         "renewable_seconds": F.coalesce("renewable_seconds", F.lit(-1)).cast("bigint")}
    )


def scope_change_check(spark: SparkSession, folder: str) -> DataFrame:
    checked = scopes.scope_change_check(scope_declarations(spark, folder))
    return checked.select("agent_id", F.col("seq").cast("bigint").alias("seq"), "status")


def scope_history(spark: SparkSession, folder: str) -> DataFrame:
    return _scope_rows(scopes.scope_history(scope_declarations(spark, folder)))


def scope_expiry(spark: SparkSession, folder: str) -> DataFrame:
    merged = scopes.scope_merge(scope_declarations(spark, folder))
    at = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return scopes.scope_expiry(merged, at).select(
        "agent_id", F.col("seq").cast("bigint").alias("seq"), _stamp("active_until").alias("active_until"), "expired",
        _stamp("renewable_until").alias("renewable_until"), "ceiling_reached",
    )


def _actions(spark: SparkSession, folder: str) -> DataFrame:
    events = event_requests(spark, folder, "agent_id", "tool", "raw")
    clean = vops.sanitize_verdict(events, ["agent_id", "ts", "request_id", "tool"])
    return clean.select("agent_id", "ts", "request_id", "tool", "action", "blocked", "parsed")


def scope_enforce(spark: SparkSession, folder: str) -> DataFrame:
    history = scopes.scope_history(scope_declarations(spark, folder))
    # The filter comes last, so that the pass over scopes needs no verdicts.
    return scopes.scope_enforce(_actions(spark, folder), history).where("parsed").drop("ts", "parsed")


def scope_enforce_limited(spark: SparkSession, folder: str) -> DataFrame:
    history = scopes.scope_history(scope_declarations(spark, folder)).withColumn("most", F.lit(40))
    held = scopes.scope_enforce(_actions(spark, folder).where("parsed"), history, "most")
    return held.where("hold_reason = 'action_limit'").select("agent_id", "request_id", "tool")


def stream_scope_enforce(spark: SparkSession, folder: str) -> DataFrame:
    events = stream_table(spark, folder, "events")
    actions = event_columns(events, "agent_id", "tool")
    held = stream_scope_enforce_of(spark, declarations_of(stream_table(spark, folder, "events")), actions)
    return run_stream(spark, held, "scope-enforce").select("agent_id", "request_id", "tool", "hold_reason")


def action_scan(spark: SparkSession, folder: str) -> DataFrame:
    history = scopes.scope_history(scope_declarations(spark, folder))
    return action_scan_of(event_requests(spark, folder, "agent_id", "tool", "raw"), history).drop("ts")


def _calls(spark: SparkSession, folder: str) -> DataFrame:
    return event_requests(spark, folder, "endpoint", "status", "raw")


def classify_outcome(spark: SparkSession, folder: str) -> DataFrame:
    calls = vops.parse_verdict(_calls(spark, folder))
    outcome = reliability.classify_outcome(F.col("status"), F.col("parsed"))
    return calls.select("request_id", outcome.alias("outcome"))


def failure_runs(spark: SparkSession, folder: str) -> DataFrame:
    calls = event_requests(spark, folder, "endpoint", "status").select("endpoint", "ts", "request_id", "status")
    runs = reliability.failure_runs(calls, ["endpoint"], ["ts", "request_id"], F.col("status") == 200, limit=3)
    return runs.select(
        "endpoint", "failures", F.col("first.request_id").alias("first_id"), F.col("last.request_id").alias("last_id"), "tripped"
    )


def _degraded(spark: SparkSession, folder: str) -> DataFrame:
    return event_requests(spark, folder, "status").select("ts", (F.col("status") != 200).alias("degraded"))


def degraded_rate(spark: SparkSession, folder: str) -> DataFrame:
    rated = reliability.degraded_rate(_degraded(spark, folder), "ts", "degraded")
    return rated.select(_stamp("window_start").alias("window_start"), "n", "n_degraded", F.round("rate", 6).alias("rate"))


def degraded_rate_sliding(spark: SparkSession, folder: str) -> DataFrame:
    rated = reliability.degraded_rate(_degraded(spark, folder), "ts", "degraded", "1 hour", "15 minutes")
    return rated.select(_stamp("window_start").alias("window_start"), "n", "n_degraded", F.round("rate", 6).alias("rate"))


def _triggers(events: DataFrame) -> DataFrame:
    read = vops.parse_verdict(event_columns(events, "raw", "session_id"))
    risk = F.when(F.col("parsed"), V.number_of(V.field(F.col("v.session_state"), "session_risk_score")))
    return read.select("session_id", "ts", "request_id", risk.alias("risk"), F.col("raw_threat_type").alias("threat"))


def session_triggers(spark: SparkSession, folder: str) -> DataFrame:
    found = sessions.session_triggers(_triggers(read_table(spark, folder, "events")))
    return found.select("session_id", "reason", "request_id", "risk")


def stream_session_state(spark: SparkSession, folder: str) -> DataFrame:
    stream = stream_session_state_of(spark, _triggers(stream_table(spark, folder, "events")))
    return run_stream(spark, stream, "session-state").select("session_id", "reason", "request_id", "risk")


def stream_degraded_rate(spark: SparkSession, folder: str) -> DataFrame:
    calls = event_columns(stream_table(spark, folder, "events"), "status")
    marked = calls.select("ts", (F.col("status") != 200).alias("degraded"))
    rated = run_to_end(spark, windows.stream_degraded_rate(marked, "ts", "degraded"), "degraded-rate", ["window_start"])
    return rated.select(_stamp("window_start").alias("window_start"), "n", "n_degraded", F.round("rate", 6).alias("rate"))


def stream_calls_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    calls = event_columns(stream_table(spark, folder, "events"))
    counted = run_to_end(spark, windows.stream_calls_per_minute(calls, "ts", "user_id"), "calls", ["user_id", "slot"])
    return counted.select("user_id", _stamp("slot").alias("slot"), "calls")


def stream_session_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = event_columns(stream_table(spark, folder, "events"), "session_id")
    stretches = windows.stream_session_counts(events, "ts", "session_id", "4 hours")
    counted = run_to_end(spark, stretches, "stretches", ["session_id", "stretch_start"], "complete")
    return counted.select("session_id", _stamp("stretch_start").alias("stretch_start"), "actions")


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    events = event_columns(stream_table(spark, folder, "events"), "content")
    hashed = events.select("ts", F.sha2("content", 256).alias("content_hash"))
    return run_stream(spark, windows.stream_dedup(hashed, "ts", "content_hash"), "dedup").select("content_hash")


def stream_dedup_within(spark: SparkSession, folder: str) -> DataFrame:
    """The table as one batch, so that requests come in the order of time whatever the order of rows."""
    events = event_columns(stream_table(spark, folder, "events"), "content").withColumn("content_hash", F.sha2("content", 256))
    told = windows.stream_dedup_within(spark, events.where("content IS NOT NULL"), "request_id", "ts", "content_hash")
    return run_stream(spark, told, "dedup-within").select(F.col("id").alias("request_id"), "content_hash", "scan_id", "scanned")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    tier = F.when(segment.isin("BUILDING", "HOUSEHOLD"), "community").when(segment == "MACHINERY", "pro").otherwise("enterprise")
    return read_table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), tier.alias("tier"))


def rate_limit_audit(spark: SparkSession, folder: str) -> DataFrame:
    return reliability.rate_limit_audit(event_requests(spark, folder), _customers(spark, folder))


TIGHT = (("community", 1, 50), ("pro", 2, 60), ("enterprise", 2, 70))


def rate_limit_audit_tight(spark: SparkSession, folder: str) -> DataFrame:
    tiers = values_table(spark, ("tier", "per_minute", "per_month"), TIGHT)
    return reliability.rate_limit_audit(event_requests(spark, folder), _customers(spark, folder), tiers=tiers)


QUERIES = {
    "evaluate_rotation": evaluate_rotation,
    "rotation_next_id": rotation_next_id,
    "session_timeline": session_timeline,
    "latest_session_state": latest_session_state,
    "latest_rotated_state": latest_rotated_state,
    "session_holds": session_holds,
    "post_refusal_holds": post_refusal_holds,
    "session_isolation_audit": session_isolation_audit,
    "reused_verdicts": reused_verdicts,
    "shared_session_audit": shared_session_audit,
    "scope_merge": scope_merge,
    "scope_change_check": scope_change_check,
    "scope_history": scope_history,
    "scope_expiry": scope_expiry,
    "scope_enforce": scope_enforce,
    "scope_enforce_limited": scope_enforce_limited,
    "action_scan": action_scan,
    "stream_scope_enforce": stream_scope_enforce,
    "classify_outcome": classify_outcome,
    "failure_runs": failure_runs,
    "degraded_rate": degraded_rate,
    "degraded_rate_sliding": degraded_rate_sliding,
    "rate_limit_audit": rate_limit_audit,
    "rate_limit_audit_tight": rate_limit_audit_tight,
    "session_triggers": session_triggers,
    "stream_session_state": stream_session_state,
    "stream_degraded_rate": stream_degraded_rate,
    "stream_calls_per_minute": stream_calls_per_minute,
    "stream_session_counts": stream_session_counts,
    "stream_dedup": stream_dedup,
    "stream_dedup_within": stream_dedup_within,
}

_ROT = f"""{READ}, facts AS (SELECT request_id, session_id, CASE WHEN user_id % 2 = 0 THEN session_id ELSE 'built-in' END AS own,
  raw_threat_type IS NOT DISTINCT FROM 'session_locked' AS locked,
  CAST(json_extract_string(j, '$.session_state.session_risk_score') AS DOUBLE) AS risk
  FROM fields JOIN (SELECT request_id, user_id FROM ev) USING (request_id)),
rot AS (SELECT *, session_id <> own AS foreign_id, substr(sha256(session_id || '/' || request_id), 1, 32) AS new_id,
  NOT locked AND coalesce(risk >= 0.7, false) AS over_limit FROM facts)"""

_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"

_SCOPED = f"""{scopes_cte()},
merged AS (SELECT agent_id, seq, declared_at,
  last_value(allowed IGNORE NULLS) OVER w AS allowed, last_value(forbidden IGNORE NULLS) OVER w AS forbidden,
  last_value(purpose IGNORE NULLS) OVER w AS purpose, last_value(max_duration_seconds IGNORE NULLS) OVER w AS max_duration_seconds,
  last_value(expires_at IGNORE NULLS) OVER w AS expires_at, first_value(renewable_seconds) OVER w AS renewable_seconds,
  first_value(declared_at) OVER w AS granted_at
  FROM decl WINDOW w AS (PARTITION BY agent_id ORDER BY declared_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
expiring AS (SELECT *, least(declared_at + to_seconds(max_duration_seconds), expires_at) AS active_until,
  granted_at + to_seconds(renewable_seconds) AS renewable_until FROM merged)"""

# One step per declaration: the state after the one before decides.
_OK = (
    "(d.allowed IS NULL OR coalesce(s.allowed, '') = '*' OR len(list_filter(string_split(nullif(d.allowed, ''), ','), "
    "lambda t: NOT list_contains(string_split(coalesce(s.allowed, ''), ','), t))) = 0 OR d.allowed = '') AND (d.forbidden IS NULL OR "
    "s.forbidden IS NULL OR len(list_filter(string_split(s.forbidden, ','), "
    "lambda t: NOT list_contains(string_split(d.forbidden, ','), t))) = 0)"
)
_STEP = f"""walk AS (
  SELECT agent_id, n, seq, declared_at AS granted_at, renewable_seconds AS renewable, 'declared' AS status, allowed, forbidden,
    purpose, max_duration_seconds, expires_at, declared_at, declared_at AS active_from FROM decl WHERE n = 1
  UNION ALL
  SELECT agent_id, n, seq, granted_at, renewable, status,
    CASE WHEN status = 'accepted' THEN coalesce(n_allowed, allowed) ELSE allowed END,
    CASE WHEN status = 'accepted' THEN coalesce(n_forbidden, forbidden) ELSE forbidden END,
    CASE WHEN status = 'accepted' THEN coalesce(n_purpose, purpose) ELSE purpose END,
    CASE WHEN status = 'accepted' THEN coalesce(n_max, max_duration_seconds) ELSE max_duration_seconds END,
    CASE WHEN status = 'accepted' THEN coalesce(n_expires, expires_at) ELSE expires_at END, declared_at,
    CASE WHEN status = 'accepted' THEN declared_at ELSE active_from END
  FROM (SELECT s.agent_id, d.n, d.seq, s.granted_at, s.renewable, s.allowed, s.forbidden, s.purpose, s.max_duration_seconds,
      s.expires_at, s.active_from, d.declared_at, d.allowed AS n_allowed, d.forbidden AS n_forbidden, d.purpose AS n_purpose,
      d.max_duration_seconds AS n_max, d.expires_at AS n_expires,
      CASE WHEN d.declared_at > s.granted_at + to_seconds(s.renewable) THEN 'ceiling_reached' WHEN {_OK} THEN 'accepted'
        ELSE 'widening' END AS status
    FROM walk s JOIN decl d ON d.agent_id = s.agent_id AND d.n = s.n + 1))"""

_ENFORCED = f"""{READ.replace('WITH ', 'WITH RECURSIVE ', 1)}, {scopes_cte()}, {_STEP},
hist AS (SELECT *, least(active_from + to_seconds(max_duration_seconds), expires_at) AS active_until
  FROM walk WHERE status IN ('declared', 'accepted')
  QUALIFY row_number() OVER (PARTITION BY agent_id, declared_at ORDER BY seq DESC) = 1),
acts AS (SELECT request_id, agent_id, ts, tool, action, blocked FROM clean WHERE parsed),
placed AS (SELECT a.*, h.allowed, h.forbidden, h.active_until, h.declared_at AS scope_at, h.agent_id AS scope_agent
  FROM acts a ASOF LEFT JOIN hist h ON a.agent_id = h.agent_id AND a.ts >= h.declared_at),
reasoned AS (SELECT *, CASE WHEN scope_agent IS NULL THEN NULL WHEN ts >= active_until THEN 'expired'
  WHEN list_contains(string_split(forbidden, ','), tool) THEN 'forbidden'
  WHEN NOT (allowed = '*' OR list_contains(string_split(allowed, ','), tool)) THEN 'not_allowed' END AS hold_reason,
  scope_agent IS NOT NULL AND row_number() OVER (PARTITION BY agent_id, scope_at ORDER BY ts, request_id) > 40 AS over_limit
  FROM placed),
waiting AS (SELECT *, hold_reason IS NOT NULL AND NOT (blocked AND action IS DISTINCT FROM 'require_approval') AS waits FROM reasoned)"""

_TIERS = "(VALUES ('community', 10, 1000), ('pro', 100, 25000), ('enterprise', 1000, 1000000))"
_TIGHT = "(VALUES " + ", ".join(str(t) for t in TIGHT) + ")"


def _rates(tiers: str) -> str:
    return f"""WITH limits AS (SELECT * FROM {tiers} t(tier, per_minute, per_month)),
cust AS (SELECT c_custkey AS user_id, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'community'
  WHEN c_mktsegment = 'MACHINERY' THEN 'pro' ELSE 'enterprise' END AS tier FROM customer),
used AS (SELECT user_id, 'minute' AS period, date_trunc('minute', ts) AS slot, count(*) AS calls FROM events GROUP BY ALL
  UNION ALL SELECT user_id, 'month', date_trunc('month', ts), count(*) FROM events GROUP BY ALL)
SELECT user_id, tier, period, count(*) AS windows, max(calls) AS max_calls,
  count(*) FILTER (WHERE calls > CASE period WHEN 'minute' THEN per_minute ELSE per_month END) AS windows_over
FROM used LEFT JOIN cust USING (user_id) LEFT JOIN limits USING (tier) GROUP BY user_id, tier, period"""


_TRIGGERS = f"""{READ}, facts AS (SELECT request_id, session_id, ts, raw_threat_type IS NOT DISTINCT FROM 'session_locked' AS locked,
  CAST(json_extract_string(j, '$.session_state.session_risk_score') AS DOUBLE) AS risk FROM fields)
SELECT session_id, CASE WHEN locked THEN 'session_locked' ELSE 'risk_threshold_exceeded' END AS reason,
  arg_min(request_id, (ts, request_id)) AS request_id, first(risk ORDER BY ts, request_id) AS risk
FROM facts WHERE locked OR risk >= 0.7 GROUP BY session_id, locked"""

ORACLE = {
    "evaluate_rotation": f"""{_ROT} SELECT request_id, NOT locked AND NOT foreign_id AS rotated,
  NOT locked AND foreign_id AS rotation_recommended, CASE WHEN foreign_id THEN 'caller' ELSE 'sdk_client' END AS owner,
  CASE WHEN locked THEN 'session_locked' ELSE 'risk_threshold_exceeded' END AS reason,
  CASE WHEN NOT locked AND NOT foreign_id THEN own END AS previous_session_id,
  CASE WHEN NOT locked AND NOT foreign_id THEN new_id END AS new_session_id,
  CASE WHEN locked OR foreign_id THEN session_id END AS current_session_id,
  CASE WHEN NOT locked AND foreign_id THEN new_id END AS suggested_new_session_id, risk AS triggering_risk_score
FROM rot WHERE locked OR over_limit""",
    "rotation_next_id": f"{_ROT} SELECT request_id, locked, CASE WHEN over_limit THEN new_id END AS next_id FROM rot",
    "session_timeline": f"""WITH {events_cte()} SELECT request_id, session_id, row_number() OVER w AS turn,
  max(risk) OVER w AS max_risk, lag(risk) OVER w AS previous_risk FROM ev
WINDOW w AS (PARTITION BY user_id, session_id, agent_id ORDER BY ts, request_id)""",
    "latest_session_state": f"""WITH {events_cte()} SELECT session_id, agent_id, count(*) OVER (PARTITION BY session_id, agent_id) AS turns,
  request_id, risk, tool, {_STAMP.format('ts')} AS at FROM ev
QUALIFY row_number() OVER (PARTITION BY session_id, agent_id ORDER BY ts DESC, request_id DESC) = 1""",
    "latest_rotated_state": f"""{_ROT.replace('WITH ', 'WITH RECURSIVE ', 1)},
timed AS (SELECT rot.*, ev.ts, ev.user_id, CASE WHEN over_limit THEN new_id END AS offered FROM rot JOIN ev USING (request_id)),
newest AS (SELECT * FROM timed QUALIFY row_number() OVER (PARTITION BY timed.session_id ORDER BY ts DESC, request_id DESC) = 1),
lined AS (SELECT user_id, session_id, lag(session_id) OVER w AS before_id, lag(offered) OVER w AS offered_before FROM newest
  WINDOW w AS (PARTITION BY user_id ORDER BY session_id)),
chain AS (SELECT session_id, session_id AS root FROM lined WHERE offered_before IS NULL
  UNION ALL SELECT l.session_id, c.root FROM chain c JOIN lined l ON l.before_id = c.session_id AND l.offered_before IS NOT NULL),
turns AS (SELECT root, count(*) AS turns, count(DISTINCT session_id) AS sessions FROM timed JOIN chain USING (session_id) GROUP BY root)
SELECT root, session_id AS session, sessions, turns, request_id, risk, locked, over_limit AND NOT foreign_id AS rotated,
  over_limit AND foreign_id AS rotation_recommended, offered AS next_id, {_STAMP.format('ts')} AS at
FROM newest JOIN chain USING (session_id) JOIN turns USING (root)
QUALIFY row_number() OVER (PARTITION BY root ORDER BY ts DESC, request_id DESC) = 1""",
    "session_holds": f"""{READ}, marked AS (SELECT request_id, session_id, agent_id, ts, coalesce(blocked, false) AS refuses,
  coalesce(action = 'allow', false) AND NOT coalesce(blocked, false) AS releases FROM clean WHERE parsed),
passed AS (SELECT *, coalesce(last_value(CASE WHEN refuses THEN true WHEN releases THEN false END IGNORE NULLS) OVER w, false) AS held,
  coalesce(count(CASE WHEN releases THEN 1 END) OVER w, 0) AS part FROM marked
  WINDOW w AS (PARTITION BY session_id, agent_id ORDER BY ts, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
folded AS (SELECT session_id, agent_id, part, arg_min(CASE WHEN refuses THEN request_id END, (ts, request_id)) AS first_id,
  min(CASE WHEN refuses THEN ts END) AS first_ts,
  arg_min(request_id, (ts, request_id)) FILTER (WHERE releases AND held) AS release_id, min(CASE WHEN releases AND held THEN ts END) AS release_ts,
  arg_max(request_id, (ts, request_id)) FILTER (WHERE refuses OR held) AS end_id, max(CASE WHEN refuses OR held THEN ts END) AS end_ts,
  count(*) FILTER (WHERE refuses) AS refusals, count(*) FILTER (WHERE held AND NOT releases) AS actions_held FROM passed GROUP BY ALL)
SELECT session_id, first_id, coalesce(release_id, end_id) AS last_id, release_id IS NOT NULL AS released, refusals, actions_held,
  (epoch_us(coalesce(release_ts, end_ts)) - epoch_us(first_ts)) // 1000000 AS seconds FROM folded WHERE first_ts IS NOT NULL""",
    "post_refusal_holds": f"""{READ}, lined AS (SELECT request_id, session_id, ts,
  sum(CASE WHEN blocked THEN 1 ELSE 0 END) OVER w AS refusals_before,
  last_value(CASE WHEN blocked THEN request_id END IGNORE NULLS) OVER w AS refusal_id,
  last_value(CASE WHEN blocked THEN ts END IGNORE NULLS) OVER w AS refusal_ts FROM clean WHERE parsed
  WINDOW w AS (PARTITION BY session_id, agent_id ORDER BY ts, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT request_id, session_id, CAST(refusals_before AS BIGINT) AS refusals_before, refusal_id,
  (epoch_us(ts) - epoch_us(refusal_ts)) // 1000000 AS seconds_since_refusal FROM lined WHERE refusals_before > 0""",
    "session_isolation_audit": f"""WITH {events_cte()} SELECT sha256(content) AS content_hash, count(DISTINCT session_id) AS sessions,
  count(*) AS requests FROM ev GROUP BY 1 HAVING count(DISTINCT session_id) > 1""",
    "reused_verdicts": f"""{EXPIRING}, met AS (SELECT s.content_hash, s.scan_id <> s.request_id AS reused, h.session_id AS here,
  h.session_id IS DISTINCT FROM t.session_id AS elsewhere
  FROM shared s JOIN ev h ON h.request_id = s.request_id JOIN ev t ON t.request_id = s.scan_id WHERE s.content_hash IS NOT NULL)
SELECT content_hash, count(*) AS requests, count(*) FILTER (WHERE reused) AS reused, count(*) FILTER (WHERE reused AND elsewhere) AS across,
  count(DISTINCT CASE WHEN reused AND elsewhere THEN here END) AS sessions FROM met GROUP BY content_hash
HAVING count(*) FILTER (WHERE reused AND elsewhere) > 0""",
    "shared_session_audit": """SELECT 'g' || (user_id % 40) || '-' || strftime(ts, '%Y%m%d') AS session_id,
  count(DISTINCT user_id) AS users, count(*) AS requests FROM events GROUP BY 1 HAVING count(DISTINCT user_id) > 1""",
    "scope_merge": f"""WITH {_SCOPED} SELECT agent_id, seq, allowed AS allowed_tools, forbidden AS forbidden_tools, purpose,
  CAST(coalesce(max_duration_seconds, -1) AS BIGINT) AS max_duration_seconds, {_STAMP.format('expires_at')} AS expires_at,
  {_STAMP.format('declared_at')} AS active_from, CAST(coalesce(renewable_seconds, -1) AS BIGINT) AS renewable_seconds FROM merged""",
    "scope_change_check": f"WITH RECURSIVE {scopes_cte()}, {_STEP} SELECT agent_id, seq, status FROM walk",
    "scope_history": f"""WITH RECURSIVE {scopes_cte()}, {_STEP} SELECT agent_id, seq, allowed AS allowed_tools, forbidden AS forbidden_tools, purpose,
  CAST(coalesce(max_duration_seconds, -1) AS BIGINT) AS max_duration_seconds, {_STAMP.format('expires_at')} AS expires_at
FROM walk WHERE status IN ('declared', 'accepted')""",
    "scope_expiry": f"""WITH {_SCOPED} SELECT agent_id, seq, {_STAMP.format('active_until')} AS active_until,
  coalesce(TIMESTAMP '2024-01-20 12:00:00' >= active_until, false) AS expired, {_STAMP.format('renewable_until')} AS renewable_until,
  coalesce(TIMESTAMP '2024-01-20 12:00:00' > renewable_until, false) AS ceiling_reached FROM expiring""",
    "scope_enforce": f"""{_ENFORCED} SELECT agent_id, request_id, tool, CASE WHEN waits THEN 'require_approval' ELSE action END AS action,
  blocked, hold_reason, hold_reason IS NOT NULL AS held_by_scope, CASE WHEN waits THEN action END AS content_action FROM waiting""",
    "stream_scope_enforce": f"{_ENFORCED.replace('FROM clean WHERE parsed', 'FROM clean')} SELECT agent_id, request_id, tool, hold_reason FROM waiting",
    "scope_enforce_limited": f"{_ENFORCED} SELECT agent_id, request_id, tool FROM waiting WHERE hold_reason IS NULL AND over_limit",
    "action_scan": f"""{_ENFORCED},
final AS (SELECT w.agent_id, request_id, w.tool, CASE WHEN waits THEN 'require_approval' ELSE w.action END AS action, hold_reason,
  hold_reason IS NOT NULL AS held_by_scope, CASE WHEN waits THEN w.action END AS content_action,
  hold_reason IS NOT NULL OR w.blocked AS refused, c.reason, c.guidance, c.threat_type, c.j
  FROM waiting w JOIN clean c USING (request_id))
SELECT agent_id, request_id, tool, action, hold_reason, held_by_scope, content_action, refused,
  CASE WHEN refused THEN {FEEDBACK} END AS feedback FROM final""",
    "classify_outcome": f"""{READ} SELECT request_id, CASE WHEN status >= 500 THEN 'retryable' WHEN status <> 200 THEN 'final'
  WHEN parsed THEN 'ok' ELSE 'retryable' END AS outcome FROM fields JOIN (SELECT request_id, status FROM ev) USING (request_id)""",
    "failure_runs": f"""WITH {events_cte()}, numbered AS (SELECT *, sum(CASE WHEN status = 200 THEN 1 ELSE 0 END)
  OVER (PARTITION BY endpoint ORDER BY ts, request_id) AS run FROM ev)
SELECT endpoint, count(*) AS failures, arg_min(request_id, (ts, request_id)) AS first_id, arg_max(request_id, (ts, request_id)) AS last_id,
  count(*) >= 3 AS tripped FROM numbered WHERE status <> 200 GROUP BY endpoint, run""",
    "degraded_rate": f"""WITH {events_cte()} SELECT {_STAMP.format("date_trunc('hour', ts)")} AS window_start, count(*) AS n,
  count(*) FILTER (WHERE status <> 200) AS n_degraded, round(count(*) FILTER (WHERE status <> 200) / count(*), 6) AS rate FROM ev GROUP BY 1""",
    "degraded_rate_sliding": f"""WITH {events_cte()}, placed AS (SELECT status, time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(15 * unnest(range(4))) AS w FROM ev)
SELECT {_STAMP.format('w')} AS window_start, count(*) AS n, count(*) FILTER (WHERE status <> 200) AS n_degraded,
  round(count(*) FILTER (WHERE status <> 200) / count(*), 6) AS rate FROM placed GROUP BY w""",
    "rate_limit_audit": _rates(_TIERS),
    "rate_limit_audit_tight": _rates(_TIGHT),
    "session_triggers": _TRIGGERS,
    "stream_session_state": _TRIGGERS,
    "stream_degraded_rate": f"""WITH {events_cte()}
SELECT {_STAMP.format("date_trunc('hour', ts)")} AS window_start, count(*) AS n, count(*) FILTER (WHERE status <> 200) AS n_degraded,
  round(count(*) FILTER (WHERE status <> 200) / count(*), 6) AS rate FROM ev GROUP BY 1""",
    "stream_calls_per_minute": f"""SELECT user_id, {_STAMP.format("date_trunc('minute', ts)")} AS slot, count(*) AS calls
FROM events GROUP BY 1, 2""",
    "stream_session_counts": f"""WITH {events_cte()},
gaps AS (SELECT session_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 4 HOUR THEN 0 ELSE 1 END AS begins FROM ev
  WINDOW w AS (PARTITION BY session_id ORDER BY ts)),
numbered AS (SELECT session_id, ts, sum(begins) OVER (PARTITION BY session_id ORDER BY ts) AS stretch FROM gaps)
SELECT session_id, {_STAMP.format('min(ts)')} AS stretch_start, count(*) AS actions FROM numbered GROUP BY session_id, stretch""",
    "stream_dedup": f"WITH {events_cte()} SELECT DISTINCT sha256(content) AS content_hash FROM ev",
    "stream_dedup_within": f"""{EXPIRING} SELECT request_id, content_hash, scan_id, scan_id = request_id AS scanned
FROM shared WHERE content_hash IS NOT NULL""",
}
