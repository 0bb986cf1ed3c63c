"""Small fixed tables: threat codes, severities, channels, tiers.

Each is built from a literal VALUES list, so Catalyst knows its exact size and picks the broadcast by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

# Raw threat codes by the name they normalise to.
THREAT_CODES: dict[str, tuple[str, ...]] = {
    "prompt_injection": (
        "prompt_injection", "injection", "inject", "instruction_override", "role_hijacking",
        "context_manipulation", "token_manipulation", "indirect_injection", "context_poisoning",
        "function_injection", "memory_injection", "topic_mismatch",
    ),
    "jailbreak": (
        "jailbreak", "jailbreak_attempt", "safety_bypass", "roleplay", "hypothetical", "completion_baiting",
        "override", "manipulate", "tonality_drift_casual",
    ),
    "system_prompt_leak": ("system_prompt_leak", "system_prompt_extraction"),
    "data_exfiltration": (
        "data_exfiltration", "exfiltration", "exfiltrate", "extract", "data_leak", "information_disclosure",
        "credential_extraction",
    ),
    "sql_injection": (
        "sql_injection", "sqli", "tautology", "tautology_or", "tautology_and", "union_injection", "stacked_query",
    ),
    "path_traversal": (
        "path_traversal", "directory_traversal", "path_violation", "file_access", "sensitive_path",
        "sensitive_extension", "blocked_extension",
    ),
    "secrets_exposure": (
        "secrets_exposure", "secrets", "api_key", "credential", "sensitive_file", "content_violation",
        "sensitive_content", "secret_key", "aws_key", "private_key",
    ),
    "pii_exposure": (
        "pii_exposure", "pii", "pii_leak", "personal_data", "pii_in_search", "pii_extraction", "ssn", "credit_card",
        "email_exposure", "phone_number", "unexpected_pii_leakage",
    ),
    "blocked_domain": ("blocked_domain", "suspicious_tld", "suspicious_domain", "malicious_url"),
    "toxic_content": (
        "toxic_content", "toxicity", "harmful_content", "tonality_drift_profanity", "tonality_drift_hostile",
    ),
    "malicious_code": (
        "malicious_content", "malicious_code", "reverse_shell", "web_shell", "fork_bomb", "crypto_miner",
        "persistence", "shell_injection",
    ),
    "harmful_intent": ("harmful_intent", "dangerous_request"),
    "social_engineering": ("social_engineering", "emotional", "authority_claim"),
    "privilege_escalation": ("privilege_escalation",),
    "destructive_operation": ("destructive_operation",),
    "multi_turn_attack": ("multi_turn_attack",),
    "scan_error": ("scan_error", "timeout"),
    "size_limit_exceeded": ("size_limit_exceeded", "size_limit"),
}

# Default severity of each normalised name.
SEVERITY: dict[str, str] = {
    "prompt_injection": "high",
    "jailbreak": "high",
    "system_prompt_leak": "high",
    "data_exfiltration": "high",
    "sql_injection": "critical",
    "path_traversal": "high",
    "secrets_exposure": "critical",
    "pii_exposure": "high",
    "blocked_domain": "medium",
    "toxic_content": "medium",
    "multi_turn_attack": "high",
    "malicious_code": "critical",
    "harmful_intent": "high",
    "social_engineering": "medium",
    "privilege_escalation": "critical",
    "destructive_operation": "critical",
    "scan_error": "medium",
    "size_limit_exceeded": "low",
    "unknown": "medium",
}

# Our own wording; pass another table to `sanitize_verdict` to change it.
GUIDANCE: dict[str, str] = {
    "prompt_injection": "The text tries to replace the instructions in force.",
    "jailbreak": "The text tries to switch off safety rules.",
    "system_prompt_leak": "The answer gives away hidden instructions.",
    "data_exfiltration": "The text may move private data out.",
    "sql_injection": "The query holds unsafe SQL.",
    "path_traversal": "The path leaves the folders it may use.",
    "secrets_exposure": "The content looks like a key, token or password.",
    "pii_exposure": "The content holds personal data.",
    "blocked_domain": "The search points at a closed domain.",
    "toxic_content": "The content is abusive or unsuitable.",
    "multi_turn_attack": "Several turns of this session together look like an attack.",
    "malicious_code": "The content looks like harmful code.",
    "harmful_intent": "The request seems to aim at harm.",
    "social_engineering": "The text puts pressure on the reader.",
    "privilege_escalation": "The query asks for rights it should not have.",
    "destructive_operation": "The query destroys data; check it first.",
    "scan_error": "The scan did not finish, so the content is held back.",
    "size_limit_exceeded": "The content is larger than allowed.",
    "unknown": "A concern was found; please review the content.",
}

# Keys of a violation that describe how it was found.
INTERNAL_KEYS: tuple[str, ...] = (
    "detected_by", "policy_id", "policy_name", "matched_pattern", "matched_text", "pattern", "scan_stage",
    "ai_reasoning", "llm_analysis", "performance_metrics", "performance",
)

# Governance outcomes and content origins.
TIERS: tuple[str, ...] = ("allow", "warn", "require_approval", "block")
ORIGINS: tuple[str, ...] = ("human_prompt", "agent_output", "agent_action", "third_party")

# Channels, their optional context keys, and who is behind the content.
CHANNELS: dict[str, tuple[tuple[str, ...], str]] = {
    "command": (("cwd",), "agent_action"),
    "sql": (("database", "allow_destructive"), "agent_action"),
    "file_path": ((), "agent_action"),
    "file_content": (("file_content",), "agent_action"),
    "web_search": ((), "agent_action"),
    "rag_context": (("query",), "third_party"),
    "a2a_message": (("sender_agent_id", "receiver_agent_id", "task_id", "role"), "third_party"),
    "agent_card": (("verify_signature",), "third_party"),
    "prompt": ((), "human_prompt"),
    "mcp_schema": ((), "third_party"),
}

# Calls allowed per minute and per month.
RATE_TIERS: dict[str, tuple[int, int]] = {
    "community": (10, 1_000),
    "pro": (100, 25_000),
    "enterprise": (1_000, 1_000_000),
}


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[object]]) -> DataFrame:
    """A literal table from Python values: text, numbers, booleans and None."""

    def cell(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        return sql_text(v) if isinstance(v, str) else f"{v}D" if isinstance(v, float) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def threat_codes(spark: SparkSession) -> DataFrame:
    rows = [(code, name) for name, codes in THREAT_CODES.items() for code in codes]
    return values_table(spark, ("_code", "_mapped"), rows)


def threat_names(spark: SparkSession, guidance: dict[str, str] | None = None) -> DataFrame:
    texts = {**GUIDANCE, **(guidance or {})}
    return values_table(
        spark, ("threat_type", "default_severity", "guidance"), [(n, s, texts[n]) for n, s in SEVERITY.items()]
    )


def channel_origins(spark: SparkSession) -> DataFrame:
    return values_table(spark, ("channel", "origin"), [(c, o) for c, (_, o) in CHANNELS.items()])


def rate_tiers(spark: SparkSession) -> DataFrame:
    return values_table(
        spark, ("tier", "per_minute", "per_month"), [(t, m, mo) for t, (m, mo) in RATE_TIERS.items()]
    )
