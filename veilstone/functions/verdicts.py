"""Column expressions on raw and clean verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilstone.functions.dims import INTERNAL_KEYS


# The fields of a verdict that anything here reads. All others are skipped while parsing.
FIELDS = (
    "safe", "action", "refuse_tier", "reason", "threat_type", "severity", "confidence", "violations", "recovery",
    "session_state", "content_type", "content_origin", "approval_info", "held_by_scope", "content_verdict",
    "client_session_rotation",
)


def read_json(raw: Column, names: Sequence[str] = FIELDS) -> Column:
    """One pass over JSON text to a struct of variants; `_corrupt_record` is set where it is no JSON object.

    Strict: single quotes and numbers that JSON lacks make it no JSON.
    """
    schema = ", ".join([*(f"{name} VARIANT" for name in names), "_corrupt_record STRING"])
    return F.from_json(raw, schema, {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})


def is_verdict(raw: Column, read: Column) -> Column:
    """Only an object, or a bare null, decodes to a verdict."""
    whole = read.isNotNull() & read["_corrupt_record"].isNull()
    return F.coalesce(whole | raw.rlike(r"^[ \t\n\r]*null[ \t\n\r]*\z"), F.lit(False))


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def field(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "variant")


def text_of(value: Column) -> Column:
    """The string in a variant; NULL when absent, empty or of another type. No cast from other types."""
    return F.when(kind(value) == "STRING", F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")))


def flag_of(value: Column) -> Column:
    return F.when(kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def number_of(value: Column) -> Column:
    numeric = kind(value).rlike("^(?:BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(numeric, F.try_variant_get(value, "$", "double"))


def object_of(value: Column) -> Column:
    """The variant itself when it is an object, else NULL."""
    return F.when(kind(value).startswith("OBJECT"), value)


def items_of(value: Column) -> Column:
    """The items of a list; NULL when it is anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def texts_of(value: Column) -> Column:
    """The text items of a list field; other items are skipped, and anything but a list reads as NULL."""
    return F.transform(
        F.filter(items_of(value), lambda v: kind(v) == "STRING"), lambda v: F.try_variant_get(v, "$", "string")
    )


def clean_violations(violations: Column) -> Column:
    """Violations as maps without internal keys; items that are no objects go."""
    objects = F.transform(items_of(violations), lambda v: F.try_variant_get(v, "$", "map<string,variant>"))
    return F.transform(
        F.filter(objects, lambda m: m.isNotNull()),
        lambda m: F.map_filter(m, lambda k, _: ~k.isin(*INTERNAL_KEYS)),
    )


def effective_threat_code(threat_type: Column, violations: Column) -> Column:
    """The top-level type, else the type of the first violation as received."""
    first = F.get(items_of(violations), F.lit(0))
    return F.coalesce(text_of(threat_type), text_of(field(first, "threat_type")))


def threat_code(raw_type: Column) -> Column:
    """The form in which raw types are looked up."""
    return F.replace(F.lower(raw_type), F.lit("-"), F.lit("_"))


def mapped_threat(raw_type: Column, mapped: Column) -> Column:
    """Normalised name, given the looked-up one."""
    fallback = F.when(threat_code(raw_type).startswith("multi_turn_"), F.lit("multi_turn_attack"))
    return F.coalesce(F.when(raw_type != "", mapped), fallback, F.lit("unknown"))


def derive_severity(raw_severity: Column, default: Column) -> Column:
    given = F.lower(raw_severity)
    return F.when(given.isin("critical", "high", "medium", "low"), given).otherwise(
        F.coalesce(default, F.lit("medium"))
    )


def bucket_confidence(score: Column) -> Column:
    return (
        F.when(score.isNull(), "medium")
        .when(F.isnan(score), "low")
        .when(score >= 0.9, "high")
        .when(score >= 0.7, "medium")
        .otherwise("low")
    )


def is_blocked(action: Column, safe: Column) -> Column:
    """The one proceed-or-refuse rule. An unknown tier falls back to `safe`, so a new blocking tier holds."""
    return (
        F.when(action.isin("allow", "warn"), False)
        .when(action.isin("block", "require_approval"), True)
        .otherwise(~safe)
    )


def attributable_to_operator(origin: Column) -> Column:
    return F.coalesce(origin == "human_prompt", F.lit(False))


# Our own wording of the first line, by action.
FEEDBACK_LEAD = {
    "block": "Your last tool call was refused.",
    "warn": "Your last tool call was let through with a warning.",
    "require_approval": "Your last tool call waits for approval.",
}


def short_number(value: Column) -> Column:
    """Shortest decimal form: no trailing zeros, no exponent for scores between 0 and 1."""
    plain = F.rtrim(F.format_string("%.17f", value), F.lit("0"))
    text = value.cast("string")
    trimmed = F.regexp_replace(text, r"\.0$", "")
    return F.when(text.contains("E") & (F.abs(value) < 1), F.rtrim(plain, F.lit("."))).otherwise(trimmed)


def block_feedback(
    action: Column,
    reason: Column,
    guidance: Column,
    threat_type: Column,
    recovery: Column,
    session_state: Column,
    lead: dict[str, str] | None = None,
) -> Column:
    """Several lines that tell a model why its call was refused and what it may do instead.

    `recovery` and `session_state` are variants. Lines whose value is missing are left out.
    """
    words = {**FEEDBACK_LEAD, **(lead or {})}
    tier = F.lower(action)
    first = (
        F.when(tier == "warn", words["warn"])
        .when(tier == "require_approval", words["require_approval"])
        .otherwise(words["block"])
    )
    risk = number_of(field(session_state, "session_risk_score"))
    turn = number_of(field(session_state, "session_turn_number"))
    risk_line = F.concat(F.lit("Session risk: "), short_number(risk))
    turn_part = F.concat(F.lit(" (turn "), turn.cast("bigint").cast("string"), F.lit(")"))
    triggered = texts_of(field(recovery, "patterns_triggered"))
    patterns = F.when(F.size(triggered) > 0, triggered).otherwise(texts_of(field(session_state, "session_patterns")))
    tools = texts_of(field(recovery, "available_tools"))

    def labelled(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(f"{label}: "), value))

    def listed(label: str, values: Column) -> Column:
        return F.when(F.size(values) > 0, F.concat(F.lit(f"{label}: "), F.array_join(values, ", ")))

    return F.concat_ws(
        "\n",
        first,
        labelled("Reason", F.coalesce(F.nullif(reason, F.lit("")), guidance)),
        labelled("Threat type", threat_type),
        F.when(turn.isNotNull(), F.concat(risk_line, turn_part)).otherwise(risk_line),
        listed("Patterns triggered", patterns),
        labelled("Recovery", text_of(field(recovery, "instruction"))),
        listed("Available tools", tools),
    )
