"""Operators put together: a conversation through the prompt guard, an agent action through its scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilstone.functions import requests as R
from veilstone.functions import verdicts as V
from veilstone.functions.frames import null_safe_join
from veilstone.operators import requests as ops
from veilstone.operators import scopes, verdicts


def prompt_guard(
    parts: DataFrame,
    key: str = "conv_id",
    order: Sequence[str] = ("turn",),
    style: str = "chat",
    kind: str | None = None,
    rules: Sequence[ops.Rule] = ops.DEFAULT_RULES,
) -> DataFrame:
    """What the user said, gated, hashed, screened and decided: one row per conversation.

    Sizes and blankness are summed from the parts, and only conversations that pass both gates are put together: none
    of those is above the size limit, however long conversations get. Equal contents are screened once and share the verdict.
    """
    sizes = ops.user_content_sizes(parts, key, style, kind=kind).withColumn("oversize", R.oversize(F.col("content_bytes")))
    passing = sizes.where("NOT blank AND NOT oversize").select(F.col(key).alias("_key"))
    open_parts = parts.join(passing, parts[key].eqNullSafe(passing["_key"]), "left_semi")
    said = ops.extract_user_content(open_parts, key, order, style, kind=kind)
    said = said.select(key, F.lit("prompt").alias("_channel"), F.col("content").alias("_text"))
    record = ["parsed", "blocked", "reason", "threat_type", "confidence"]

    def scan(distinct: DataFrame) -> DataFrame:
        return verdicts.sanitize_verdict(ops.rule_screen(distinct, "_channel", "_text", rules), ["_hash"]).select("_hash", *record)

    hashed = R.content_hash(channel=F.col("_channel"), text=F.col("_text"))
    judged = ops.dedup_scans(said, key, ["_channel", "_text"], hashed, scan, record).drop("content_hash")
    clean = null_safe_join(sizes.select(key, "content_bytes", "blank", "oversize"), judged, [key])
    over = F.col("oversize")
    local = R.oversize_verdict(F.col("content_bytes"), F.lit("prompt"))
    parsed = F.coalesce("parsed", F.lit(True))  # what did not pass a gate has its verdict from there
    record = {
        "blocked": over | F.coalesce("blocked", F.lit(False)),
        "reason": F.coalesce(F.when(over, local["reason"]), "reason"),
        "threat_type": F.coalesce(F.when(over, local["threat_type"]), "threat_type"),
        "confidence": F.coalesce(F.when(over, local["confidence"]), "confidence"),
    }
    decided = ops.decision(F.col("blank"), parsed, *record.values(), F.lit(False))
    names = ("outcome", "decision_reason", "threat_type", "confidence")
    return clean.select(key, "content_bytes", *[decided[n].alias(n) for n in names])


def action_scan(actions: DataFrame, history: DataFrame, raw: str = "raw") -> DataFrame:
    """Agent actions with their raw verdict: cleaned, held against the agent's scope, and explained where refused.

    `actions` has agent_id, ts, request_id and tool; `history` comes from `scope_history`. Rows whose verdict did not
    parse are left to the fail mode of `guard_decision`.
    """
    keep = ["agent_id", "ts", "request_id", "tool"]
    record = ["reason", "guidance", "threat_type", "recovery", "session_state"]
    clean = verdicts.sanitize_verdict(actions, keep, raw).select(*keep, "action", "safe", "blocked", "parsed", *record)
    held = scopes.scope_enforce(clean, history).where("parsed")
    refused = F.col("held_by_scope") | F.col("blocked")
    text = V.block_feedback(*[F.col(c) for c in ("action", *record)])
    return held.select(
        *keep, "action", "hold_reason", "held_by_scope", "content_action", refused.alias("refused"),
        F.when(refused, text).alias("feedback"),
    )
