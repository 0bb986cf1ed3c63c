"""Scan requests: gates, assembly, deduplication, screening, decisions and audits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.functions import dims
from veilstone.functions import requests as R
from veilstone.functions import verdicts as V
from veilstone.functions.frames import computed_once, exploded, skew_safe_lookup
from veilstone.functions.regex import java_regex
from veilstone.functions.rules import RuleSet

ACTION_RANK = {"allow": 1, "warn": 2, "require_approval": 3, "block": 4}


def action_rank(action: Column) -> Column:
    """How strict an action is; an action that is none of the four ranks below all of them."""
    ranks = F.create_map(*[F.lit(x) for pair in ACTION_RANK.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, action), F.lit(0))


def size_gate(df: DataFrame, size: Column, channel: Column) -> DataFrame:
    """Adds `bytes`, `oversize` and the fixed local verdict of oversize content."""
    return df.withColumns(
        {
            "bytes": size,
            "oversize": R.oversize(size, channel),
            "local_verdict": R.oversize_verdict(size, channel),
        }
    )


def assembled(parts: DataFrame, key: str, order: Sequence[str], text: Column, size: Column) -> DataFrame:
    """Ordered texts per key: `items`, their number `n` and summed `bytes`. NULL texts are left out.

    One aggregation, and the same for a group of any size; one that a row cannot hold fails the job instead of losing
    its text. Gate by size before, as `prompt_guard` does, where such groups may come.
    """
    sized = size.cast("bigint")
    item = F.when(text.isNotNull(), F.struct(*order, text.alias("text")))
    groups = parts.groupBy(key).agg(
        F.count(text).alias("n"),
        F.coalesce(F.sum(sized), F.lit(0).cast("bigint")).alias("bytes"),
        F.sort_array(F.collect_list(item)).alias("_items"),
    )
    return groups.select(key, "n", "bytes", F.transform("_items", lambda i: i["text"]).alias("items"))


def _user_text(style: str, role: Column, kind: Column, text: Column) -> Column:
    plain = kind.isNull()
    if style == "chat":  # empty messages are skipped, text parts are not
        wanted = (role == "user") & ((plain & (text != "")) | (kind == "text"))
    elif style == "blocks":  # every text block of the user
        wanted = (role == "user") & (plain | (kind == "text"))
    elif style == "contents":  # a missing role counts as the user
        wanted = (F.coalesce(role, F.lit("")).isin("", "user")) & (text != "")
    else:
        raise ValueError(f"unknown style {style}")
    return F.when(wanted, text)


def _said(style: str, role: str, kind: str | None, text: str) -> Column:
    return _user_text(style, F.col(role), F.col(kind) if kind else F.lit(None).cast("string"), F.col(text))


def user_content_sizes(
    parts: DataFrame, key: str = "conv_id", style: str = "chat", role: str = "role", kind: str | None = None, text: str = "text"
) -> DataFrame:
    """`content_bytes` and `blank` of what `extract_user_content` gives, without putting any text together."""
    said = _said(style, role, kind, text)
    n = F.count(said)
    return parts.groupBy(key).agg(
        (F.coalesce(F.sum(F.octet_length(said).cast("bigint")), F.lit(0)) + F.greatest(n - 1, F.lit(0))).alias("content_bytes"),
        F.coalesce(F.bool_and(R.is_blank(said)), F.lit(True)).alias("blank"),
    )


def extract_user_content(
    parts: DataFrame,
    key: str = "conv_id",
    order: Sequence[str] = ("turn",),
    style: str = "chat",
    role: str = "role",
    kind: str | None = None,
    text: str = "text",
) -> DataFrame:
    """What the user said in each conversation, joined by line feeds; '' where there is nothing.

    `content_bytes` counts the joined text.
    """
    said = _said(style, role, kind, text)
    groups = assembled(parts, key, order, said, F.octet_length(said))
    separators = F.greatest(F.col("n") - 1, F.lit(0))
    return groups.select(
        key, F.array_join("items", "\n").alias("content"), (F.col("bytes") + separators).alias("content_bytes")
    )


def encode_rag_chunks(chunks: DataFrame, key: str, position: str, chunk: str) -> DataFrame:
    """Retrieved chunks of one request as one content, boundaries kept, with the size of the encoded form."""
    quoted = R.wire_json(F.array(chunk))
    # One chunk goes bare; several cost their quoted forms, the commas and two brackets.
    sized = chunks.withColumn("_quoted", F.octet_length(quoted) - 2)
    groups = assembled(sized, key, [position], F.col(chunk), F.col("_quoted"))
    content = R.encoded_chunks(F.col("items"))
    size = F.when(F.col("n") == 1, F.octet_length(content)).otherwise(
        F.col("bytes") + F.greatest(F.col("n") - 1, F.lit(0)) + 2
    )
    return groups.select(
        key,
        F.when(F.col("items").isNotNull(), content).alias("content"),
        F.col("n").alias("n_chunks"),
        size.cast("bigint").alias("content_bytes"),
    )


def dedup_scans(
    requests: DataFrame,
    row_id: str,
    content: Sequence[str],
    key: Column,
    scan: Callable[[DataFrame], DataFrame],
    outputs: Sequence[str],
) -> DataFrame:
    """Scan each distinct content once and give every copy the same verdict.

    `scan` adds the `outputs` columns to a table of distinct contents. Copies are folded before the shuffle, and
    the way back spreads contents with very many copies.
    """
    keyed = computed_once(requests.select(row_id, *content), "_hash", key)
    distinct = keyed.groupBy("_hash").agg(*[F.any_value(c).alias(c) for c in content])
    verdicts = scan(distinct).select("_hash", *outputs)
    narrow = keyed.select(row_id, "_hash")
    counts = narrow.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    found = skew_safe_lookup(narrow, verdicts, counts, "_hash", row_id)
    return found.select(row_id, F.col("_hash").alias("content_hash"), *outputs)


def dedup_stats(requests: DataFrame, key: Column) -> DataFrame:
    """What a cache of unlimited size would have seen: hits, misses, size, hit rate."""
    counts = requests.select(key.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("misses"))
    hits = F.col("total") - F.col("misses")
    return total.select(
        hits.alias("hits"),
        "misses",
        F.col("misses").alias("size"),
        F.when(F.col("total") > 0, hits / F.col("total")).otherwise(F.lit(0.0)).alias("hit_rate"),
    )


@dataclass(frozen=True)
class Rule:
    """One screening rule: content of `channel` that matches `regex` gets the given raw verdict."""

    channel: str
    regex: str
    threat_type: str
    action: str
    confidence: float | None = None
    reason: str | None = None


# The reference's own rules, in order.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("prompt", r"(?i)ignore previous", "instruction_override", "block", 0.95, "Prompt injection detected"),
    Rule("prompt", r"SSN|-", "pii", "block", 0.99, "PII detected"),
    Rule("sql", r"'1'='1'|DROP TABLE", "sql_injection", "block", None, "SQL injection detected"),
    Rule("file_path", r"\.\.|/etc/passwd", "path_traversal", "block", None, "Path traversal detected"),
    Rule("file_content", r"\.\.|/etc/passwd", "path_traversal", "block", None, "Path traversal detected"),
)

_RULES_PER_STEP = 100


def rule_screen(
    df: DataFrame,
    channel: str = "channel",
    content: str = "content",
    rules: Sequence[Rule] = DEFAULT_RULES,
    strictest: bool = False,
    out: str = "raw",
) -> DataFrame:
    """Adds the raw verdict of the first rule that matches, or with `strictest` of the one with the hardest action.

    Rules are literal expressions: each is compiled once, and a row meets only the rules of its channel. There is
    no join, so nothing is shuffled or paired. Many rules are applied in several steps.
    """
    work = df.withColumn("_hit", F.lit(None).cast("struct<rank: int, pos: int>"))
    ordered = list(enumerate(rules))
    for begin in range(0, len(ordered), _RULES_PER_STEP):
        hits = []
        for pos, rule in ordered[begin : begin + _RULES_PER_STEP]:
            met = (F.col(channel) == rule.channel) & F.col(content).rlike(java_regex(rule.regex))
            rank = -ACTION_RANK.get(rule.action, 0) if strictest else 0
            hits.append(F.when(met, F.struct(F.lit(rank).alias("rank"), F.lit(pos).alias("pos"))))
        best = F.least(F.col("_hit"), *hits) if len(hits) > 0 else F.col("_hit")
        work = computed_once(work, "_next", best).drop("_hit").withColumnRenamed("_next", "_hit")
    answers = F.array(
        *[
            F.to_json(
                F.struct(
                    F.lit(False).alias("safe"),
                    F.lit(r.action).alias("action"),
                    F.lit(r.confidence).cast("double").alias("confidence"),
                    F.lit(r.reason).alias("reason"),
                    F.array(F.struct(F.lit(r.threat_type).alias("threat_type"))).alias("violations"),
                )
            )
            for r in rules
        ]
    ) if rules else F.array().cast("array<string>")
    clear = F.lit('{"safe":true,"action":"allow"}')
    return work.withColumn(out, F.coalesce(F.get(answers, F.col("_hit.pos")), clear)).drop("_hit")


RULE_COLUMNS = "pos BIGINT, channel STRING, regex STRING, threat_type STRING, action STRING, confidence DOUBLE, reason STRING"


def rule_screen_table(
    df: DataFrame, rules: DataFrame, channel: str = "channel", content: str = "content", strictest: bool = False, out: str = "raw"
) -> DataFrame:
    """As `rule_screen`, with rules from a table (`RULE_COLUMNS`; `pos` gives their order) of any length.

    Rules are configuration: they are read on the driver and go with the function to the tasks. A text meets only the
    rules whose required literals it holds, found by one automaton for all of them, so neither a join nor a pass per rule
    is needed. Rules without an expression or channel match nothing.
    """
    verdict = F.to_json(
        F.struct(
            F.lit(False).alias("safe"), "action", F.col("confidence").cast("double").alias("confidence"), "reason",
            F.array(F.struct("threat_type")).alias("violations"),
        )
    )
    listed = rules.where("regex IS NOT NULL AND channel IS NOT NULL").orderBy("pos").select("channel", "regex", "action", verdict.alias("raw")).collect()
    for rule in listed:
        pc.match_substring_regex(pa.array([""]), pattern=rule["regex"])  # refuses what the engine cannot run, before any task
    known = [(r["channel"], r["regex"]) for r in listed]
    ranks = [-ACTION_RANK.get(r["action"], 0) if strictest else 0 for r in listed]
    answers = [r["raw"] for r in listed]

    @F.pandas_udf("string")
    def screen(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        found = RuleSet(known)
        for channels, texts in batches:
            hits = found.matches(channels.tolist(), texts.tolist())
            yield pd.Series([answers[min(h, key=lambda p: (ranks[p], p))] if h else None for h in hits], dtype="object")

    clear = F.lit('{"safe":true,"action":"allow"}')
    return computed_once(df, "_found", screen(F.col(channel), F.col(content))).withColumn(out, F.coalesce("_found", clear)).drop("_found")


def policy_match(verdicts: DataFrame, policies: DataFrame, threat: str = "threat_type", score: str = "score") -> DataFrame:
    """Adds `policy_action`: the strictest action of the rules whose type equals and whose threshold is reached.

    The reference has only the record (type, action, threshold); the meaning is ours. Types and actions are free text: an
    unknown action counts where no known one applies, the last by name of several. Rules shrink to the lowest
    threshold per type and action.
    """
    ranked = policies.where("type IS NOT NULL AND action IS NOT NULL").groupBy("type", "action").agg(
        F.min("threshold").alias("threshold")
    )
    step = F.struct(action_rank(F.col("action")).alias("rank"), "action", "threshold")
    ladder = ranked.groupBy("type").agg(F.collect_list(step).alias("_ladder"))
    joined = verdicts.join(ladder.withColumnRenamed("type", "_type"), F.col(threat) == F.col("_type"), "left")
    met = F.filter("_ladder", lambda s: s["threshold"] <= F.col(score))
    return joined.withColumn("policy_action", F.array_max(met)["action"]).drop("_type", "_ladder")


def decision(
    blank: Column, scanned: Column, blocked: Column, reason: Column, threat_type: Column, confidence: Column, fail_open: Column
) -> dict[str, Column]:
    """Columns that tell what happens to a request. Blank content needs no scan. Without a verdict, closed mode is an
    error and open mode lets the request through, marked degraded."""
    refused = ~blank & scanned & blocked
    degraded = ~blank & ~scanned & fail_open
    return {
        "outcome": F.when(blank, "proceed")
        .when(scanned, F.when(blocked, "blocked").otherwise("proceed"))
        .otherwise(F.when(fail_open, "proceed").otherwise("scan_error")),
        "decision_reason": F.when(refused, F.concat(F.lit("Request blocked: "), F.coalesce(reason, F.lit(""))))
        .when(blank, "No content to scan")
        .when(degraded, "scan_unavailable_fail_open"),
        "threat_type": F.when(refused, threat_type),
        "confidence": F.when(refused, confidence),
        "degraded": degraded,
    }


def guard_decision(requests: DataFrame, verdicts: DataFrame, key: str, fail_mode: str | Sequence[str] = "closed") -> DataFrame:
    """Proceed, refuse or report an error for every request, from its verdict if there is one. Several fail modes give a
    row each, told apart by `fail_mode`, from one join.

    `verdicts` are clean records without the ones that did not parse. Of several for one request the strictest counts:
    one that blocks before one that does not, then the greatest by reason, threat type and confidence. A request
    whose `blank` column is true needs no scan. A refused request carries the `violations` of its verdict, if it lists any.
    """
    modes = [fail_mode] if isinstance(fail_mode, str) else list(fail_mode)
    if not set(modes) <= {"closed", "open"}:
        raise ValueError(f"unknown fail mode in {modes}")
    record = ["blocked", "reason", "threat_type", "confidence"]
    more = [c for c in ("violations",) if c in verdicts.columns]
    strictest = F.max_by(F.struct(*record, *more), F.struct(*record))
    folded = verdicts.groupBy(key).agg(strictest.alias("_v"))
    known = folded.select(key, F.lit(True).alias("_scanned"), *[F.col(f"_v.{c}").alias(f"_{c}") for c in [*record, *more]])
    joined = requests.join(known, key, "left").withColumn("_mode", F.explode(F.array(*[F.lit(m) for m in modes])))
    blank = F.col("blank") if "blank" in requests.columns else F.lit(False)
    decided = decision(blank, F.coalesce("_scanned", F.lit(False)), *[F.col(f"_{c}") for c in record], F.col("_mode") == "open")
    told = [F.when(decided["outcome"] == "blocked", F.col(f"_{c}")).alias(c) for c in more]
    told += [] if isinstance(fail_mode, str) else [F.col("_mode").alias("fail_mode")]
    return joined.select(*requests.columns, *[c.alias(name) for name, c in decided.items()], *told)


def request_contract_audit(
    envelopes: DataFrame, key: str, endpoint: str = "endpoint", body: str = "body"
) -> DataFrame:
    """One row per request and broken rule of the request contract."""
    names = ("context", "prompt", "scan_type", "content", "content_type", "name", "description")
    read = computed_once(envelopes.select(key, endpoint, body), "_v", V.read_json(F.col(body), names))
    v, general, tool = F.col("_v"), F.col(endpoint) == "general", F.col(endpoint) == "tool_schema"
    special = F.col(endpoint) == "specialized"
    context = V.object_of(v["context"])
    channels = [c for c in dims.CHANNELS if c not in ("prompt", "mcp_schema")]

    def lacks(name: str) -> Column:
        return ~tool & V.text_of(V.field(context, name)).isNull()

    required = {"prompt": general, "scan_type": general, "content": special, "content_type": special,
                "name": tool, "description": tool}
    rules = {
        "not_json": v.isNull() | v["_corrupt_record"].isNotNull(),
        "missing_session_id": lacks("session_id"),
        "missing_agent_id": lacks("agent_id"),
        "missing_source_application": lacks("source_application"),
        "context_not_object": ~tool & context.isNull(),
        "wrong_scan_type": general & F.coalesce(V.text_of(v["scan_type"]) != "full", F.lit(True)),
        "unknown_channel": special & ~F.coalesce(V.text_of(v["content_type"]).isin(*channels), F.lit(False)),
        "forbidden_content_type": tool & v["content_type"].isNotNull(),
        **{f"missing_{k}": where & v[k].isNull() for k, where in required.items()},
    }
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return exploded(read.select(key, broken.alias("_broken")), "_broken", "rule", key)


def missing_scans(requests: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Requests that never got a verdict."""
    return requests.join(verdicts.select(key), key, "left_anti")


def unused_channels(requests: DataFrame, channel: str = "channel") -> DataFrame:
    """Declared channels that no request went through."""
    declared = dims.channel_origins(requests.sparkSession).select("channel")
    return declared.exceptAll(requests.select(F.col(channel).alias("channel")).distinct())
