"""Column expressions on scan requests: gates, identity, envelopes, hashes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilstone.functions.dims import CHANNELS

MAX_CONTENT_BYTES = 102_400

# White space as Unicode defines it.
_BLANK = r"^[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*\z"

# How an oversize message names the content, by channel.
SIZE_LABEL: dict[str, str] = {
    "prompt": "Content",
    "sql": "SQL query",
    "file_path": "File content",
    "file_content": "File content",
    "a2a_message": "Message",
    "agent_card": "Agent card",
    "command": "Command",
    "web_search": "Query",
    "rag_context": "RAG context",
}


def is_blank(text: Column) -> Column:
    """Nothing but white space. The expression stops at the first other character."""
    return text.rlike(_BLANK)


def byte_size(*parts: Column) -> Column:
    total = F.lit(0).cast("bigint")
    for part in parts:
        total = total + F.coalesce(F.octet_length(part), F.lit(0))
    return total


def oversize(size: Column, channel: Column | None = None) -> Column:
    """Over the byte limit. Tool schemas have no limit."""
    over = size > MAX_CONTENT_BYTES
    return over if channel is None else over & (channel != "mcp_schema")


def oversize_reason(size: Column, channel: Column) -> Column:
    label = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for pair in SIZE_LABEL.items() for x in pair]), channel),
        F.lit("Content"),
    )
    kb = F.floor(size / 1024).cast("string")
    return F.concat(label, F.lit(" too large ("), kb, F.lit(f"KB > {MAX_CONTENT_BYTES // 1024}KB limit)"))


def oversize_verdict(size: Column, channel: Column) -> Column:
    """The local block verdict for oversize content, else NULL."""
    unit = F.when(channel == "sql", "Query").otherwise("Content")
    limit = F.lit(f" exceeds maximum size of {MAX_CONTENT_BYTES // 1024}KB")
    verdict = F.struct(
        F.lit(False).alias("safe"),
        oversize_reason(size, channel).alias("reason"),
        F.lit("size_limit_exceeded").alias("threat_type"),
        F.lit("low").alias("severity"),
        F.lit("high").alias("confidence"),
        F.lit("block").alias("action"),
        F.lit("block").alias("refuse_tier"),
        F.array(
            F.struct(F.lit("size_limit").alias("type"), F.concat(unit, limit).alias("description"))
        ).alias("violations"),
    )
    return F.when(oversize(size, channel), verdict)


def either(*choices: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def identity_context(
    session: Column,
    agent: Column,
    default_session: Column,
    default_agent: Column,
    agent_override: Column | None = None,
    application: str = "veilstone",
    extras: Column | None = None,
) -> Column:
    """Who sends the request, as a map with sorted keys.

    Set values win over defaults; for the agent an override comes in between. Extras with a value are merged in and
    may replace identity keys.
    """
    override = [] if agent_override is None else [agent_override]
    base = F.create_map(
        F.lit("session_id"), either(session, default_session),
        F.lit("agent_id"), either(agent, *override, default_agent),
        F.lit("source_application"), F.lit(application),
    )
    if extras is not None:
        given = F.map_filter(extras, lambda _, v: v.isNotNull() & (v != ""))
        base = F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(given, k)), given)
    return F.map_from_entries(F.array_sort(F.map_entries(base)))


def wire_json(value: Column) -> Column:
    """JSON text with markup characters and the two line separators escaped, as the wire format has them."""
    text = F.to_json(value)
    for raw, escaped in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def general_envelope(prompt: Column, context: Column, history: Column | None = None) -> Column:
    fields = [context.alias("context")]
    if history is not None:
        fields.append(F.nullif(history, F.lit("")).alias("conversation_history"))
    return wire_json(F.struct(*fields, prompt.alias("prompt"), F.lit("full").alias("scan_type")))


def channel_envelope(content: Column, channel: Column, context: Column) -> Column:
    return wire_json(F.struct(content.alias("content"), channel.alias("content_type"), context.alias("context")))


def tool_schema_envelope(name: Column, description: Column, input_schema: Column | None = None) -> Column:
    fields = [description.alias("description")]
    if input_schema is not None:
        fields.append(input_schema.alias("input_schema"))
    return wire_json(F.struct(*fields, name.alias("name")))


def route_channel(kind: Column, content: Column) -> Column:
    """Channel of an action. A file with content and one without go different ways."""
    with_body = F.coalesce(content, F.lit("")) != ""
    return (
        F.when(kind == "file", F.when(with_body, "file_content").otherwise("file_path"))
        .when(kind == "tool_schema", "mcp_schema")
        .otherwise(kind)
    )


#: Context keys whose values are flags.
FLAGS = ("allow_destructive", "verify_signature")


def channel_context(channel: Column, options: Mapping[str, Column]) -> Column:
    """The optional context of a request as a map: of the given options those that its channel knows and that are set.

    Text counts as set unless it is empty; a flag only where it is true, and goes as the text `true`.
    """
    entries = []
    for name, value in options.items():
        homes = [c for c, (keys, _) in CHANNELS.items() if name in keys]
        if not homes:
            raise ValueError(f"no channel has the context key {name!r}")
        text = F.when(value.cast("string") == "true", "true") if name in FLAGS else value.cast("string")
        entries.append(F.struct(F.lit(name).alias("key"), F.when(channel.isin(homes) & (text != ""), text).alias("value")))
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def channel_request(
    channel: Column, content: Column, options: Mapping[str, Column], session: Column, agent: Column, default_session: Column,
    default_agent: Column, agent_override: Column | None = None,
) -> Column:
    """The body of a request to any specialised channel, with the context that the channel has."""
    extras = channel_context(channel, options)
    return channel_envelope(content, channel, identity_context(session, agent, default_session, default_agent, agent_override, extras=extras))


def wire_hash(*parts: Column) -> Column:
    """Hash of the parts put together bare, as the reference cache does. Different parts may collide."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def content_hash(**parts: Column) -> Column:
    """Hash of all parts with names and lengths, so that different inputs never share a key."""
    pieces = []
    for name, part in parts.items():
        value = F.coalesce(part, F.lit(""))
        pieces += [F.lit(f"{name}="), F.octet_length(value).cast("string"), F.lit(":"), value]
    return F.sha2(F.concat(*pieces), 256)


def encoded_chunks(chunks: Column) -> Column:
    """Chunks as content: one goes as it is, several as a JSON array; none is `[]`, a missing list `null`."""
    return (
        F.when(chunks.isNull(), "null").when(F.size(chunks) == 1, F.get(chunks, F.lit(0))).otherwise(wire_json(chunks))
    )


def extras_map(values: Mapping[str, Column]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])
