"""Raw verdicts to a fixed, safe-to-share record, and reports over those records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.functions import dims
from veilstone.functions import verdicts as V
from veilstone.functions.frames import computed_once


def parse_verdict(df: DataFrame, raw: str = "raw", more: Sequence[str] = ()) -> DataFrame:
    """Adds `v` (a struct with one variant per known field), `parsed`, and the scalars with strict typing.

    `more` names further fields to read into `v`.
    """
    read = computed_once(df, "v", V.read_json(F.col(raw), (*V.FIELDS, *more)))
    v = F.col("v")
    texts = ("action", "refuse_tier", "reason", "content_type", "content_origin")
    return read.withColumn("parsed", V.is_verdict(F.col(raw), v)).withColumns(
        {
            # `safe` defaults to true when it is absent or not a boolean.
            "safe": F.when(F.col("parsed"), F.coalesce(V.flag_of(v["safe"]), F.lit(True))),
            **{name: F.when(F.col("parsed"), V.text_of(v[name])) for name in texts},
            "raw_threat_type": F.when(F.col("parsed"), V.effective_threat_code(v["threat_type"], v["violations"])),
            "raw_severity": F.when(F.col("parsed"), V.text_of(v["severity"])),
            "score": F.when(F.col("parsed"), V.number_of(v["confidence"])),
            "held_by_scope": F.col("parsed") & F.coalesce(V.flag_of(v["held_by_scope"]), F.lit(False)),
        }
    )


def normalize_threat_type(df: DataFrame, raw_type: str, out: str = "threat_type") -> DataFrame:
    """Raw threat type to its normalised name, by a lookup of fixed size."""
    codes = dims.threat_codes(df.sparkSession)
    joined = df.join(codes, V.threat_code(F.col(raw_type)) == F.col("_code"), "left")
    return joined.withColumn(out, V.mapped_threat(F.col(raw_type), F.col("_mapped"))).drop("_code", "_mapped")


def classify_threat(df: DataFrame, raw_type: str, raw_severity: str, guidance: dict[str, str] | None = None) -> DataFrame:
    """Adds threat_type, severity and guidance. Both lookups have a fixed size."""
    named = normalize_threat_type(df, raw_type)
    names = dims.threat_names(df.sparkSession, guidance)
    joined = named.join(names, "threat_type", "left")
    return joined.withColumn("severity", V.derive_severity(F.col(raw_severity), F.col("default_severity"))).drop(
        "default_severity"
    )


def sanitize_verdict(
    df: DataFrame, keep: Sequence[str], raw: str = "raw", guidance: dict[str, str] | None = None
) -> DataFrame:
    """The clean record: an allow-list of fields.

    Governance fields pass on safe and unsafe rows alike; threat type, severity, confidence and guidance exist on
    unsafe rows only. Objects stay variants. A row that is no verdict keeps `parsed` false and NULL fields.
    """
    read = classify_threat(parse_verdict(df, raw), "raw_threat_type", "raw_severity", guidance)
    read = read.withColumn("_violations", F.when(F.col("parsed"), V.clean_violations(F.col("v.violations"))))
    v, unsafe = F.col("v"), ~F.col("safe")
    guided = F.when(unsafe, F.col("guidance"))

    def passed(name: str) -> Column:
        return F.when(F.col("parsed"), V.object_of(v[name])).alias(name)

    return read.select(
        *keep,
        "parsed",
        "safe",
        F.coalesce("reason", guided).alias("reason"),
        F.when(unsafe, F.col("threat_type")).alias("threat_type"),
        F.when(unsafe, F.col("severity")).alias("severity"),
        F.when(unsafe, V.bucket_confidence(F.col("score"))).alias("confidence"),
        guided.alias("guidance"),
        F.when(F.size("_violations") > 0, F.col("_violations")).alias("violations"),
        "action",
        "refuse_tier",
        passed("recovery"),
        passed("session_state"),
        "content_type",
        "content_origin",
        passed("approval_info"),
        "held_by_scope",
        passed("content_verdict"),
        F.when(
            F.col("parsed") & (V.kind(v["client_session_rotation"]) != "VOID"), v["client_session_rotation"]
        ).alias("client_session_rotation"),
        F.lit(False).alias("degraded"),
        V.is_blocked(F.coalesce("action", F.lit("")), F.col("safe")).alias("blocked"),
        "raw_threat_type",
    )


def sanitize_violations(df: DataFrame, key: str, raw: str = "raw") -> DataFrame:
    """One row per kept field of each violation: position, field name and value as JSON."""
    read = computed_once(df.select(key, raw), "v", V.read_json(F.col(raw), ("violations",)))
    whole = read.where(V.is_verdict(F.col(raw), F.col("v")))
    cleaned = whole.select(key, V.clean_violations(F.col("v.violations")).alias("items"))
    items = cleaned.select(key, F.posexplode_outer("items").alias("pos", "item")).where(F.col("item").isNotNull())
    fields = items.select(key, "pos", F.explode_outer("item").alias("field", "value"))
    return fields.where(F.col("field").isNotNull()).select(key, "pos", "field", F.to_json("value").alias("value"))


def attribute_origin(df: DataFrame, channel: str = "channel", out: str = "content_origin") -> DataFrame:
    """Who is behind the content of a channel. An unknown channel counts as the agent, never as the operator."""
    origins = dims.channel_origins(df.sparkSession).withColumnRenamed("channel", "_channel")
    joined = df.join(origins, F.col(channel) == F.col("_channel"), "left")
    named = joined.withColumn(out, F.coalesce("origin", F.lit("agent_action"))).drop("origin", "_channel")
    return named.withColumn("attributable", V.attributable_to_operator(F.col(out)))


def verdict_contract_audit(df: DataFrame, raw: str = "raw", channel: str = "content_type") -> DataFrame:
    """Verdicts of each channel, and how many break each rule of the contract: one row per channel and rule."""
    clean = parse_verdict(df, raw, dims.INTERNAL_KEYS).where("parsed")
    v = F.col("v")
    leaked = F.array(*[v[name].isNotNull() for name in dims.INTERNAL_KEYS])
    rules = {
        "missing_tier": F.col("refuse_tier").isNull(),
        "unknown_tier": ~F.col("refuse_tier").isin(*dims.TIERS),
        "missing_recovery": V.object_of(v["recovery"]).isNull(),
        "missing_session_state": V.object_of(v["session_state"]).isNull(),
        "unknown_origin": ~F.col("content_origin").isin(*dims.ORIGINS),
        "internal_key": F.array_contains(leaked, True),
    }
    wide = clean.groupBy(F.coalesce(channel, F.lit("(none)")).alias("channel")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(rule).alias(name) for name, rule in rules.items()]
    )
    return wide.unpivot(["channel", "n"], list(rules), "rule", "broken")


def verdict_rollup(clean: DataFrame, dims_: Sequence[str]) -> DataFrame:
    """Counts and blocked counts for every combination of the columns, subtotals included."""
    named = clean.select(*[F.coalesce(d, F.lit("(none)")).alias(d) for d in dims_], "blocked")
    cubed = named.cube(*dims_).agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("n_blocked"))
    return cubed.select(
        *[F.coalesce(d, F.lit("(all)")).alias(d) for d in dims_],
        "n",
        "n_blocked",
        (F.col("n_blocked") / F.col("n")).alias("blocked_rate"),
    )


def top_threats(clean: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent threat types of unsafe verdicts."""
    counts = clean.where(~F.col("safe")).groupBy("threat_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "threat_type").limit(k)
