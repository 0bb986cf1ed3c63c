"""Session risk: rotation and lock decisions, timelines, holds and isolation audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.functions.frames import Running, hours, running, skew_safe_lookup
from veilstone.session import cut_lineage

ROTATION_LIMIT = 0.7

SESSION_KEYS = ("user_id", "session_id", "agent_id")


def rotation(
    raw_threat_type: Column, risk: Column, session: Column, own_session: Column, new_id: Column
) -> Column:
    """The rotation record of one verdict, NULL where nothing is due.

    A lock is tested first and on the raw type, because the normalised one no longer tells. Above the risk limit a
    caller's own session gets a suggestion, the built-in one is rotated.
    """
    locked = F.coalesce(raw_threat_type == "session_locked", F.lit(False))
    over = F.coalesce((risk >= ROTATION_LIMIT) & ~F.isnan(risk), F.lit(False))
    foreign = ~session.eqNullSafe(own_session)
    rotated = ~locked & over & ~foreign
    advised = ~locked & over & foreign
    record = F.struct(
        rotated.alias("rotated"),
        advised.alias("rotation_recommended"),
        F.when(foreign, "caller").otherwise("sdk_client").alias("owner"),
        F.when(locked, "session_locked").otherwise("risk_threshold_exceeded").alias("reason"),
        F.when(rotated, own_session).alias("previous_session_id"),
        F.when(rotated, new_id).alias("new_session_id"),
        F.when(~rotated, session).alias("current_session_id"),
        F.when(advised, new_id).alias("suggested_new_session_id"),
        risk.alias("triggering_risk_score"),
        F.lit(ROTATION_LIMIT).alias("configured_threshold"),
    )
    return F.when(locked | over, record)


def derived_session_id(session: Column, event: Column) -> Column:
    """A new session id that repeats from run to run; pass `F.uuid()` instead for a random one."""
    return F.substr(F.sha2(F.concat_ws("/", session, event.cast("string")), 256), F.lit(1), F.lit(32))


def evaluate_rotation(
    verdicts: DataFrame, event: str, threat: str, risk: str, session: str, own_session: str, out: str = "rotation"
) -> DataFrame:
    new_id = derived_session_id(F.col(session), F.col(event))
    record = rotation(F.col(threat), F.col(risk), F.col(session), F.col(own_session), new_id)
    return verdicts.withColumn(out, record)


def is_locked(record: Column) -> Column:
    return F.coalesce(~record["rotated"] & ~record["rotation_recommended"], F.lit(False))


def rotation_next_id(record: Column) -> Column:
    """The id to adopt, NULL where none is on offer."""
    return F.coalesce(record["new_session_id"], record["suggested_new_session_id"])


def session_timeline(
    events: DataFrame,
    keys: Sequence[str] = SESSION_KEYS,
    order: Sequence[str] = ("ts", "request_id"),
    risk: str = "risk",
) -> DataFrame:
    """Adds turn number, running top risk and the risk before, per session. How risk adds up is the scorer's
    business: it is an input."""
    return running(
        events,
        keys,
        order,
        hours(F.col(order[0])),
        {
            "turn": Running("count"),
            "max_risk": Running("max", F.col(risk)),
            "previous": Running("last", F.struct(F.col(risk).alias("risk")), before=True),
        },
    ).withColumn("previous", F.col("previous.risk")).withColumnRenamed("previous", "previous_risk")


def latest_session_state(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], state: Sequence[str]
) -> DataFrame:
    """The newest state of each session, by partial aggregation."""
    newest = F.max_by(F.struct(*order, *state), F.struct(*order))
    return events.groupBy(*keys).agg(newest.alias("_s"), F.count(F.lit(1)).alias("turns")).select(*keys, "turns", "_s.*")


def root_sessions(adoptions: DataFrame, session: str = "session_id", previous: str = "previous_session_id") -> DataFrame:
    """`session`, the `root` its chain of adopted ids began with, and the number of `hops` to it.

    `adoptions` has a row for each session that took over from another one. Chains are resolved by pointer doubling: every
    session points to the one before, then two back, then four, so a chain of n ids takes log2(n) rounds. A session
    that took over from itself by way of others has no root and is an error.
    """
    links = adoptions.select(F.col(session).alias("session"), F.col(previous).alias("root"), F.lit(1).cast("bigint").alias("hops"))
    links = cut_lineage(links.where("session IS NOT NULL AND root IS NOT NULL"))
    rounds = links.count().bit_length() + 1
    while True:
        ahead = links.select(F.col("session").alias("root"), F.col("root").alias("_root"), F.col("hops").alias("_hops"))
        counts = links.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        met = skew_safe_lookup(links, ahead, counts, "root", "session")
        if met.where("_root IS NOT NULL").isEmpty():
            return links
        if rounds == 0:
            raise ValueError("adopted session ids go round in a circle")
        onward = F.col("hops") + F.coalesce("_hops", F.lit(0))
        links = cut_lineage(met.select("session", F.coalesce("_root", "root").alias("root"), onward.alias("hops")))
        rounds -= 1


def latest_rotated_state(
    events: DataFrame, adoptions: DataFrame, order: Sequence[str], state: Sequence[str], session: str = "session_id", record: str = "rotation"
) -> DataFrame:
    """The newest state of each chain of sessions, with what rotation makes of it.

    `root` names the chain, `session` the id in force, `sessions` and `turns` how much there was; `locked`, `rotated`,
    `rotation_recommended` and `next_id` come from the newest event's rotation record. Events fold to a row for each session
    before sessions meet their roots.
    """
    newest = F.max_by(F.struct(*order, *state, record), F.struct(*order))
    folded = events.groupBy(F.col(session).alias("session")).agg(newest.alias("_s"), F.count(F.lit(1)).alias("turns"))
    roots = root_sessions(adoptions, session)
    joined = folded.join(roots.select("session", "root"), "session", "left").withColumn("root", F.coalesce("root", "session"))
    last = F.max_by(F.struct("session", "_s"), F.struct(*[F.col(f"_s.{c}") for c in order]))
    chains = joined.groupBy("root").agg(last.alias("_l"), F.count(F.lit(1)).alias("sessions"), F.sum("turns").alias("turns"))
    rotation_ = F.col(f"_l._s.{record}")
    return chains.select(
        "root",
        F.col("_l.session").alias("session"),
        "sessions",
        "turns",
        *[F.col(f"_l._s.{c}").alias(c) for c in (*order, *state)],
        is_locked(rotation_).alias("locked"),
        F.coalesce(rotation_["rotated"], F.lit(False)).alias("rotated"),
        F.coalesce(rotation_["rotation_recommended"], F.lit(False)).alias("rotation_recommended"),
        rotation_next_id(rotation_).alias("next_id"),
    )


def session_holds(
    events: DataFrame,
    refused: Column,
    released: Column,
    keys: Sequence[str] = SESSION_KEYS,
    order: Sequence[str] = ("ts", "request_id"),
) -> DataFrame:
    """Every hold of a session: from a refusal to the next release, or to the last action where none came.

    `started` and `ended` are the rows at either end, `released` whether a release ended it; `refusals` counts the refusals
    in it, `actions_held` the actions after the first refusal and before the release, `seconds` its length. A row that is
    both refuses. One ordered pass tells each row the latest release and the latest mark before it; then rows fold
    by session and latest release, so no session is worked off in one task.
    """
    refuses = F.coalesce(refused, F.lit(False))
    releases = F.coalesce(released, F.lit(False)) & ~refuses
    at = F.struct(*[F.col(c) for c in order])
    marks = events.select(*keys, *order, refuses.alias("_refuses"), releases.alias("_releases"))
    passed = running(
        marks,
        keys,
        order,
        hours(F.col(order[0])),
        {
            "_since": Running("last", F.when(F.col("_releases"), at), before=True),
            "_was": Running("last", F.when(F.col("_refuses"), True).when(F.col("_releases"), False), before=True),
        },
    )
    held = F.coalesce("_was", F.lit(False))
    ends = F.col("_releases") & held
    holds = passed.groupBy(*keys, "_since").agg(
        F.min(F.when(F.col("_refuses"), at)).alias("started"),
        F.min(F.when(ends, at)).alias("_release"),
        F.max(F.when(F.col("_refuses") | held, at)).alias("_last"),
        F.count_if("_refuses").alias("refusals"),
        F.count_if(held & ~ends).alias("actions_held"),
    )
    ended = F.coalesce("_release", "_last")
    length = F.floor((F.unix_micros(ended[order[0]]) - F.unix_micros(F.col("started")[order[0]])) / 1_000_000)
    return holds.where("started IS NOT NULL").select(
        *keys, "started", ended.alias("ended"), F.col("_release").isNotNull().alias("released"), "refusals", "actions_held",
        length.cast("bigint").alias("seconds"),
    )


def post_refusal_holds(
    events: DataFrame,
    keys: Sequence[str] = SESSION_KEYS,
    order: Sequence[str] = ("ts", "request_id"),
    blocked: str = "blocked",
) -> DataFrame:
    """Actions that come after a refusal in their session: the latest refusal, how many there were, and the time
    since the latest, in whole seconds."""
    ts, event = order[0], order[-1]
    refused = F.coalesce(F.col(blocked), F.lit(False))
    marked = running(
        events,
        keys,
        order,
        hours(F.col(ts)),
        {
            "refusals_before": Running("sum", refused.cast("bigint"), before=True),
            "_refusal": Running("last", F.when(refused, F.struct(F.col(ts).alias("at"), F.col(event).alias("id"))), True),
        },
    )
    waited = F.floor((F.unix_micros(ts) - F.unix_micros("_refusal.at")) / 1_000_000)
    return (
        marked.where(F.col("refusals_before") > 0)
        .withColumn("refusal_id", F.col("_refusal.id"))
        .withColumn("seconds_since_refusal", waited.cast("bigint"))
        .drop("_refusal")
    )


def session_triggers(
    events: DataFrame, session: str = "session_id", order: Sequence[str] = ("ts", "request_id")
) -> DataFrame:
    """When each session was first locked and first crossed the limit: the batch form of the stream operator.

    `events` has the raw threat type as `threat`, and `risk`.
    """
    locked = F.coalesce(F.col("threat") == "session_locked", F.lit(False))
    over = ~locked & (F.col("risk") >= ROTATION_LIMIT) & ~F.isnan(F.col("risk").cast("double"))
    reason = F.when(locked, "session_locked").when(over, "risk_threshold_exceeded")
    first = F.min(F.struct(*order, "risk"))
    marked = events.withColumn("reason", reason).where(locked | over)
    return marked.groupBy(session, "reason").agg(first.alias("_f")).select(session, "reason", "_f.*")


def session_isolation_audit(requests: DataFrame, content_hash: str, session: str = "session_id") -> DataFrame:
    """Contents seen in more than one session, where a reused verdict would cross sessions."""
    seen = requests.groupBy(content_hash).agg(
        F.count_distinct(session).alias("sessions"), F.count(F.lit(1)).alias("requests")
    )
    return seen.where(F.col("sessions") > 1)


def reused_verdicts(deduplicated: DataFrame, requests: DataFrame, session: str = "session_id") -> DataFrame:
    """Contents whose verdict was reused in another session than the one that was scanned: `content_hash`, its `requests`, how
    many were `reused`, how many of them `across` sessions, and the number of `sessions` that got a verdict from elsewhere.

    `deduplicated` comes from `expiry.dedup_within`, `requests` tells the session of each request. A session that is not
    known is another one.
    """
    here = requests.select("request_id", F.col(session).alias("_here"))
    there = requests.select(F.col("request_id").alias("scan_id"), F.col(session).alias("_there"))
    # a scan may be shared by very many requests
    counts = deduplicated.groupBy("scan_id").agg(F.count(F.lit(1)).alias("n"))
    met = skew_safe_lookup(deduplicated.join(here, "request_id"), there, counts, "scan_id", "request_id")
    elsewhere = ~F.col("scanned") & ~F.coalesce(F.col("_here") == F.col("_there"), F.lit(False))
    told = met.groupBy("content_hash").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~F.col("scanned")).alias("reused"),
        F.count_if(elsewhere).alias("across"),
        F.count_distinct(F.when(elsewhere, F.col("_here"))).alias("sessions"),
    )
    return told.where("across > 0")


def shared_session_audit(requests: DataFrame, session: str = "session_id", user: str = "user_id", exact: bool = True) -> DataFrame:
    """Sessions with more than one end user, who then share one risk score."""
    users = F.count_distinct(user) if exact else F.approx_count_distinct(user)
    counted = requests.groupBy(session).agg(users.alias("users"), F.count(F.lit(1)).alias("requests"))
    return counted.where(F.col("users") > 1)
