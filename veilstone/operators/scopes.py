"""Agent scopes: what an agent may do, since when, until when, and what that means for its actions.

A declaration has agent_id, declared_at, seq (order within one instant), allowed_tools, forbidden_tools, purpose,
max_duration_seconds, expires_at and renewable_seconds. NULL means unset; an empty list means no tools.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilstone.functions.frames import Running, null_safe_join, running, skew_safe_lookup

INHERITED = ("allowed_tools", "forbidden_tools", "purpose", "max_duration_seconds", "expires_at")
_ORDER = ("declared_at", "seq")


def _days(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / 86_400)


def _tools(tools: Column) -> Column:
    return F.array_sort(F.array_distinct(tools))


def within(tools: Column, allowed: Column) -> Column:
    """Whether every tool is allowed; `*` stands for any tool, and only `*` covers it."""
    return F.array_contains(allowed, "*") | (F.size(F.array_except(tools, allowed)) == 0)


def _add_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("bigint") * 1_000_000)


def scope_merge(declarations: DataFrame, accepted: Column | None = None) -> DataFrame:
    """The scope in force after each declaration.

    Unset fields are inherited, the time limit starts again with each declaration, and the renewal window is the one
    of the first declaration for good. With `accepted`, declarations where it is false leave no trace.
    """
    counts = F.lit(True) if accepted is None else accepted
    values = {
        f"_{c}": Running("last", F.when(counts, F.col(c))) for c in INHERITED
    }
    values["active_from"] = Running("last", F.when(counts, F.col("declared_at")))
    values["_grant"] = Running("first", F.struct("declared_at", "renewable_seconds"))
    merged = running(declarations, ["agent_id"], _ORDER, _days(F.col("declared_at")), values)
    replaced = {
        **{c: F.col(f"_{c}") for c in INHERITED},
        "renewable_seconds": F.col("_grant.renewable_seconds"),
        "granted_at": F.col("_grant.declared_at"),
    }
    return merged.withColumns(replaced).drop("_grant", *[f"_{c}" for c in INHERITED])


def _narrows(allowed: Column, forbidden: Column, state: Column) -> Column:
    keeps = allowed.isNull() | within(allowed, state["allowed"])
    still = forbidden.isNull() | (F.size(F.array_except(state["forbidden"], forbidden)) == 0)
    return keeps & still


def _state_logs(declarations: DataFrame) -> DataFrame:
    """One row per agent: `granted` (its first declaration) and `log` (each accepted change of tools, in order).

    A scope only ever narrows, so a declaration refused once stays refused, and one repeated later changes nothing:
    only the first time an agent declares a set of tools can matter. The sequential part therefore runs over the
    distinct sets that narrow the grant, not over the declarations.
    """
    sets = declarations.groupBy("agent_id", "_allowed", "_forbidden").agg(
        F.min(F.struct(*_ORDER)).alias("at"), F.min_by("renewable_seconds", F.struct(*_ORDER)).alias("_renewable")
    )
    none = F.array().cast("array<string>")
    state = F.struct(
        F.coalesce("_allowed", none).alias("allowed"), F.coalesce("_forbidden", none).alias("forbidden")
    )
    first = F.struct("at", F.col("_renewable").alias("renewable_seconds"), state.alias("state"))
    by_time = Window.partitionBy("agent_id").orderBy("at")
    placed = sets.withColumn("granted", F.first(first).over(by_time))
    granted = F.col("granted")
    ceiling = _add_seconds(granted["at"]["declared_at"], granted["renewable_seconds"])
    in_time = F.coalesce(F.col("at.declared_at") <= ceiling, F.lit(True))
    later = in_time & (F.col("at") != granted["at"]) & _narrows(F.col("_allowed"), F.col("_forbidden"), granted["state"])
    history = placed.groupBy("agent_id").agg(
        F.any_value("granted").alias("granted"),
        F.sort_array(F.collect_list(F.when(later, F.struct("at", "_allowed", "_forbidden")))).alias("sets"),
    )

    def step(acc: Column, s: Column) -> Column:
        before = acc["state"]
        now = F.struct(
            F.coalesce(s["_allowed"], before["allowed"]).alias("allowed"),
            F.coalesce(s["_forbidden"], before["forbidden"]).alias("forbidden"),
        )
        entry = F.struct(s["at"].alias("at"), now.alias("state"))
        grown = F.struct(now.alias("state"), F.array_append(acc["log"], entry).alias("log"))
        return F.when(_narrows(s["_allowed"], s["_forbidden"], before), grown).otherwise(acc)

    opening = F.struct(granted["at"].alias("at"), granted["state"].alias("state"))
    zero = F.struct(granted["state"].alias("state"), F.array(opening).alias("log"))
    return history.select("agent_id", "granted", F.aggregate("sets", zero, step, lambda acc: acc["log"]).alias("log"))


def scope_change_check(declarations: DataFrame) -> DataFrame:
    """Adds `status`: declared, accepted, widening or ceiling_reached; a refused declaration changes nothing.

    Also adds `state`, the tools in force once the declaration was dealt with.
    """
    dec = declarations.withColumns(
        {"_allowed": _tools(F.col("allowed_tools")), "_forbidden": _tools(F.col("forbidden_tools"))}
    )
    # one agent may declare most; its log has an entry for each change of tools, which only ever narrow
    counts = dec.groupBy("agent_id").agg(F.count(F.lit(1)).alias("n"))
    known = skew_safe_lookup(dec, _state_logs(dec), counts, "agent_id", "seq")
    granted, here = F.col("granted"), F.struct(*_ORDER)
    ceiling = _add_seconds(granted["at"]["declared_at"], granted["renewable_seconds"])
    in_force = F.element_at(F.filter("log", lambda e: e["at"] <= here), -1)["state"]
    stated = known.withColumn("state", in_force)
    status = (
        F.when(here == granted["at"], "declared")
        .when(F.col("declared_at") > ceiling, "ceiling_reached")
        .when(_narrows(F.col("_allowed"), F.col("_forbidden"), F.col("state")), "accepted")
        .otherwise("widening")
    )
    return stated.withColumn("status", status).select(*declarations.columns, "status", "state")


def scope_history(declarations: DataFrame) -> DataFrame:
    """Declarations that were accepted, each with the whole scope in force from then on."""
    checked = scope_change_check(declarations).drop("state")
    accepted = F.col("status").isin("declared", "accepted")
    return scope_merge(checked, accepted).where(accepted)


def scope_expiry(scopes: DataFrame, at: Column) -> DataFrame:
    """Adds active_until, expired, renewable_until and ceiling_reached at a moment.

    Where both a duration and an absolute end are set, the earlier one counts; the reference leaves that open.
    """
    limit = _add_seconds(F.col("active_from"), F.col("max_duration_seconds"))
    renewable = _add_seconds(F.col("granted_at"), F.col("renewable_seconds"))
    until = F.least(limit, F.col("expires_at"))
    return scopes.withColumns(
        {
            "active_until": until,
            "expired": F.coalesce(at >= until, F.lit(False)),
            "renewable_until": renewable,
            "ceiling_reached": F.coalesce(at > renewable, F.lit(False)),
        }
    )


def scope_enforce(actions: DataFrame, scopes: DataFrame, action_limit: str | None = None) -> DataFrame:
    """Hold actions that their agent's scope does not cover.

    `actions` has agent_id, ts, request_id (which tells them apart), tool, action and blocked; `scopes` is a scope history.
    Each action meets the newest scope declared by then, found by one ordered pass over both tables, which copes with one agent doing
    most of the work. Reasons in order: expired, forbidden, not allowed, limit of actions reached (a column of
    `scopes`, if named). A content block stands; any other held action waits for approval and keeps its content
    verdict beside it. An agent without a scope is not held.
    """
    scope = scope_expiry(scopes, F.lit(None).cast("timestamp"))
    limit = F.col(action_limit) if action_limit else F.lit(None).cast("bigint")
    at = F.struct(F.col("declared_at").alias("ts"), F.col("seq").cast("bigint").alias("request_id"))
    record = F.struct(
        "allowed_tools", "forbidden_tools", "active_until", limit.cast("bigint").alias("limit"), at.alias("at")
    )
    given = scope.select(
        "agent_id", F.col("declared_at").alias("ts"), F.lit(0).alias("_kind"),
        F.col("seq").cast("bigint").alias("request_id"), record.alias("_scope"),
    )
    # the pass over time needs only who, when and what; verdicts are joined to its result
    narrow = actions.select("agent_id", "ts", F.col("request_id").cast("bigint").alias("request_id"), "tool")
    done = narrow.withColumn("_kind", F.lit(1)).unionByName(given, allowMissingColumns=True)
    order = ("ts", "_kind", "request_id")
    bucket = F.floor(F.unix_seconds("ts") / 3600)
    values = {"_in_force": Running("last", F.col("_scope"), sparse=True)}
    if action_limit:
        values["_acts"] = Running("sum", F.col("_kind").cast("bigint"))
    passed = running(done, ["agent_id"], order, bucket, values)
    placed = passed.where("_kind = 1")
    if action_limit:
        # One pass: a scope row's count of actions so far, handed to the actions under that scope by its identity.
        since = passed.where("_kind = 0").groupBy(
            "agent_id", F.struct("ts", "request_id").alias("_at")
        ).agg(F.max("_acts").alias("_since"))
        placed = null_safe_join(placed.withColumn("_at", F.col("_in_force.at")), since, ["agent_id", "_at"])
    force = F.col("_in_force")
    used = (F.col("_acts") - F.col("_since")) > force["limit"] if action_limit else F.lit(False)
    reason = (
        F.when(force.isNull(), None)
        .when(F.col("ts") >= force["active_until"], "expired")
        .when(F.array_contains(force["forbidden_tools"], F.col("tool")), "forbidden")
        .when(~within(F.array("tool"), force["allowed_tools"]), "not_allowed")
        .when(used, "action_limit")
    )
    told = placed.select("request_id", reason.alias("hold_reason")).where("hold_reason IS NOT NULL")
    held = F.col("hold_reason").isNotNull()
    stands = F.coalesce(F.col("blocked"), F.lit(False)) & ~F.col("action").eqNullSafe("require_approval")
    waits = held & ~stands
    return null_safe_join(actions, told, ["request_id"]).select(
        *[c for c in actions.columns if c != "action"],
        F.when(waits, "require_approval").otherwise(F.col("action")).alias("action"),
        "hold_reason",
        held.alias("held_by_scope"),
        F.when(waits, F.col("action")).alias("content_action"),
    )
