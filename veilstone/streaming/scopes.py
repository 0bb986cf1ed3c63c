"""Enforcement of agent scopes on a stream: declarations and actions in one operator, with the scope of each agent as state."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veilstone.session import STATE_STORE

OUTPUT = "agent_id STRING, request_id BIGINT, tool STRING, hold_reason STRING, held_by_scope BOOLEAN"
_SECOND = 1_000_000


@dataclass
class Scope:
    """An agent's scope in force. Times are in microseconds; None means unset. `closed`: it has expired and the window for
    renewal is over, so that nothing can change any more and the tools are forgotten."""

    ceiling: int | None
    allowed: list[str] | None
    forbidden: list[str] | None
    seconds: int | None
    expires: int | None
    since: int
    closed: bool = False

    @classmethod
    def declared(cls, d: dict) -> Scope:
        ceiling = None if d["renewable"] is None else d["us"] + d["renewable"] * _SECOND
        return cls(ceiling, d["allowed"], d["forbidden"], d["seconds"], d["expires"], d["us"])

    def until(self) -> int | None:
        ends = [self.expires, None if self.seconds is None else self.since + self.seconds * _SECOND]
        return min((e for e in ends if e is not None), default=None)

    def refresh(self, d: dict) -> bool:
        """A later declaration: taken if it comes in time and only narrows; fields left unset stay. True if taken."""
        allowed, forbidden = d["allowed"], d["forbidden"]
        late = self.closed or (self.ceiling is not None and d["us"] > self.ceiling)
        keeps = allowed is None or "*" in (self.allowed or []) or set(allowed) <= set(self.allowed or [])
        still = forbidden is None or set(self.forbidden or []) <= set(forbidden)
        if late or not keeps or not still:
            return False
        self.allowed = self.allowed if allowed is None else allowed
        self.forbidden = self.forbidden if forbidden is None else forbidden
        self.seconds = self.seconds if d["seconds"] is None else d["seconds"]
        self.expires = self.expires if d["expires"] is None else d["expires"]
        self.since = d["us"]
        return True

    def reason(self, us: int, tool: str | None) -> str | None:
        until = self.until()
        if self.closed or (until is not None and us >= until):
            return "expired"
        if self.forbidden is not None and tool in self.forbidden:
            return "forbidden"
        if self.allowed is not None and "*" not in self.allowed and tool not in self.allowed:
            return "not_allowed"
        return None


class Enforcement(StatefulProcessor):
    """Rows of an agent in the order of time, declarations before actions of the same instant. A timer at the moment from
    which nothing can change any more leaves only that in the state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.scope = handle.getValueState("scope", "json STRING")

    def _load(self) -> Scope | None:
        held = self.scope.get()
        return Scope(**json.loads(held[0])) if held is not None else None

    def _save(self, scope: Scope) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        until = scope.until()
        if not scope.closed and until is not None and scope.ceiling is not None:
            self.handle.registerTimer(max(until, scope.ceiling) // 1_000 + 1)
        self.scope.update((json.dumps(asdict(scope)),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        """Declarations are few: they are kept and replayed in order into the versions of the scope. Actions are kept only as
        arrays of time, id and tool number, and each finds its version by time, so an agent's rows never sit in Python
        objects at once, and results leave chunk by chunk."""
        declared: list[tuple[float, int, str]] = []
        acted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        numbers: dict[str, int] = {}
        for chunk in rows:
            kinds = chunk["kind"].to_numpy()
            given = chunk[kinds == 0]
            declared += zip(given["us"].astype("float64").tolist(), given["request_id"].tolist(), given["declaration"].tolist())
            done = chunk[kinds != 0]
            if len(done):
                codes, tools = pd.factorize(done["tool"])
                ours = np.array([numbers.setdefault(t, len(numbers)) for t in tools] + [-1], dtype=np.int64)
                # microseconds fit a double exactly; a missing time stays NaN and sorts last, as before
                acted.append((done["us"].to_numpy("float64", na_value=np.nan), done["request_id"].to_numpy("int64"), ours[codes]))
        scope = self._load()
        starts: list[float] = []
        versions: list[Scope | None] = [scope]
        # declarations before actions of the same instant; the order of time, then of number
        for us, seq, text in sorted(declared, key=lambda d: (np.inf if np.isnan(d[0]) else d[0], d[1])):
            declaration = {"us": int(us) if not np.isnan(us) else us, **json.loads(text)}
            if scope is None:
                scope = Scope.declared(declaration)
            else:
                candidate = replace(scope)
                if not candidate.refresh(declaration):
                    continue
                scope = candidate
            starts.append(us)
            versions.append(scope)
        if declared:
            self._save(scope)
        names = np.array([*numbers, None], dtype=object)
        bounds = np.array([np.nan if v is None or v.until() is None else v.until() for v in versions], dtype="float64")
        closed = np.array([v is not None and v.closed for v in versions])
        for us, ids, codes in acted:
            at = np.searchsorted(np.asarray(starts, dtype="float64"), us, side="right")
            expired = closed[at] | (us >= bounds[at])
            # the reason that the tool alone gives, once for each pair of version and tool (-1, no tool, is the last name)
            pairs, where = np.unique(at * len(names) + codes % len(names), return_inverse=True)
            told = [versions[p // len(names)] for p in pairs.tolist()]
            hold = np.array([None if v is None else v.reason(-np.inf, names[p % len(names)]) for v, p in zip(told, pairs.tolist())] + [None], dtype=object)[where]
            tools = names[codes]
            hold[expired] = "expired"
            yield pd.DataFrame(
                {"agent_id": key[0], "request_id": ids, "tool": tools, "hold_reason": hold, "held_by_scope": pd.notna(hold)}
            )

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        scope = self._load()
        if scope is not None:
            scope.allowed = scope.forbidden = None
            scope.closed = True
            self._save(scope)
        return iter(())

    def close(self) -> None:
        pass


def stream_scope_enforce(spark: SparkSession, declarations: DataFrame, actions: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Each action with the reason why its agent's scope holds it, as `scopes.scope_enforce` over `scopes.scope_history` tells,
    at any split into batches that follow time. Both are streams, with the columns that those operators take."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    fields = F.struct(
        F.col("allowed_tools").alias("allowed"),
        F.col("forbidden_tools").alias("forbidden"),
        F.col("max_duration_seconds").cast("bigint").alias("seconds"),
        F.col("renewable_seconds").cast("bigint").alias("renewable"),
        F.unix_micros("expires_at").alias("expires"),
    )
    given = declarations.select(
        "agent_id", F.col("declared_at").alias("ts"), F.lit(0).alias("kind"), F.col("seq").cast("bigint").alias("request_id"),
        F.lit(None).cast("string").alias("tool"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("declaration"),
    )
    done = actions.select(
        "agent_id", "ts", F.lit(1).alias("kind"), F.col("request_id").cast("bigint").alias("request_id"), "tool",
        F.lit(None).cast("string").alias("declaration"),
    )
    both = given.unionByName(done).withColumn("us", F.unix_micros("ts"))
    return (
        both.withWatermark("ts", late)
        .groupBy("agent_id")
        .transformWithStateInPandas(statefulProcessor=Enforcement(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
    )
