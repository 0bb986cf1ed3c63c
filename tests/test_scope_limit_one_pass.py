from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from test_activity import T0, _declare
from veilstone.operators import scopes


def test_action_limit_counts_from_each_scope(spark):
    # the count of actions starts again with each accepted declaration, over hours and across agents
    history = scopes.scope_history(_declare(spark, (0, ["read"], None, None, None, None), (3, ["read"], None, None, None, None)))
    hours = [0.5, 1.5, 2.5, 2.6, 3.0, 3.5, 4.5, 5.5]
    rows = [(a, T0 + timedelta(hours=h), i + 100 * n, "read", "allow", False) for n, a in enumerate("ab") for i, h in enumerate(hours)]
    table = spark.createDataFrame(rows, "agent_id string, ts timestamp, request_id bigint, tool string, action string, blocked boolean")
    limited = scopes.scope_enforce(table, history.withColumn("most", F.lit(2)), "most")
    got = {r["request_id"]: r["hold_reason"] for r in limited.collect()}
    assert got == {**{i: [None, None, "action_limit", "action_limit", None, None, "action_limit", "action_limit"][i] for i in range(8)}, **{100 + i: None for i in range(8)}}
