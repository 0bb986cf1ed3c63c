"""Stream results equal batch results on the same rows, over several batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilstone.operators import scopes, sessions
from veilstone.sources.sinks import run_stream, run_to_end, write_vault
from veilstone.sources.tables import stream_table
from veilstone.streaming import windows
from veilstone.streaming.scopes import stream_scope_enforce
from veilstone.streaming.sessions import stream_session_state

T0 = datetime(2024, 1, 1)
SCHEMA = "session_id string, ts timestamp, request_id bigint, risk double, threat string, content string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three files, later ones with later rows."""
    path = tmp_path_factory.mktemp("stream")
    for part in range(3):
        rows = [
            (f"s{i % 4}", T0 + timedelta(hours=part, minutes=i), part * 100 + i, ((part * 7 + i * 3) % 10) / 10, "session_locked" if (part, i) in ((1, 5), (2, 9)) else "x", f"c{i % 5}")
            for i in range(30)
        ]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).toPandas().to_parquet(path / f"acts-{part}.parquet", coerce_timestamps="us")
    (path / "acts.parquet").mkdir()
    return str(path)


def _stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "acts-*.parquet").option("maxFilesPerTrigger", 1).parquet(folder)


def test_session_triggers(spark, folder):
    batch = spark.read.schema(SCHEMA).option("pathGlobFilter", "acts-*.parquet").parquet(folder)
    want = sorted(tuple(r) for r in sessions.session_triggers(batch).select("session_id", "reason", "request_id", "risk").collect())
    got = run_stream(spark, stream_session_state(spark, _stream(spark, folder)), "t-state")
    assert sorted(tuple(r) for r in got.select("session_id", "reason", "request_id", "risk").collect()) == want
    assert {w[1] for w in want} == {"session_locked", "risk_threshold_exceeded"}


def test_content_passes_again_after_its_time_to_live(spark, folder):
    kept = run_stream(spark, windows.stream_dedup(_stream(spark, folder), "ts", "content", "5 minutes"), "t-dedup")
    # Each file begins an hour after the one before. The watermark that the first file sets clears the state at the
    # end of the second batch, so the third file's contents pass again.
    assert {r["content"]: r["count"] for r in kept.groupBy("content").count().collect()} == {f"c{i}": 2 for i in range(5)}
    first = kept.groupBy("content").agg({"ts": "min"}).collect()
    assert all(r["min(ts)"] < T0 + timedelta(minutes=5) for r in first)


def test_closed_windows_only(spark, folder):
    rated = run_stream(
        spark, windows.stream_degraded_rate(_stream(spark, folder).selectExpr("ts", "threat = 'session_locked' AS degraded"), "ts", "degraded", "10 minutes"), "t-rate"
    )
    assert {(r["window_start"], r["n"]) for r in rated.collect()} == {(T0, 30), (T0 + timedelta(hours=1), 30)}


def test_all_windows_at_the_end(spark, folder):
    marked = _stream(spark, folder).selectExpr("ts", "threat = 'session_locked' AS degraded")
    rated = run_to_end(spark, windows.stream_degraded_rate(marked, "ts", "degraded", "10 minutes"), "t-all", ["window_start"])
    assert {(r["window_start"], r["n"]) for r in rated.collect()} == {(T0 + timedelta(hours=h), 30) for h in range(3)}
    counts = windows.stream_session_counts(_stream(spark, folder), "ts", "session_id", "20 minutes")
    ended = run_to_end(spark, counts, "t-stretch", ["session_id", "stretch_start"], "complete")
    assert sum(r["actions"] for r in ended.collect()) == 90 and ended.count() == 12


def test_stream_table_reads_a_file_or_a_folder(spark, small, tmp_path):
    assert stream_table(spark, small, "events").isStreaming
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    rows.write.parquet(str(tmp_path / "t.parquet"))
    rows.toPandas().to_parquet(tmp_path / "one.parquet")
    rows.toPandas().to_parquet(tmp_path / "one_old.parquet")
    for name in ("t", "one"):
        assert run_stream(spark, stream_table(spark, str(tmp_path), name), f"t-{name}").count() == 1


def test_vault_is_partitioned_by_type(spark, tmp_path):
    vault = spark.createDataFrame([(1, "[EMAIL_1]", "a@b.cc", "email", 0), (1, "[SSN_1]", "123-45-6789", "ssn", 9)], "id int, token string, original string, type string, position int")
    write_vault(vault, str(tmp_path / "vault"))
    assert sorted(p.name for p in (tmp_path / "vault").glob("type=*")) == ["type=email", "type=ssn"]
    assert spark.read.parquet(str(tmp_path / "vault")).where("type = 'ssn'").count() == 1


def _scope_rows(seed):
    rng = random.Random(seed)
    tools = ["read", "write", "run", "send"]
    pick = lambda: rng.choice([None, None, [], ["*"], ["read"], ["read", "write"], ["read", "write", "run"]])
    declared = [
        (f"a{rng.randrange(4)}", T0 + timedelta(minutes=rng.randrange(900), seconds=rng.randrange(60), microseconds=rng.choice([0, 500_000])), i, pick(),
         rng.choice([None, None, ["send"], ["run", "send"]]), rng.choice([None, 3_600, 20_000]),
         rng.choice([None, None, T0 + timedelta(hours=8)]), rng.choice([None, 9_000, 40_000]))
        for i in range(60)
    ]
    acted = [(f"a{rng.randrange(5)}", T0 + timedelta(minutes=rng.randrange(900), seconds=rng.randrange(60)), 1_000 + i, rng.choice([*tools, None])) for i in range(400)]
    return declared, acted


DECLARED = "agent_id string, declared_at timestamp, seq int, allowed_tools array<string>, forbidden_tools array<string>, max_duration_seconds int, expires_at timestamp, renewable_seconds int"
ACTED = "agent_id string, ts timestamp, request_id bigint, tool string"


@pytest.mark.parametrize("seed,cuts", [(1, 1), (1, 5), (2, 3)])
def test_scopes_are_enforced_as_in_a_batch_at_any_split(spark, tmp_path, seed, cuts):
    """Actions and declarations are one stream of files, cut by time, and told apart by what they carry."""
    declared, acted = _scope_rows(seed)
    declarations, actions = spark.createDataFrame(declared, DECLARED), spark.createDataFrame(acted, ACTED)
    history = scopes.scope_history(declarations.withColumn("purpose", F.lit("p")))
    batch = scopes.scope_enforce(actions.selectExpr("*", "'allow' AS action", "false AS blocked"), history)
    want = {r["request_id"]: r["hold_reason"] for r in batch.collect()}
    assert len(set(want.values())) == 4
    ends = [T0 + timedelta(minutes=900 * (k + 1) // cuts) for k in range(cuts - 1)] + [T0 + timedelta(days=9)]
    for k, end in enumerate(ends):
        begin = ends[k - 1] if k else T0 - timedelta(days=1)
        part = [(a, at, 0, i, None, *rest) for a, at, i, *rest in declared if begin <= at < end]
        part += [(a, at, 1, i, tool, None, None, None, None, None) for a, at, i, tool in acted if begin <= at < end]
        rows = spark.createDataFrame(part, ONE)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "one"))
    stream = spark.readStream.schema(ONE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "one"))
    given = stream.where("kind = 0").selectExpr("agent_id", "at AS declared_at", "id AS seq", *DECLARED_MORE)
    done = stream.where("kind = 1").selectExpr("agent_id", "at AS ts", "id AS request_id", "tool")
    held = run_stream(spark, stream_scope_enforce(spark, given, done), f"t-scope-{seed}-{cuts}").collect()
    assert {r["request_id"]: r["hold_reason"] for r in held} == want and len(held) == len(acted)


DECLARED_MORE = ("allowed_tools", "forbidden_tools", "max_duration_seconds", "expires_at", "renewable_seconds")
ONE = "agent_id string, at timestamp, kind int, id bigint, tool string, allowed_tools array<string>, forbidden_tools array<string>, max_duration_seconds int, expires_at timestamp, renewable_seconds int"


def test_idle_sessions_leave_the_state(spark, tmp_path):
    """Three files, each four days after the one before: only sessions of the last file are still there."""
    for part in range(3):
        rows = [(f"p{part}-s{i}", T0 + timedelta(days=4 * part, minutes=i), part * 10 + i, 0.9, "x", "c") for i in range(5)]
        rows.append(("ever", T0 + timedelta(days=4 * part), part * 10 + 9, 0.9, "x", "c"))
        spark.createDataFrame(rows, SCHEMA).coalesce(1).toPandas().to_parquet(tmp_path / f"acts-{part}.parquet", coerce_timestamps="us")
    stream = stream_session_state(spark, _stream(spark, str(tmp_path)))
    done = stream.writeStream.format("memory").queryName("idle").option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    done.awaitTermination()
    found = spark.table("idle").groupBy("session_id").count().collect()
    # the watermark moves between batches, so the one that comes back in each batch is never found idle
    assert {r["session_id"]: r["count"] for r in found} == {f"p{p}-s{i}": 1 for p in range(3) for i in range(5)} | {"ever": 1}
    state = spark.read.format("statestore").option("stateVarName", "session").load(str(tmp_path / "progress"))
    left = {r["key"]["session_id"] if "session_id" in r["key"] else r["key"][0] for r in state.select("key").collect()}
    assert left == {f"p2-s{i}" for i in range(5)} | {"ever"}
