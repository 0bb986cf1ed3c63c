"""Deduplication with a time to live against a cache that is walked row by row, in batches and streams."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilstone.operators import expiry
from veilstone.sources.sinks import run_stream
from veilstone.streaming.windows import stream_dedup_within

T0 = datetime(2024, 1, 1)
SCHEMA = "id bigint, ts timestamp, content string"


def walked(rows, seconds):
    """scan id by row id."""
    kept, out = {}, {}
    for i, ts, content in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[0])):
        stored = kept.get(content)
        if stored is None or ts - stored[0] > timedelta(seconds=seconds):
            kept[content] = stored = (ts, i)
        out[i] = stored[1]
    out |= {r[0]: r[0] for r in rows if r[1] is None or r[2] is None}
    return out


def some_rows(seed, n=600):
    rng = random.Random(seed)
    hot = [rng.choice([1, 1, 5, 59, 60, 61, 299, 300, 301]) for _ in range(n)]
    rows, at = [], 0
    for i in range(n):
        at += hot[i] if rng.random() < 0.4 else 0
        content = "hot" if rng.random() < 0.5 else f"c{rng.randrange(20)}"
        rows.append((i, T0 + timedelta(seconds=at, microseconds=rng.choice([0, 0, 1])), content))
    order = list(range(n))
    rng.shuffle(order)
    return [(order[i], ts, c) for i, ts, c in rows] + [(n, None, "hot"), (n + 1, T0, None)]


@pytest.mark.parametrize("seed,seconds", [(0, 300), (1, 60), (2, 7)])
def test_batch_equals_the_walk(spark, seed, seconds):
    rows = some_rows(seed)
    table = spark.createDataFrame(rows, SCHEMA)
    got = expiry.dedup_within(table, "id", "ts", F.col("content"), seconds=seconds).collect()
    want = walked(rows, seconds)
    assert {r["id"]: r["scan_id"] for r in got} == want and len(got) == len(rows)
    assert all(r["scanned"] == (r["id"] == r["scan_id"]) for r in got)
    assert len({w for w in want.values()}) > 10


def test_a_long_chain_of_one_content(spark):
    """Every row is scanned but each second one: a chain of 400 links, found by doubling."""
    rows = [(i, T0 + timedelta(seconds=200 * i), "one") for i in range(800)]
    got = expiry.dedup_within(spark.createDataFrame(rows, SCHEMA), "id", "ts", F.col("content")).collect()
    assert {r["id"]: r["scan_id"] for r in got} == walked(rows, 300)
    assert sum(r["scanned"] for r in got) == 400


def test_verdicts_and_empty_tables(spark):
    rows = [(1, T0, "a"), (2, T0 + timedelta(seconds=300), "a"), (3, T0 + timedelta(seconds=301), "a"), (4, T0, "b")]
    table = spark.createDataFrame(rows, SCHEMA)
    scan = lambda d: d.withColumn("verdict", F.concat("content", F.col("id").cast("string")))
    run = lambda t: expiry.dedup_within(t, "id", "ts", F.sha2("content", 256), ["content"], scan, ["verdict"])
    assert {(r["id"], r["verdict"], r["scanned"]) for r in run(table).collect()} == {(1, "a1", True), (2, "a1", False), (3, "a3", True), (4, "b4", True)}
    assert run(table.where("false")).collect() == []
    stats = expiry.expiry_stats(expiry.dedup_within(table, "id", "ts", F.col("content"))).first()
    assert (stats["hits"], stats["misses"], stats["hit_rate"]) == (1, 3, 0.25)
    assert expiry.expiry_stats(expiry.dedup_within(table.where("false"), "id", "ts", F.col("content"))).first()["hit_rate"] == 0


@pytest.mark.parametrize("cuts", [1, 4, 9])
def test_stream_equals_batch_at_any_split(spark, tmp_path, cuts):
    rows = sorted((r for r in some_rows(5, 300) if r[1] and r[2]), key=lambda r: (r[1], r[0]))
    for k in range(cuts):
        part = spark.createDataFrame(rows[k * len(rows) // cuts : (k + 1) * len(rows) // cuts], SCHEMA)
        part.toPandas().to_parquet(tmp_path / f"p-{k}.parquet", coerce_timestamps="us")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = run_stream(spark, stream_dedup_within(spark, stream, "id", "ts", "content", 60), f"t-within-{cuts}").collect()
    assert {r["id"]: r["scan_id"] for r in got} == walked(rows, 60) and len(got) == len(rows)
