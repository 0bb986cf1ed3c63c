"""Sharding and mixing: by rule and by brute force."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations, product

import pytest
from llm_rows import AWKWARD, doc
from pyspark.sql import functions as F

from veilstone.llm import mixing, sharding



def test_shards_of_awkward_rows(run):
    rows = run("op4_hash_tree_shards", documents=AWKWARD)
    texts = [r[1] or "" for r in AWKWARD]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d[0], len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in zip(AWKWARD, texts, strict=True)
    )
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert {r.law for r in rows} == {"key"} and len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert run("op4_hash_tree_shards") == []


def test_one_more_shard_takes_only_into_itself(spark):
    tree = sharding.even_tree(2, 2, 2)
    df = spark.range(4000).select("id")
    out = sharding.assign(sharding.assign(df, "id", tree, "a"), "id", sharding.with_shard(tree, 8), "b").collect()
    moved = [r for r in out if r.a != r.b]
    assert moved and all(r.b == 8 for r in moved)
    assert abs(len(moved) - 4000 / 9) < 100
    assert all(abs(n - 500) < 100 for n in Counter(r.a for r in out).values())


def test_a_weight_moves_keys_only_into_its_own_subtrees(spark):
    def leaf(n, w=1.0):
        return sharding.Node(f"s{n}", w, n)

    def tree(w):
        racks = [sharding.Node(f"k{i}", children=(leaf(2 * i, w if i == 1 else 1.0), leaf(2 * i + 1))) for i in range(4)]
        return sharding.Node("root", children=(sharding.Node("r0", children=tuple(racks[:2])), sharding.Node("r1", children=tuple(racks[2:]))))

    df = spark.range(4000).select("id")
    out = sharding.assign(sharding.assign(df, "id", tree(1.0), "a"), "id", tree(3.0), "b").collect()
    rack, region = (lambda s: s // 2), (lambda s: s // 4)
    for r in out:
        if region(r.a) != region(r.b):
            assert region(r.b) == 0
        elif rack(r.a) != rack(r.b):
            assert rack(r.b) == 1
        elif r.a != r.b:
            assert r.b == 2
    assert sharding.assign(df, "id", sharding.Node("root", children=(leaf(0, 0.0), leaf(1)))).where("shard <> 1").isEmpty()


def test_targets_stop_at_thrice_the_source():
    found = mixing.targets({"a": 100, "b": 1, "c": 50, None: 10})
    assert found["b"] == 3.0 and found["c"] == 150.0 or sum(found.values()) == pytest.approx(161)
    assert sum(found.values()) == pytest.approx(161) and all(found[s] <= 3 * n + 1e-9 for s, n in {"a": 100, "b": 1, "c": 50, None: 10}.items())
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_mix_of_awkward_rows(run):
    docs = [doc(i, "w " * (i % 7 + 1), source=s) for i, s in enumerate(["a", "b", "c", "d"] * 30)] + AWKWARD
    rows, again = (run("op10_flow_mix", documents=docs) for _ in range(2))
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(docs)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    want = {}
    for d in docs:
        want[d[3]] = want.get(d[3], 0) + len((d[1] or "").split())
    goal = mixing.targets(want)
    for source, size in want.items():
        mine = [r for r in rows if r.source_size == size and r.target == goal[source]]
        sharing = [s for s in want if want[s] == size and goal[s] == goal[source]]
        assert abs(sum(r.taken for r in mine) - len(sharing) * goal[source]) <= 2 * len(sharing)
    assert run("op10_flow_mix") == []


def cost(given, held):
    return sum(sum(k for k in range(3) for _ in range(max(0, min(held[p], g - k * held[p])))) for p, g in given.items())


def test_flow_is_cheapest_over_overlapping_sources():
    held = {("a",): 2, ("a", "b"): 2, ("b",): 1}
    quotas = {"a": 4, "b": 3}
    given = mixing.cheapest_flow(held, quotas)

    def fits(g):
        return all(
            sum(g[p] for p in held if set(p) <= set(part)) <= sum(quotas[s] for s in part)
            for n in (1, 2)
            for part in combinations(quotas, n)
        )

    choices = [dict(zip(held, g, strict=True)) for g in product(*[range(3 * n + 1) for n in held.values()])]
    most = max(sum(g.values()) for g in choices if fits(g))
    least = min(cost(g, held) for g in choices if fits(g) and sum(g.values()) == most)
    assert sum(given.values()) == most == 7 and cost(given, held) == least


def test_mixed_documents_are_repeated_as_planned(spark, tables):
    docs = spark.read.parquet(tables(documents=[doc(i, "w x y", source="ab"[i % 2]) for i in range(20)]) + "/documents.parquet")
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert 6 <= counts["a"] <= 8 and 13 <= counts["b"] <= 15
    assert mixing.repeated(docs.where(F.lit(False))).count() == 0
