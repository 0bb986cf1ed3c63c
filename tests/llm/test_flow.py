"""The flow of the mix: many overlapping patterns, and what a mix as a stage gives."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest
from llm_rows import AWKWARD, doc

from veilstone.llm import mixing


def flow_by_lp(patterns, quotas, repeats):
    """Largest flow by plain augmentation on an explicit residual graph, one unit at a time; cost by raising levels."""
    names = sorted(patterns)
    used = {s: [] for s in quotas}
    given = Counter()

    def find(p, seen):
        for s in p:
            if s in quotas and s not in seen:
                seen.add(s)
                if len(used[s]) < quotas[s]:
                    used[s].append(p)
                    return True
                for k, q in enumerate(used[s]):
                    if find(q, seen):
                        used[s][k] = p
                        return True
        return False

    for level in range(1, repeats + 1):
        for p in names:
            while given[p] < level * patterns[p] and find(p, set()):
                given[p] += 1
    return given


@pytest.mark.parametrize("seed", range(8))
def test_flow_is_largest_and_cheapest(seed):
    rng = random.Random(seed)
    sources = [f"s{i}" for i in range(rng.randint(1, 5))]
    patterns = {tuple(sorted(rng.sample(sources, rng.randint(1, len(sources))))): rng.randint(0, 6) for _ in range(rng.randint(1, 8))}
    quotas = {s: rng.randint(0, 12) for s in sources}
    got, want = mixing.cheapest_flow(patterns, quotas), flow_by_lp(patterns, quotas, 3)
    assert sum(got.values()) == sum(want.values())
    assert all(0 <= got[p] <= 3 * patterns[p] for p in patterns)
    cost = lambda g: sum(sum(k * min(max(g[p] - (k - 1) * n, 0), n) for k in (1, 2, 3)) for p, n in patterns.items())
    assert cost(got) == cost(want)


def test_a_hundred_thousand_overlapping_patterns():
    draw = np.random.default_rng(1)
    sources = [f"s{i:03d}" for i in range(100)]
    patterns = {}
    while len(patterns) < 100_000:
        for chosen in draw.integers(0, 100, (20_000, 4)):
            patterns[tuple(sorted({sources[c] for c in chosen}))] = int(draw.integers(1, 1_000))
    sizes = Counter()
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    wanted = mixing.targets(sizes)
    quotas = {s: round(v) for s, v in wanted.items()}
    begun = time.perf_counter()
    given = mixing.cheapest_flow(patterns, quotas)
    assert time.perf_counter() - begun < 60
    assert all(0 <= given[p] <= 3 * n for p, n in patterns.items())
    assert sum(given.values()) == min(sum(quotas.values()), 3 * sum(patterns.values()))


def test_the_stage_repeats_documents_as_often_as_the_mix_begins_them(spark, tables):
    rows = [doc(1_000 + i, "word " * (i % 7), "en", f"s{i % 3}") for i in range(200)] + AWKWARD
    docs = spark.read.parquet(tables(documents=rows) + "/documents.parquet")
    mixed = mixing.repeated(docs)
    assert mixed.columns == docs.columns
    sizes = {r[0]: len((r[1] or "").split()) for r in rows}
    plan = mixing.mix(mixing.one_source(docs.select("doc_id", "text", "source")))
    begun = Counter()
    for r in plan.taken.collect():
        begun[r.doc_id] += -(-r.taken // r["size"]) if r.taken else 0
    assert Counter(r.doc_id for r in mixed.collect()) == +begun
    assert all(sizes[i] > 0 for i in begun if begun[i])
    words, total = Counter(), Counter()
    by_source = {r["member"]: r["target"] for r in plan.sources.collect()}
    for r in plan.taken.collect():
        total[r.pattern[0]] += r.taken
        words[r.pattern[0]] += r["size"]
    assert all(abs(total[s] - min(by_source[s], 3 * words[s])) <= 1 for s in by_source)
    assert mixing.repeated(docs.where("false")).collect() == []
