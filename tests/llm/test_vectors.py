"""Whitening and hard negatives against plain numpy."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from veilstone.llm import negatives, whitening

NAN, INF = float("nan"), float("inf")


def plain_whitening(rows):
    usable = [(i, v) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in usable])
    centred = x - x.mean(0)
    covariance = centred.T @ centred / len(x)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:32]
    deviation = [sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(0), strict=True)) for row in x]
    return [i for i, _ in usable], centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance), deviation


def some_vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dims)) * np.linspace(0.3, 2, dims)).round(4).tolist()


@pytest.mark.parametrize("dims", [3, 40])
def test_whitening_equals_numpy(run, dims):
    rows = [(i, v, 1) for i, v in enumerate(some_vectors(120, dims, dims))]
    rows += [rows[5], (None, some_vectors(1, dims, 9)[0], None), (900, None, 1), (901, [], 1), (902, [NAN] + [0.0] * (dims - 1), 1)]
    rows += [(903, [None] + [0.0] * (dims - 1), 1), (904, [INF] * dims, 1)]
    made = run("op12_block_whitening", embeddings=rows)
    ids, want, share, deviation = plain_whitening(rows)
    assert len(made) == len(ids) * min(dims, 32)
    table = {}
    for r in made:
        table.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert r.n == len(ids) and r.identity_error <= 1e-9 and abs(r.explained - share[r.component - 1]) < 1e-12
    got = np.array([[table[i, d][c + 1][0] for c in range(want.shape[1])] for i, d in zip(ids, deviation, strict=True)])
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-8


def test_whitening_of_nothing_and_of_no_variance(run):
    assert run("op12_block_whitening") == []
    assert run("op12_block_whitening", embeddings=[(1, None, 1)]) == []
    assert run("op12_block_whitening", embeddings=[(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]) == []
    flat = run("op12_block_whitening", embeddings=[(1, [1.0, 2.0], 1), (2, [2.0, 2.0], 1), (3, [1.0, 1.0, 1.0], 1)])
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in flat) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_blocks_of_several_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 1)
    rows = [(i, v) for i, v in enumerate(some_vectors(70, 8, 2))]
    made = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding").collect()
    ids, want, _, _ = plain_whitening(rows)
    got = np.array([dict((r.id, r.whitened) for r in made)[i] for i in ids])
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-8


def plain_negatives(rows):
    kept = []
    for i, v, label in rows:
        if label is not None and v and all(c is not None and math.isfinite(c) for c in v):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            kept.append((i, label, [math.floor(256 * float(np.float32(c))) for c in v]))
    made = []
    for at, (i, label, x) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(x, y, strict=True)), j, other) for n, (j, other, y) in enumerate(kept) if n != at]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score]
            made += [(i, positive, rank, s[1], score, s[0]) for rank, s in enumerate(inside[:5], 1)]
    return sorted(made, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_negatives_equal_brute_force(run, monkeypatch, seed):
    """Coarse vectors, so that scores tie; repeated rows, NULLs in every column, numbers that are none."""
    monkeypatch.setattr(negatives, "SMALLEST", 64)
    monkeypatch.setattr(negatives, "TILE", 2)
    rng = random.Random(seed)
    rows = [(i * 10, [rng.randint(-2, 3) / 4 for _ in range(6)], rng.randrange(3)) for i in range(250)]
    rows += [rows[10], rows[10], (None, rows[0][1], 0), (None, rows[1][1], 2), (50_000, None, 1), (60_000, [1.0] * 6, None)]
    rows += [(70_000, [NAN] + [1.0] * 5, 1), (80_000, [None] * 6, 1), (90_000, [INF] * 6, 1), (90_100, [], 1)]
    got = run("op13_slot_negatives", embeddings=rows)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == plain_negatives(rows)
    assert got


def test_negatives_of_nothing(run):
    assert run("op13_slot_negatives") == []
    assert run("op13_slot_negatives", embeddings=[(100, [1.0], 1), (101, [1.0], 2)]) == []


def test_negatives_with_falling_positives_only_below_zero(run):
    rows = [(100, [1.0, 0.0], 1), (101, [-1.0, 0.0], 1), (102, [-1.0, 0.5], 2), (103, [2.0, 0.0], 2)]
    assert run("op13_slot_negatives", embeddings=rows) == []


def test_large_numbers_stay_exact():
    left = np.array([[2**30, 1]]), np.array([[2**30, 3]])
    assert negatives.products(*left).tolist() == [[2**60 + 3]]
