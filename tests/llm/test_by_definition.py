"""Placement and training recomputed from their definitions."""

from __future__ import annotations

import math
import struct

import numpy as np
import pytest
import xxhash
from llm_rows import AWKWARD, doc

from veilstone.llm import sharding, toxicity


def hashed(key, name):
    """Spark's hash of a long and a text, one seeding the other; NULL leaves the seed as it is."""
    seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    return xxhash.xxh64_intdigest(name.encode(), seed=seed)


def descend(key, node):
    while node.children:
        live = [c for c in node.children if c.weight > 0]
        draws = [(math.log(((hashed(key, c.name) >> 11) + 0.5) / 2**53) / c.weight, i) for i, c in enumerate(live)]
        node = live[max(draws)[1]]
    return node.shard


def test_every_document_is_placed_as_the_draws_tell(run):
    rows = [doc(i * 7 - 300, "x" * (i % 5)) for i in range(400)] + AWKWARD
    tree = sharding.even_tree(2, 2, 2)
    grown = sharding.with_shard(tree, 8)
    made = run("op4_hash_tree_shards", documents=rows)
    assert len(made) == len(rows)
    for r in made:
        assert (r.shard, r.grown_shard) == (descend(r.doc_id, tree), descend(r.doc_id, grown))
    assert len({r.shard for r in made}) == 8
    for shard in range(8):
        assert sorted(r.slot for r in made if r.shard == shard) == list(range(sum(r.shard == shard for r in made)))


def test_weights_are_taken_into_account(spark):
    leaf = lambda n, w: sharding.Node(f"shard{n}", w, n)
    tree = sharding.Node("root", children=(sharding.Node("a", children=(leaf(0, 1.0), leaf(1, 5.0))), sharding.Node("b", children=(leaf(2, 0.5), leaf(3, 0.0)))))
    keys = spark.createDataFrame([(i,) for i in range(-200, 200)] + [(None,)], "k long")
    got = {r.k: r.shard for r in sharding.assign(keys, "k", tree).collect()}
    assert got == {k: descend(k, tree) for k in got} and set(got.values()) == {0, 1, 2}


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def parts(theta, positive, unlabelled, prior):
    """Risk of the positives called positive, and the part of the negatives that must not be negative."""
    margin = lambda rows: np.array([theta[-1] + sum(theta[i] for i in row) for row in rows])
    p, u = margin(positive), margin(unlabelled)
    return prior * sigmoid(-p).mean(), sigmoid(u).mean() - prior * sigmoid(p).mean()


def slopes(f, theta, h=1e-6):
    return np.array([(f(theta + h * e) - f(theta - h * e)) / (2 * h) for e in np.eye(len(theta))])


@pytest.mark.parametrize("seed,prior", [(0, 0.3), (1, 0.6), (2, 0.9)])
def test_training_follows_the_non_negative_risk(seed, prior):
    """Slopes by differences of the risk as it is published: its sum where the second part is not negative, else the second
    part the other way round; and the decay of the weights. Two of the three cases come to the second."""
    draw = np.random.default_rng(seed)
    positive = [sorted(set(draw.integers(0, 4, 3).tolist())) for _ in range(6)]
    unlabelled = [sorted(set(draw.integers(0, 4, k).tolist())) for k in draw.integers(0, 4, 9)]
    steps, rate, decay = 60, 0.05, 1e-5
    theta = np.zeros(5)
    theta[4] = np.log(prior / (1 - prior))
    first = second = np.zeros(5)
    turned = 0
    for step in range(1, steps + 1):
        if parts(theta, positive, unlabelled, prior)[1] >= 0:
            grad = slopes(lambda t: sum(parts(t, positive, unlabelled, prior)), theta)
        else:
            turned += 1
            grad = -slopes(lambda t: parts(t, positive, unlabelled, prior)[1], theta)
        grad = grad + decay * np.append(theta[:4], 0)  # the intercept does not decay
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    sparse = lambda rows: toxicity.Sparse.of([np.array(r, np.int32) for r in rows])
    weights, intercept = toxicity.fit_nnpu(sparse(positive), sparse(unlabelled), 4, prior, steps, rate, decay)
    assert np.allclose([*weights, intercept], theta, atol=1e-5)
    assert turned or prior == 0.9
