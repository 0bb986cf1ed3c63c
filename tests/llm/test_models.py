"""Language, toxicity and quality: the parts against brute force, the whole on held-out rows."""

from __future__ import annotations

import random
import zlib
from functools import cache

import numpy as np
import pytest
from llm_rows import AWKWARD, doc

from veilstone.llm import langid, quality, toxicity


def held(i, parts, which):
    return i is not None and zlib.crc32(str(i).encode()) % parts == which


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aab", "▁", "▁a"]
    weights = np.random.default_rng(0).random((len(pieces), 2))
    words = ["▁aabab", "▁ba", "▁xab", "▁"]

    def brute(word, k, w):
        @cache
        def total(at):
            if at == len(word):
                return 1.0
            known = sum(w[i, k] * total(at + len(p)) for i, p in enumerate(pieces) if word.startswith(p, at))
            return known + (0 if word[at] in pieces else langid.UNKNOWN * total(at + 1))

        return total(0)

    lattice = langid.Lattice(pieces)
    found = langid.forward(lattice, langid.coded(words), weights).total
    assert found == pytest.approx(np.array([[brute(w, k, weights) for k in (0, 1)] for w in words]))
    uses = langid.expected(lattice, langid.coded(words), weights[:, 0], np.array([1.0, 2, 1, 1]))
    for i in range(len(pieces)):  # expected uses are the slope of the log-likelihood in the log weight
        more = weights.copy()
        more[i, 0] *= 1 + 1e-6
        slope = sum(n * (np.log(brute(w, 0, more)) - np.log(brute(w, 0, weights))) for n, w in zip((1, 2, 1, 1), words, strict=True)) / 1e-6
        assert uses[i] == pytest.approx(slope, abs=1e-3)


def test_language_of_awkward_rows(run):
    draw = random.Random(1)
    talk = {"en": "the of and water house is running through".split(), "de": "der und nicht schon wasser haus laufen durch".split()}
    docs = [doc(100 + i, " ".join(draw.choices(talk[lang], k=12)), lang) for i, lang in enumerate(["en", "de"] * 30)]
    docs += [*AWKWARD, doc(50, "123 !!"), doc(51, "x" * 5_000), doc(52, "日本語")]
    rows = run("op1_marginal_langid", documents=docs)
    assert len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    assert all(by[d[0]].lang_pred == d[2] for d in docs[:60])
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    assert {by[i].lang_pred for i in (2, 3, 6, 50)} == {"und"} and by[51].lang_pred in talk
    assert run("op1_marginal_langid") == []
    assert {r.lang_pred for r in run("op1_marginal_langid", documents=[doc(1, "text", None)])} == {"und"}


def test_language_of_the_given_table(spark, small):
    from veilstone.llm.queries import QUERIES

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op1_marginal_langid"](spark, small).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97


def test_nnpu_finds_the_positives_among_the_unlabelled():
    draw = np.random.default_rng(2)
    true = draw.random(600) < 0.2
    texts = [np.unique(np.concatenate([draw.integers(1, 40, 5), [0] if t else []])).astype(int) for t in true]
    positives = [np.unique(np.concatenate([draw.integers(1, 40, 5), [0]])).astype(int) for _ in range(80)]
    weights, intercept = toxicity.fit_nnpu(toxicity.Sparse.of(positives), toxicity.Sparse.of(texts), 40, 0.2)
    called = np.array([intercept + weights[t].sum() >= 0 for t in texts])
    assert (called == true).mean() > 0.97


def toxic_rows():
    draw = random.Random(3)
    plain = [f"w{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(300):
        bad = i % 6 == 0
        words = draw.choices(plain, k=30) + ([draw.choice(["scoundrel", "vermin"])] if bad else [])
        draw.shuffle(words)
        docs.append(doc(100 + i, " ".join(words)))
        labels.append((100 + i, 1, int(bad)))
    return docs, labels


def test_toxicity_of_awkward_rows(run):
    docs, labels = toxic_rows()
    labels += [(None, 1, 1), (1, None, None), (1, 1, 0), (9_999, 1, 1)]
    rows = run("op2_pu_toxicity", documents=docs + AWKWARD, labels=labels)
    assert len(rows) == len(docs) + len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held(r.doc_id, 5, 0) for r in rows)
    truth = {i: t for i, _, t in labels}
    out = [r for r in rows if r.held_out and r.doc_id and r.doc_id >= 100]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert run("op2_pu_toxicity") == [] and {r.predicted for r in run("op2_pu_toxicity", documents=AWKWARD)} == {0}


def test_attention_gradients():
    draw = np.random.default_rng(4)
    bags = quality.Bags.of([draw.standard_normal((n, quality.WIDTH)) for n in (1, 3, 2)])
    labels = np.array([1.0, 0, 1])
    net = quality.Network.fresh(np.zeros(quality.WIDTH), np.ones(quality.WIDTH))
    slopes = net.gradients(bags, labels)

    def loss():
        s = net.scores(bags)
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    for name, slope in slopes.items():
        at = tuple(0 for _ in net.p[name].shape)
        values = []
        for step in (1e-5, -2e-5):
            net.p[name][at] += step
            values.append(loss())
        net.p[name][at] += 1e-5
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(slope[at], abs=1e-7)


def test_quality_finds_one_bad_passage(run):
    draw = random.Random(5)
    words = "the river runs past old houses and into deep water".split()
    docs, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = draw.choices(words, k=350)
        if bad:
            at = draw.randrange(250)
            text[at : at + 100] = [w + "%%%" for w in text[at : at + 100]]
        docs.append(doc(100 + i, " ".join(text)))
        labels.append((100 + i, int(not bad), 0))
    labels += [(None, 1, 0), (1, None, 0), (2, 1, 0)]
    rows = run("op6_attention_quality", documents=docs + AWKWARD, labels=labels)
    assert len(rows) == len(docs) + len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == held(r.doc_id, 4, 2) for r in rows)
    truth = {i: q for i, q, _ in labels}
    out = [r for r in rows if r.held_out and r.doc_id and r.doc_id >= 100]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in out]) > 0.9
    assert run("op6_attention_quality") == [] and {r.score for r in run("op6_attention_quality", documents=AWKWARD)} == {0.5}


def test_passages_cover_the_whole_text():
    encoder = quality.Encoder()
    bags = encoder.bags(["a " * 250, None, "", "x" * 100_000])
    assert [len(b) for b in bags] == [3, 1, 1, 1] and bags[0][2][7] == pytest.approx(0.5)
