"""Joins and searches against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_rows import AWKWARD, doc
from pyspark.sql import functions as F

from veilstone.llm import ann, decontamination, pii, trie_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(docs):
    sets = [shingles(d[1]) for d in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i, d in enumerate(docs):
        groups.setdefault(find(i), []).append(d[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return Counter((d[0], len(sets[i]), least[find(i)]) for i, d in enumerate(docs))


def near_copies(seed=6):
    """Families of copies with a few words changed, a chain whose ends do not link, and a passage that all share."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = draw.choices(words, k=60)
    docs = []
    for family in range(12):
        base = draw.choices(words, k=draw.choice([3, 4, 5, 9, 60, 150]))
        for _ in range(draw.choice([1, 2, 5, 20])):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                text[draw.randrange(len(text))] = draw.choice(words)
            if family % 3 == 0:
                text += common
            docs.append(doc(1000 + len(docs), " ".join(text).upper() if draw.random() < 0.3 else "\n".join(text)))
    chain = draw.choices(words, k=200)
    for step in range(8):
        docs.append(doc(2000 - step, " ".join(chain[step * 9 :] + [f"c{i}" for i in range(step * 9)])))
    draw.shuffle(docs)
    return docs


def test_components_by_brute_force(run):
    docs = near_copies() + AWKWARD + [doc(7, "é É A"), doc(8, "É é a"), doc(9, "É É a"), doc(None, "A B"), doc(2**60 + 1, "a\x1cb c d e f")]
    rows = run("op9_trie_components", documents=docs)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == components(docs)
    assert run("op9_trie_components") == []


@pytest.mark.parametrize("setting", ["BROADCAST_IDS", "TRIE_SETS"])
def test_components_do_not_depend_on_how_the_work_is_dealt(spark, tables, monkeypatch, setting):
    monkeypatch.setattr(trie_join, setting, 1)
    docs = near_copies(7)
    found = trie_join.near_duplicates(spark.read.parquet(tables(documents=docs) + "/documents.parquet")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == components(docs)


def test_trie_finds_all_links():
    draw = np.random.default_rng(8)
    base = np.unique(draw.integers(0, 2**62, 60)).astype(np.uint64)
    sets = [np.unique(np.concatenate([draw.choice(base, 55, False), draw.integers(0, 2**62, k).astype(np.uint64)])) for k in range(30)]
    sets += [sets[0], base[:1], base]
    links = {i for i, s in enumerate(sets) if 100 * (n := len(np.intersect1d(s, base))) >= 80 * (len(s) + len(base) - n)}
    assert set(trie_join.linked(base, trie_join.build(sets))) == links and 1 < len(links) < len(sets)


def test_crossing_pairs_by_brute_force():
    draw = np.random.default_rng(15)
    sizes = [1, 2, 2, 5, 90, 3, 150]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    comp = np.concatenate([np.where(draw.random(n) < 0.7, k, draw.integers(100, 104, n)) for k, n in enumerate(sizes)])
    found = [tuple(sorted(p)) for a, b in trie_join.crossing(bounds, comp) for p in zip(a.tolist(), b.tolist(), strict=True)]
    want = {(i, j) for s, e in zip(bounds[:-1], bounds[1:], strict=True) for i in range(s, e) for j in range(i + 1, e) if comp[i] != comp[j]}
    assert len(found) == len(set(found)) and set(found) == want


def test_a_family_needs_no_pairs_beside_its_head(spark, tables):
    """Copies that link with the text they were made from, and not with one another, make few candidates."""
    draw = random.Random(16)
    base = [f"w{i}" for i in range(120)]
    family = [doc(0, " ".join(base))]
    for i in range(1, 120):
        text = list(base)
        for at in draw.sample(range(5, 115, 6), 2):
            text[at] = f"x{i}-{at}"
        family.append(doc(i, " ".join(text)))
    docs = spark.read.parquet(tables(documents=family) + "/documents.parquet")
    found = trie_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == components(family)
    assert {r.component_id for r in found} == {0}


def test_deduplicated_keeps_one_of_each(spark, tables):
    docs = near_copies(9)
    table = spark.read.parquet(tables(documents=docs + [doc(None, "x y"), doc(None, "x y")]) + "/documents.parquet")
    kept = trie_join.deduplicated(table)
    assert kept.columns == table.columns
    want = {c for _, _, c in components(docs)}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_containment_by_brute_force(run, monkeypatch):
    draw = random.Random(10)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([5, 6, 15, 40, 100])))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "two words"), (53, items[0][1]), (None, items[1][1])]
    docs = [*AWKWARD, doc(7, "Two Words"), doc(None, items[1][1])]
    for i in range(150):
        text = draw.choices(words, k=draw.choice([10, 200, 3000]))
        if i % 2:
            put = (items[i % 30][1]).split()
            for _ in range(draw.choice([0, 1, 2, 8])):
                put[draw.randrange(len(put))] = "other"
            text[5:5] = put
        docs.append(doc(100 + i, " ".join(text)))
    docs.append(docs[-1])
    want = set()
    for d in docs:
        for i, item in items:
            q = shingles(item)
            if q and 100 * len(q & shingles(d[1])) >= 80 * len(q):
                want.add((d[0], i, len(q), len(q & shingles(d[1]))))
    for most in (decontamination.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", most)
        rows = run("op7_minhash_containment", documents=docs, benchmark=items)
        assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in rows} == want and len(rows) == len(want)
    assert run("op7_minhash_containment") == [] == run("op7_minhash_containment", documents=docs)


def vectors(seed=11, n=900, dims=24):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, dims))
    points = centres[draw.integers(0, 6, n)] + draw.standard_normal((n, dims))
    return [(i, [float(x) for x in p.astype(np.float32)], 0) for i, p in enumerate(points)]


def test_neighbours_by_brute_force(run, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 150)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    rows = vectors()
    rows += [(1000 + i, rows[40][1], 0) for i in range(60)]  # ties
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [nan] + [1.0] * 23, [inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0]]
    rows += [(2000 + 20 * i, v, 0) for i, v in enumerate(odd)]
    found = run("op8_one_bit_neighbours", embeddings=rows)
    real = rows[:960]
    ids, points = np.array([r[0] for r in real]), np.array([r[1] for r in real])
    hits, by = 0, {}
    for r in found:
        by.setdefault(r.query_id, []).append(r)
    queries = [r for r in real if r[0] % 20 == 0]
    assert set(by) == {q[0] for q in queries}
    for q in queries:
        scores = (points * np.array(q[1])).sum(1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q[0]][:20]
        mine = sorted(by[q[0]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21)) and q[0] not in {r.vec_id for r in mine}
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(r.score == pytest.approx(scores[np.flatnonzero(ids == r.vec_id)[0]], abs=1e-12) for r in mine)
        hits += len({r.vec_id for r in mine} & set(ids[order]))
    assert hits / (20 * len(queries)) >= 0.98


def test_few_and_no_vectors(run):
    assert run("op8_one_bit_neighbours") == []
    found = run("op8_one_bit_neighbours", embeddings=[(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (20, [0.0, -1.0], 0)])
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(found)] == [(0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1)]


def test_error_bound_holds():
    points = np.array([v for _, v, _ in vectors(12)])
    centre, turn = points.mean(0), ann.rotation(24)
    near, off = ann.estimate(ann.encode(points, centre, turn), points[:50], centre, turn, 3.0)
    assert (np.abs(near - points[:50] @ points.T) <= off + 1e-4).mean() > 0.995


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    digits = [int(c) for c in re.sub("[^0-9]", "", m)]
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def base_of(text):
    found = [(m.start(), list(RULES).index(k), f"{k}:{m.start()}:{m.end()}") for k in RULES for m in re.finditer(RULES[k], text or "") if passes(k, m[0])]
    return [x[2] for x in sorted(found)]


def test_base_spans_by_brute_force(run):
    draw = random.Random(13)
    parts = ["a@b.c", "x.y%z@q-r.st.uv", "%d@e.f", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000255.0.0.0", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-0199", "+1..", "++12345678 9", "é", " ", "@", ".", "ß@x.y", "12", "\n", "😀"]
    docs = [doc(1000 + i, "".join(draw.choices(parts, k=draw.choice([1, 3, 12])))) for i in range(300)]
    docs += [*AWKWARD, doc(900, "a" * 200_000), doc(901, "1" * 100_000), doc(902, "a@b.c " * 5_000), doc(903, "a@b" + ".c" * 20_000), doc(904, "+1" + " " * 50_000)]
    rows = run("op5_bootstrapped_pii", documents=docs)
    assert len(rows) == len(docs)
    texts = {d[0]: d[1] for d in docs}
    for r in rows:
        want = base_of(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k + ":") for w in want) for k in RULES]
        assert set(want) <= set(r.spans.split(",")) | {""}
    assert run("op5_bootstrapped_pii") == []


def test_contexts_of_seeds_find_unseen_identifiers(spark, tables):
    docs = [doc(i, f"some text, phone: +1 (555) 010-0{i:03d} and more") for i in range(20)]
    docs += [doc(100, "some text, phone: 555-0199 and more"), doc(101, "released as version 2024.1 of the"), doc(102, "phone: later")]
    rows, spans = pii.extract(spark.read.parquet(tables(documents=docs) + "/documents.parquet"))
    added = spans.where("NOT base").join(rows, "row").collect()
    assert [(r.doc_id, r.kind, r.start, r.stop) for r in added] == [(100, "phone", 18, 26)]


def test_learned_identifiers_back_further_contexts(spark, tables):
    """Numbers learned after 'phone:' also stand after 'hotline', which no seed follows."""
    docs = [doc(i, f"some text, phone: +1 (555) 010-0{i:03d} and more") for i in range(200)]
    docs += [doc(1000 + 10 * i + k, f"some text, phone: 555-01{i:02d} and more") for i in range(6) for k in range(9)]
    docs += [doc(2000 + i, f"call hotline 555-01{i:02d} today") for i in range(6)] + [doc(3000, "call hotline 555-7777 today")]
    rows, spans = pii.extract(spark.read.parquet(tables(documents=docs) + "/documents.parquet"))
    added = {r.doc_id: r.kind for r in spans.where("NOT base").join(rows, "row").collect()}
    assert added == {d[0]: "phone" for d in docs if d[0] >= 1000}


def test_native_operators_run_no_python(spark, tables):
    docs = spark.read.parquet(tables(documents=near_copies(14)) + "/documents.parquet")
    items = docs.limit(5).select(F.col("doc_id").alias("item_id"), "text")
    for frame in (decontamination.contained(docs, items), pii.extract(docs)[1]):
        assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())
