"""Cases found in reviews: ids beside NULLs, words longer than a stretch, columns with the names that stages use."""

from __future__ import annotations

import os
import time

import numpy as np
import pytest
from llm_rows import doc

import corpus_pipeline
from veilstone.llm import common, langid, pii, trie_join


def test_ids_beside_a_null_are_exact(run):
    draw = np.random.default_rng(3)
    big = 2**53
    rows = [(big + i, draw.standard_normal(8).tolist(), 0) for i in range(60)] + [(None, draw.standard_normal(8).tolist(), 0)]
    rows.append((None, rows[0][1], 0))
    found = run("op8_one_bit_neighbours", embeddings=rows)
    ids = {r[0] for r in rows}
    assert found and all(r.vec_id in ids for r in found)
    for r in found:
        points = [np.array(v, np.float32).astype(float) for i, v, _ in rows if i == r.vec_id]
        query = next(np.array(v, np.float32).astype(float) for i, v, _ in rows if i == r.query_id)
        assert any(abs(p @ query - r.score) < 1e-9 for p in points)
    assert None in {r.vec_id for r in found}


@pytest.mark.parametrize("letters", [5, 31, 32, 33, 64, 70, 200, 1_000])
def test_words_of_any_length_sum_all_segmentations(letters):
    draw = np.random.default_rng(letters)
    word = "".join(draw.choice(list("abcé"), letters))
    pieces = sorted({"a", "b", "c"} | {word[i : i + n] for i in range(0, letters, 3) for n in (2, 5, 16, 40) if i + n <= letters})
    weights = draw.random((len(pieces), 2)) * 0.1
    at = {p: i for i, p in enumerate(pieces)}
    want = []
    for k in range(2):
        logs = [0.0]
        for end in range(1, letters + 1):
            terms = [logs[end - 1] + np.log(langid.UNKNOWN)] if word[end - 1] not in at else []
            terms += [logs[end - n] + np.log(weights[at[word[end - n : end]], k]) for n in range(1, min(end, 40) + 1) if word[end - n : end] in at]
            logs.append(np.logaddexp.reduce(terms))
        want.append(logs[-1])
    got = langid.log_forward(langid.Lattice(pieces), [word, "a", word], weights)
    assert np.allclose(got[0], want, rtol=1e-9) and np.allclose(got[2], want, rtol=1e-9)


def test_the_whole_vocabulary_counts():
    assert max(map(len, langid.pieces())) >= 16


def test_identified_keeps_columns_of_any_name(spark):
    rows = [(i, t, lang, "s", 1, "x", "y", i) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(100, "12 34", "en", "s", 1, "x", "y", 1), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, n int")
    kept = langid.identified(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.score, r.lang_pred, r.n) for r in kept.collect()} <= {(r[0], "x", "y", r[7]) for r in rows[:40]}
    assert langid.identified(docs.where("false")).collect() == []


def test_sharding_of_no_documents(run):
    assert run("op4_hash_tree_shards") == []
    assert len(run("op4_hash_tree_shards", documents=[doc(None, None), doc(1, "a"), doc(1, "a")])) == 3


def test_one_row_of_each_component_stays_with_or_without_ids(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (None, text, "b"), (None, text, "a"), (None, text.upper(), "c"),  # no id at all
        (7, "alpha beta gamma delta epsilon zeta", "x"), (None, "alpha beta gamma delta epsilon zeta", "y"), (5, "alpha beta gamma delta epsilon ZETA", "z"),
        (9, "same words but another id here", "p"), (9, "same words but another id here", "o"), (9, "a text of its own under that id", "q"),
        (None, None, "n"), (None, None, "n"), (None, "", "n"), (3, " ", "n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = trie_join.survivors(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    lone = [r for r in got if r[0] is None and (r[1] or "").lower() == text]
    assert len(lone) == 1 and (lone[0][1] != text or lone[0][2] == "a")
    assert sorted((r for r in got if r not in lone), key=repr) == sorted(
        [(5, "alpha beta gamma delta epsilon ZETA", "z"), (9, "same words but another id here", "o"), (9, "a text of its own under that id", "q"), *rows[9:]], key=repr
    )
    assert trie_join.survivors(docs.where("false")).collect() == []


def test_the_pipeline_on_empty_tables_and_clashing_columns(spark, tables):
    assert corpus_pipeline.run(spark, tables()).collect() == []
    words = "the of and water house is running through with people from city many years after river".split()
    draw = np.random.default_rng(1)
    texts = [" ".join(draw.choice(words, 40)) for _ in range(30)]
    made = corpus_pipeline.run(spark, tables(documents=[doc(i, t, "en", f"s{i % 2}") for i, t in enumerate(texts)], benchmark=[(1, texts[3])]))
    placed = {r.doc_id for r in made.collect()}
    assert placed <= set(range(30)) - {3} and len(placed) >= 20


def test_scratch_tables_go_and_others_stay(spark, tmp_path):
    rows = spark.range(3)
    with common.scratch(spark):
        inside = common.stored(rows, "inside")
        path = inside.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    outside = common.stored(rows, "outside")
    assert outside.count() == 3


def test_a_text_of_many_numbers_takes_time_in_proportion(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, " ".join(str(100_000 + i) for i in range(n)) + " a@b.cc")], "doc_id long, text string")
        begun = time.perf_counter()
        assert pii.extract(docs)[1].where("base").count() >= 1
        return time.perf_counter() - begun

    seconds(100)
    assert seconds(40_000) < 4 * max(seconds(10_000), 3)
