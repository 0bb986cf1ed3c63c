"""The corpus pipeline, stage by stage, against brute force over rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from test_pairs import LOWER, shingles

import corpus_pipeline

#: Names that the stages use inside.
CLASHES = ["_id", "_key", "_first", "_n", "_row", "_copy", "text_key", "first_key", "component_id", "cid", "sources", "size"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def row(i, text, source="s", lang="en"):
    return (i, text, lang, source, len(text or ""), *["x"] * len(CLASHES))


def linked(a, b):
    both = len(a & b)
    return both and 100 * both >= 80 * (len(a) + len(b) - both)


def parts_of(rows):
    """Components of rows with n-grams."""
    sets, left, out = [shingles(r[1]) for r in rows], {i for i, r in enumerate(rows) if shingles(r[1])}, []
    while left:
        part, work = set(), [left.pop()]
        while work:
            part.add(i := work.pop())
            near = {j for j in left if linked(sets[i], sets[j])}
            left -= near
            work += near
        out.append([rows[i] for i in part])
    return out


def leaks(text, items):
    mine = shingles(text)
    return any(q and 100 * len(q & mine) >= 80 * len(q) for q in (shingles(t) for _, t in items))


@pytest.fixture(scope="module")
def rows_and_items():
    draw = random.Random(21)
    words = "the of and water house is running through with people from city many years after river".split()
    say = lambda k=40: " ".join(draw.choices(words, k=k))
    near = lambda text: text.rsplit(" ", 1)[0] + " changed"
    texts = [say() for _ in range(24)]
    items = [(1, texts[0]), (2, say(30))]
    rows = [row(100 + i, t) for i, t in enumerate(texts)]
    rows += [row(100 + i, near(texts[i])) for i in range(3, 6)]  # one id for near copies
    rows += [row(100 + i, texts[i]) for i in (6, 6, 7)] + [row(108, texts[8], "other")]  # repeated rows
    rows += [row(200, texts[9].upper()), row(200, say()), row(201, near(texts[10]))]  # an id with a copy and a text of its own
    rows += [row(None, items[1][1])] + [row(None, say()) for _ in range(9)]  # one of those without an id leaks
    rows += [row(202, items[1][1] + " " + say(10)), row(202, say())]  # one of the texts of an id leaks
    rows += [row(300, None), row(300, None), row(301, ""), row(301, "")]
    return rows, items


def deduplicated(rows, got):
    """Whether `got` has all rows without an id or without n-grams, and of each component one with the smallest id."""
    free = [r for r in rows if r[0] is None or not shingles(r[1])]
    assert Counter(r for r in got if r[0] is None or not shingles(r[1])) == Counter(free)
    got = Counter(r for r in got if r[0] is not None and shingles(r[1]))
    assert got <= Counter(rows)
    parts = [ids for part in parts_of(rows) if (ids := [r for r in part if r[0] is not None])]
    for part in parts:
        stay = [r for r in set(part) for _ in range(got[r])]
        assert len(stay) == 1 and stay[0][0] == min(r[0] for r in part), part
    assert got.total() == len(parts)


def test_stages_by_brute_force(spark, tmp_path, rows_and_items):
    rows, items = rows_and_items
    at = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    docs, before = spark.read.parquet(f"{at}/documents.parquet"), rows
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, at)
        if k == 4:
            assert out.count() == len(before)
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        got = [tuple(r) for r in docs.collect()]
        if k == 0:
            assert Counter(got) == Counter(r for r in before if (r[1] or "").translate(LOWER).strip()), name
            got += [r for r in rows if not (r[1] or "").strip()]  # the next stages meet them all the same
            docs = spark.createDataFrame(got, SCHEMA).repartition(3)
        elif k == 1:
            deduplicated(before, got)
        elif k == 2:
            assert Counter(got) == Counter(r for r in before if not leaks(r[1], items)), name
        else:
            assert set(got) <= set(before) and max(Counter(got).values()) <= 3 * max(Counter(before).values())
        before = got


def test_the_query_runs_all_stages(spark, tmp_path, rows_and_items):
    rows, items = rows_and_items
    at = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    texts = {zlib.crc32(r[1].encode()): r[1] for r in rows if r[1]}
    placed = {texts[r["text_crc32"]] for r in corpus_pipeline.run(spark, at).select("text_crc32").collect()}
    assert placed and not any(leaks(t, items) for t in placed)
