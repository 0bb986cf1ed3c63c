"""Rule tables: literals that matches cannot do without, and the screen against one that tries every rule."""

from __future__ import annotations

import random
import re
import time

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from veilstone.functions.regex import compiled, python_regex
from veilstone.functions.rules import RuleSet, folded, required_literals
from veilstone.operators import requests as ops


@pytest.mark.parametrize(
    "pattern,want",
    [
        (r"(?i)ignore previous", {"ignore previous"}),
        (r"SSN|-", {"ssn", "-"}),
        (r"\.\.|/etc/passwd", {"..", "/etc/passwd"}),
        (r"\bDROP\s+TABLE\b", {"table"}),
        (r"a(?:bc|bd)e?f+", {"bc", "bd"}),
        (r"(?:Street|St)\b", {"street", "st"}),
        (r"x?y*", None),
        (r"\d{3}|abc", None),
        (r"(abc)?def", {"def"}),
        (r"[ab]c", {"c"}),
        (r"a.b", {"a"}),
        (r"(?:(?:aa|b)c|dddd)+z", {"z"}),
    ],
)
def test_required_literals(pattern, want):
    found = required_literals(pattern)
    assert found == (None if want is None else frozenset(want))


def test_no_match_without_a_required_literal():
    rng = random.Random(1)
    parts = ["a", "b", "K", "s", r"\.", "[ab]", r"\d", "(?:ab|c)", "(?:a|bb)?", "x+", "y*", "z{2}", r"\b", "-", "(?:d(?:e|f)|g)", "ſ"]
    texts = ["".join(rng.choice(["a", "b", "k", "K", "S", "s", ".", "1", "c", "x", "y", "zz", "-", "de", "g", "ſ", " ", "K"]) for _ in range(12)) for _ in range(400)]
    tried = 0
    for _ in range(300):
        pattern = rng.choice(["", "(?i)"]) + "".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "|ab", "|1x"])
        literals = required_literals(pattern)
        hits = pc.match_substring_regex(pa.array(texts), pattern=pattern).to_pylist()
        for text, hit in zip(texts, hits, strict=True):
            if hit and literals is not None:
                tried += 1
                assert any(x in folded(text) for x in literals), (pattern, text, literals)
    assert tried > 1_000


def some_rules(n, rng):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6))) for _ in range(3_000)]
    shapes = [lambda: rng.choice(words), lambda: rng.choice(words) + r"\s+" + rng.choice(words), lambda: "(?i)" + rng.choice(words).upper(),
              lambda: rng.choice(words) + "|" + rng.choice(words), lambda: r"\d{4}-" + str(rng.randrange(30))]
    rules = [(i, rng.choice(["prompt", "sql"]), rng.choice(shapes)(), f"t{i}", rng.choice(["warn", "block", "allow", "odd"]), None, f"r{i}") for i in range(n)]
    return words, rules


@pytest.mark.parametrize("strictest", [False, True])
def test_five_thousand_rules_equal_the_naive_screen(spark, strictest):
    rng = random.Random(2)
    words, rules = some_rules(5_000, rng)
    texts = [" ".join(rng.choice([rng.choice(words), rng.choice(words).upper(), "1234-7", "zzzz"]) for _ in range(rng.randint(0, 12))) for _ in range(120)]
    rows = [(i, rng.choice(["prompt", "sql", "none", None]), t) for i, t in enumerate(texts)] + [(900, "sql", None), (901, "sql", ""), (902, None, "x")]
    table = spark.createDataFrame(rows, "id int, channel string, content string")
    listed = spark.createDataFrame(rules, ops.RULE_COLUMNS)
    screened = ops.rule_screen_table(table, listed, strictest=strictest)
    assert "Join" not in screened._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: r["raw"] for r in screened.collect()}
    engines = [compiled(python_regex(r[2])) for r in rules]
    clear = 0
    for i, channel, text in rows:
        hits = [k for k, r in enumerate(rules) if r[1] == channel and text is not None and engines[k].search(text)]
        best = min(hits, key=lambda k: (-ops.ACTION_RANK.get(rules[k][4], 0) if strictest else 0, k), default=None)
        clear += best is None
        assert (f'"reason":"r{best}"' in got[i]) if best is not None else got[i] == '{"safe":true,"action":"allow"}'
    assert 10 < clear < 100


def test_table_and_literal_rules_give_the_same_verdicts(spark):
    rules = [(i, r.channel, r.regex, r.threat_type, r.action, r.confidence, r.reason) for i, r in enumerate(ops.DEFAULT_RULES)]
    rows = [(0, "prompt", "IGNORE previous text"), (1, "prompt", "my SSN"), (2, "sql", "DROP TABLE x"), (3, "file_path", "../x"), (4, "sql", "select 1")]
    table = spark.createDataFrame(rows, "id int, channel string, content string")
    one = {r["id"]: r["raw"] for r in ops.rule_screen(table).collect()}
    assert {r["id"]: r["raw"] for r in ops.rule_screen_table(table, spark.createDataFrame(rules, ops.RULE_COLUMNS)).collect()} == one
    none = ops.rule_screen_table(table, spark.createDataFrame([], ops.RULE_COLUMNS)).collect()
    assert {r["raw"] for r in none} == {'{"safe":true,"action":"allow"}'}
    with pytest.raises(ValueError):
        ops.rule_screen_table(table, spark.createDataFrame([(0, "sql", "(", "t", "warn", None, None)], ops.RULE_COLUMNS))


def test_cost_follows_the_text_not_the_rules():
    rng = random.Random(4)
    words, rules = some_rules(20_000, rng)
    few, many = RuleSet([(r[1], r[2]) for r in rules[:200]]), RuleSet([(r[1], r[2]) for r in rules])
    texts = ["no such words here, only these ones " * 50] * 200

    def seconds(found):
        begun = time.perf_counter()
        assert found.matches(["sql"] * 200, texts) == [[]] * 200
        return time.perf_counter() - begun

    seconds(few)
    assert seconds(many) < 20 * max(seconds(few), 0.01)
    assert re.search("no such", texts[0])
