"""Every registered query agrees with its DuckDB SQL on the smallest data."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_agrees(spark, con, small, name):
    report = compare(spark, con, name, small)
    assert report.startswith("ok"), report


def test_every_query_has_sql():
    assert set(entry.queries()) == set(entry.oracle_sql())


def test_entry_finds_the_known_spans(spark):
    rows = entry.entry(spark).where("lang = '(all)' AND source = '(all)'").collect()
    found = {r["type"]: (r["spans"], r["texts"]) for r in rows}
    assert found["(all)"] == (22, 13)
    assert {k: v[0] for k, v in found.items() if k != "(all)"} == {
        "email": 5, "ip_address": 6, "address": 1, "phone": 6, "credit_card": 4,
    }
