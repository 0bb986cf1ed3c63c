"""DuckDB SQL with the same results as the registered queries, for the correctness check."""

from __future__ import annotations

from collections.abc import Sequence

from veilstone.functions.patterns import BOOTSTRAP, Pattern


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def spans_cte(source: str, key: str, text: str, patterns: Sequence[Pattern] = BOOTSTRAP, name: str = "spans") -> str:
    """Every match with its place: matches and the gaps between them, added up."""
    parts = [
        f"SELECT {key}, {order} AS ord, {quoted(p.name)} AS type, {quoted(p.prefix)} AS prefix, "
        f"regexp_extract_all({text}, {quoted(p.regex)}) AS hits, "
        f"regexp_split_to_array({text}, {quoted(p.regex)}) AS gaps "
        f"FROM {source} WHERE regexp_matches({text}, {quoted(p.regex)})"
        for order, p in enumerate(patterns)
    ]
    return f"""{name}_found AS ({' UNION ALL '.join(parts)}),
{name}_listed AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM {name}_found),
{name}_placed AS (
  SELECT {key}, ord, type, prefix, hits[i] AS original,
         coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
         + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) AS start,
         coalesce(list_sum(list_transform(gaps[1:i], lambda g: strlen(g))), 0)
         + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: strlen(h))), 0) AS byte_start
  FROM {name}_listed),
{name} AS (
  SELECT {key}, CAST(start AS INTEGER) AS start, CAST(start + length(original) AS INTEGER) AS "end",
         CAST(byte_start AS INTEGER) AS byte_start, CAST(ord AS INTEGER) AS ord, type, prefix, original
  FROM {name}_placed)"""


def kept_cte(source: str, key: str, text: str, patterns: Sequence[Pattern] = BOOTSTRAP) -> str:
    """Greedy choice of spans, one per step and text, then numbered. Needs WITH RECURSIVE."""
    return f"""{spans_cte(source, key, text, patterns)},
picked AS (
  SELECT {key}, arg_min(s, (start, ord)) AS s FROM (SELECT {key}, start, ord, s FROM spans AS s) GROUP BY {key}
  UNION ALL
  SELECT n.{key}, arg_min(n.s, (n.start, n.ord))
  FROM picked p JOIN (SELECT {key}, start, ord, s FROM spans AS s) n
    ON n.{key} = p.{key} AND n.start >= p.s."end"
  GROUP BY n.{key}),
kept AS (
  SELECT {key}, s.start AS start, s."end" AS "end", s.byte_start AS byte_start, s.type AS type, s.prefix AS prefix,
         s.original AS original,
         '[' || s.prefix || '_' || row_number() OVER (PARTITION BY {key}, s.prefix ORDER BY s.start) || ']' AS token
  FROM picked)"""


def redacted_cte(source: str, key: str, text: str, patterns: Sequence[Pattern] = BOOTSTRAP) -> str:
    """`kept` plus `redacted`: the gaps and tokens of each text, joined in order."""
    return f"""{kept_cte(source, key, text, patterns)},
pieces AS (
  SELECT k.{key}, k.start, k."end", k.token,
         substring(d.{text}, CAST(coalesce(lag(k."end") OVER w, 0) + 1 AS BIGINT),
                   CAST(k.start - coalesce(lag(k."end") OVER w, 0) AS BIGINT)) || k.token AS piece
  FROM kept k JOIN {source} d USING ({key}) WINDOW w AS (PARTITION BY k.{key} ORDER BY k.start)),
joined AS (
  SELECT {key}, string_agg(piece, '' ORDER BY start) AS head, max("end") AS upto, count(*) AS n
  FROM pieces GROUP BY {key}),
redacted AS (
  SELECT d.*, coalesce(j.head || substring(d.{text}, CAST(j.upto + 1 AS BIGINT)), d.{text}) AS redacted_text,
         coalesce(j.n, 0) AS n_kept
  FROM {source} d LEFT JOIN joined j USING ({key}))"""
