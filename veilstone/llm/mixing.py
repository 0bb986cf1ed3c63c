"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern; a flow routes the words of each
pattern to the quotas of its sources, where every further repetition of a pattern costs more than the one before. As the
costs depend on the repetition alone, the cheapest flow is found by raising all capacities one repetition at a time
and augmenting from the flow so far. Whole repetitions are then taken by all documents of a pattern, the rest by those
that come first in a seeded hash order; the document at the edge gives only the words that are left.

Only the pattern table goes through the driver: as many rows as there are distinct memberships, at most `MAX_PATTERNS`,
else the operator refuses: it bounds what the driver holds. Searches of the flow go over sources, and each source is closed once
at most, so that the time is about in proportion to the patterns. Defined results: NULL or empty text has size 0 and takes 0; a NULL source is a source; ties in
the hash order fall by id; repeated rows are documents of their own, and equal ones at the edge give alike; extra columns are
not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.llm.common import WORD, read_table, stored

MAX_PATTERNS = 1_000_000
REPEATS = 3
#: NULL as a member of a pattern; no source name holds U+0000.
NO_SOURCE = "\x00"


def targets(sizes: Mapping[str | None, int], repeats: int = REPEATS) -> dict[str | None, float]:
    """Share of all words by weights 1, 2, 3, repeating over the sources in code point order, NULL last. A target stops
    at `repeats` times its source's size; the excess is shared again by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, free = float(sum(sizes.values())), list(order)
    while free:
        total = sum(weights[s] for s in free)
        above = [s for s in free if left * weights[s] / total > repeats * sizes[s]]
        if not above:
            return out | {s: left * weights[s] / total for s in free}
        for s in above:
            out[s] = float(repeats * sizes[s])
        left -= sum(out[s] for s in above)
        free = [s for s in free if s not in out]
    return out


def cheapest_flow(
    patterns: Mapping[tuple[str, ...], int], quotas: Mapping[str, int], repeats: int = REPEATS
) -> dict[tuple[str, ...], int]:
    """Words each pattern gives, at the least cost of repetition among the flows that fill the quotas most."""
    names = sorted(patterns)
    members = [[s for s in p if s in quotas] for p in names]
    carrying: dict[str, dict[int, int]] = {s: {} for s in quotas}  # words of each pattern that a source has
    given, left = [0] * len(names), dict(quotas)
    closed: set[str] = set()
    for level in range(1, repeats + 1):
        for i, p in enumerate(names):
            while room := level * patterns[p] - given[i]:
                path = _augmenting(i, members, carrying, left, closed)
                if path is None:
                    break
                amount = min(room, left[path[-1][0]], *[carrying[s][j] for (s, _), (_, j) in zip(path, path[1:], strict=False)])
                for s, j in path:
                    carrying[s][j] = carrying[s].get(j, 0) + amount
                for (s, _), (_, j) in zip(path, path[1:], strict=False):
                    carrying[s][j] -= amount
                    if carrying[s][j] == 0:
                        del carrying[s][j]
                given[i] += amount
                left[path[-1][0]] -= amount
    return dict(zip(names, given, strict=True))


def _augmenting(
    start: int, members: list[list[str]], carrying: dict[str, dict[int, int]], left: dict[str, int], closed: set[str]
) -> list[tuple[str, int]] | None:
    """Shortest way from a pattern to a source with room: sources, each with the pattern whose words move to it.

    Sources that a failed search has seen are full, and no words in them can move to a source outside: that holds for
    good, as later ways cannot lead through them. They are `closed` and not searched again, so that searches fail once for
    each source at most, however many patterns there are.
    """
    came: dict[str, tuple[str | None, int]] = {}
    queue: deque[str] = deque()
    alive = len(left) - len(closed)

    def reach(pattern: int, before: str | None) -> str | None:
        for s in members[pattern]:
            if s not in came and s not in closed:
                came[s] = (before, pattern)
                if left[s] > 0:
                    return s
                queue.append(s)
        return None

    end = reach(start, None)
    while end is None and queue:
        here = queue.popleft()
        for pattern in carrying[here]:
            end = reach(pattern, here)
            if end is not None or len(came) == alive:
                break
    if end is None:
        closed.update(came)
        return None
    path: list[tuple[str, int]] = []
    at: str | None = end
    while at is not None:
        before, pattern = came[at]
        path.append((at, pattern))
        at = before
    return path[::-1]


def ordered(docs: DataFrame, seed: int) -> DataFrame:
    """Adds the seeded order of documents: 63 bits of a hash, then the id."""
    spot = F.shiftrightunsigned(F.xxhash64("doc_id", "size", F.lit(seed)), 1)
    return docs.withColumns({"_spot": spot, "_tie": F.coalesce("doc_id", F.lit(-(1 << 63)))})


def cuts(sized: DataFrame, plan: DataFrame, seed: int, rows_per_task: int = 20_000) -> DataFrame:
    """Where in the seeded order each pattern's last repetition ends: `pattern`, `_whole` repetitions for all, the spot
    and tie of the document at the edge, and the words it gives. Ranges of the order are summed first, so that only
    the one range of a pattern that holds its edge is ordered row by row. Equal rows at the edge give alike."""
    parts = max(1, -(-sized.count() // rows_per_task))
    dealt = ordered(sized, seed).withColumn("_part", F.floor(F.col("_spot") / F.lit((1 << 63) / parts)).cast("int"))
    before = lambda order: Window.partitionBy("pattern").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumn("_whole", F.expr("CASE WHEN _held > 0 THEN _given DIV _held ELSE 0 END")).withColumn(
        "_rest", F.col("_given") - F.col("_whole") * F.col("_held")
    )
    edges = (
        dealt.groupBy("pattern", "_part")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_start", F.coalesce(F.sum("_sum").over(before(["_part"])), F.lit(0)))
        .join(F.broadcast(plan), "pattern")  # at most MAX_PATTERNS rows
        .where("_start <= _rest AND _rest < _start + _sum")
        .select("pattern", "_part", "_start", "_rest")
    )
    last = (
        dealt.join(F.broadcast(edges), ["pattern", "_part"])  # one row per pattern
        .groupBy("pattern", "_start", "_rest", "_spot", "_tie")
        .agg(F.sum("size").alias("_sum"), F.count("*").alias("_n"))
        .withColumn("_at", F.col("_start") + F.coalesce(F.sum("_sum").over(before(["_spot", "_tie"])), F.lit(0)))
        .where("_at <= _rest AND _rest < _at + _sum")
        .select("pattern", "_spot", "_tie", F.expr("(_rest - _at) DIV _n").alias("_edge"))
    )
    found = last.withColumnsRenamed({"_spot": "_cut_spot", "_tie": "_cut_tie"})
    return stored(plan.select("pattern", "_whole").join(found, "pattern", "left"), "cuts")


def take(sized: DataFrame, cut: DataFrame, seed: int) -> DataFrame:
    """Adds `taken` to documents with `doc_id`, `size` and `pattern`: each decides by itself, so nothing is shuffled."""
    joined = ordered(sized, seed).join(F.broadcast(cut), "pattern")  # at most MAX_PATTERNS rows
    more = (
        F.when(F.struct("_spot", "_tie") < F.struct("_cut_spot", "_cut_tie"), F.col("size"))
        .when((F.col("_spot") == F.col("_cut_spot")) & (F.col("_tie") == F.col("_cut_tie")), F.col("_edge"))
        .otherwise(F.lit(0))
    )
    more = F.when(F.col("_cut_spot").isNull(), F.lit(0)).otherwise(more)
    return joined.withColumn("taken", (F.col("_whole") * F.col("size") + more).cast("long")).select(*sized.columns, "taken")


def measured(docs: DataFrame, members: str) -> DataFrame:
    """Adds `size` in words and the sorted membership pattern."""
    pattern = F.array_sort(F.array_distinct(F.transform(members, lambda s: F.coalesce(s, F.lit(NO_SOURCE)))))
    return docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "pattern": F.coalesce(pattern, F.array().cast("array<string>")),
        }
    )


@dataclass(frozen=True)
class Mix:
    """`sized`: doc_id, size and pattern of every document, stored. `cut`: where each pattern ends. `sources`: member,
    source_size and target."""

    sized: DataFrame
    cut: DataFrame
    sources: DataFrame
    seed: int

    @property
    def taken(self) -> DataFrame:
        return take(self.sized, self.cut, self.seed)


def mix(docs: DataFrame, members: str = "sources", repeats: int = REPEATS, seed: int = 17) -> Mix:
    """Plans the mix of documents with doc_id, text and an array of the sources each belongs to; a document counts in
    full for each of them."""
    spark = docs.sparkSession
    sized = stored(measured(docs, members).select("doc_id", "size", "pattern"), "sized")
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("n")).take(MAX_PATTERNS + 1)
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    held = {tuple(r["pattern"]): r["n"] for r in rows}
    sizes: dict[str | None, int] = {}
    for p, n in held.items():
        for s in p:
            name = None if s == NO_SOURCE else s
            sizes[name] = sizes.get(name, 0) + n
    wanted = targets(sizes, repeats)
    quotas = {NO_SOURCE if s is None else s: round(v) for s, v in wanted.items()}
    given = cheapest_flow(held, quotas, repeats)
    plan = spark.createDataFrame(
        [(list(p), given[p], n) for p, n in held.items()], "pattern array<string>, _given long, _held long"
    )
    sources = spark.createDataFrame(
        [(NO_SOURCE if s is None else s, n, wanted[s]) for s, n in sizes.items()],
        "member string, source_size long, target double",
    )
    return Mix(sized, cuts(sized, plan, seed), sources, seed)


def one_source(docs: DataFrame) -> DataFrame:
    """Each document as a member of the one source it names."""
    return docs.withColumn("sources", F.array("source"))


def op10_flow_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of every document."""
    plan = mix(one_source(read_table(spark, folder, "documents").select("doc_id", "text", "source")))
    return (
        plan.taken.withColumn("member", F.element_at("pattern", 1))
        .join(F.broadcast(plan.sources), "member")  # at most MAX_PATTERNS rows
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def repeated(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mixed documents themselves: a row for each time a document is begun; what is not taken goes."""
    named = docs.select("doc_id", "text", F.array("source").alias("sources"), F.struct(*docs.columns).alias("_row"))
    plan = mix(named.select("doc_id", "text", "sources"), seed=seed)
    rows = take(measured(named, "sources").select("doc_id", "size", "pattern", "_row"), plan.cut, seed)
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    return rows.where("taken > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).select("_row.*")
