"""Hierarchical weighted hash tree: documents descend region, rack and shard by weighted hash draws.

At every node a key draws once per child, ln(u) / weight with u in (0, 1) hashed from key and child name, and goes to
the child with the largest draw. A child's draw depends on its own name and weight alone, so a change of weights moves
keys only towards children that grew or away from those that shrank; subtrees elsewhere keep theirs. A new shard in a
region of its own takes keys only into itself.

Defined results: a NULL id is a key like any other; NULL text has size 1; equal ids go together; an empty table gives an
empty table; only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm.common import numbered, read_table, stored


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. A shard has an index and a weight; what is above weighs as much as its shards."""

    name: str
    own_weight: float = 1.0
    shard: int | None = None
    children: Sequence[Node] = field(default_factory=tuple)

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def even_tree(regions: int, racks: int, shards: int) -> Node:
    """Regions of racks of shards, all of weight 1, numbered from 0."""
    number = iter(range(regions * racks * shards))
    return Node(
        "root",
        children=tuple(
            Node(
                f"region{r}",
                children=tuple(
                    Node(f"region{r}/rack{k}", children=tuple(Node(f"shard{n}", shard=n) for n in _take(number, shards)))
                    for k in range(racks)
                ),
            )
            for r in range(regions)
        ),
    )


def _take(numbers, n: int) -> list[int]:
    return [next(numbers) for _ in range(n)]


def with_shard(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own: only keys for the new shard move."""
    leaf = Node(f"shard{shard}", weight, shard)
    region = Node(f"region+{shard}", children=(Node(f"region+{shard}/rack0", children=(leaf,)),))
    return Node(tree.name, tree.own_weight, tree.shard, (*tree.children, region))


def draw(key: Column, node: Node) -> Column:
    """ln(u) / weight, with u from 53 bits of a 64-bit hash."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.ln(u) / F.lit(float(node.weight))


def place(key: Column, tree: Node) -> Column:
    """Index of the shard the key descends to. Children of weight 0 take nothing."""
    if not tree.children:
        return F.lit(tree.shard)
    live = [c for c in tree.children if c.weight > 0]
    if not live:
        raise ValueError(f"{tree.name} has no child of positive weight")
    if len(live) == 1:
        return place(key, live[0])
    best = F.array_max(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    # each branch is computed only for keys that took it
    chosen = F.when(best == 0, place(key, live[0]))
    for i, child in enumerate(live[1:], 1):
        chosen = chosen.when(best == i, place(key, child))
    return chosen


def assign(df: DataFrame, key: str, tree: Node, name: str = "shard") -> DataFrame:
    """Adds the shard of each row: one pass, no shuffle."""
    return df.withColumn(name, place(F.col(key), tree).cast("int"))


def shard_documents(docs: DataFrame, tree: Node, grown: Node) -> DataFrame:
    """Shard, slot in it and shard after growth for every document."""
    read = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign(assign(read, "doc_id", tree), "doc_id", grown, "grown_shard")
    return numbered(stored(placed, "shards"), "shard", ["doc_id", "size", "text_crc32"], "slot")


def op4_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents into shards 0 to 7 of two regions with two racks each; `grown_shard` with a ninth shard."""
    tree = even_tree(2, 2, 2)
    out = shard_documents(read_table(spark, folder, "documents"), tree, with_shard(tree, 8))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
