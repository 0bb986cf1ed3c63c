"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of word n-grams. Items are partitioned by the size of their sets. An item of a partition with
up to `u` n-grams is kept as a bottom-k MinHash sketch: its k(u) smallest n-gram hashes, k(u) = u - ceil(0.8 u) + 1. A
document that holds 0.8 of the item's n-grams misses fewer than k(u) of them, so it holds one of the sketch at least:
the search loses no pair, however long the document. (Signatures of whole documents would: an item of 20 n-grams in a
document of 20,000 has a Jaccard similarity of 0.001.) A document is probed with all its n-gram hashes; its size must
reach what the partition's smallest item needs. Candidates are then verified by exact containment of n-gram texts.

Everything is DataFrame code. Sketches go to the texts while they are few, checked by count, and are joined by shuffle
beyond that.

Defined results: texts are lower-cased and split at ASCII blanks; NULL and empty texts hold nothing, and such items
are found nowhere; texts of fewer words than `n` are one n-gram; rows that share an id are documents of their own, and
the pair is given once with its largest overlap; a NULL id is given like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm.common import BLANKS, read_table, stored

N = 5
#: Contained: 100 * shared >= PERCENT * n-grams of the item.
PERCENT = 80
#: Rows of a table that is sent to all tasks; beyond that it is joined by shuffle.
BROADCAST_ROWS = 500_000


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BLANKS), "")


def grams(words: str, n: int, make) -> Column:
    """`make` of every stretch of n words, or of all words where there are fewer; nothing of no words."""
    size = F.size(words)
    starts = F.sequence(F.lit(0), size - n)
    stretch = F.transform(starts, lambda i: make([F.get(words, i + k) for k in range(n)]))
    return F.when(size >= n, stretch).when(size > 0, F.array(make([F.concat_ws(" ", words)])))


def hashed(words: str, n: int) -> Column:
    return grams(words, n, lambda parts: F.xxhash64(*parts))


def spelled(words: str, n: int) -> Column:
    return grams(words, n, lambda parts: F.concat_ws(" ", *parts))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that later filters do not compute again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def sent(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast while it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def needed(n: str | Column) -> Column:
    """Shared n-grams that containment in an item of `n` needs."""
    n = F.col(n) if isinstance(n, str) else n
    return F.ceil(n * PERCENT / 100)


def sketches(items: DataFrame, n: int = N) -> DataFrame:
    """`item_id`, `gram` and `fewest`: the bottom-k hashes of each item, k by the partition of its size, and how many
    n-grams a document must have to contain the smallest item of the partition."""
    sets = once(items.select("item_id", words_of("text").alias("words")), "held", F.array_distinct(hashed("words", n)))
    sized = sets.where(F.col("held").isNotNull()).select("item_id", "held", F.size("held").alias("n"))
    # partitions: sizes up to 1, 2, 4, 8, ...; sketches of a partition have the length its largest item asks for
    top = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int")
    k = (F.col("_top") - needed(F.col("_top")) + 1).cast("int")
    parts = sized.withColumn("_top", top).withColumn("_k", k)
    fewest = needed(F.floor(F.col("_top") / 2) + 1).cast("int").alias("fewest")
    return parts.select("item_id", fewest, F.explode(F.slice(F.array_sort("held"), 1, F.col("_k"))).alias("gram"))


def held_by(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """`doc_id`, `text_key`, `item_id`, `n_item` and `n_shared` of every item that a text contains. `docs`: doc_id and
    text; `items`: item_id and text."""
    marked = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of("text").alias("words"))
    probes = stored(sketches(items, n), "sketches")
    asked = sent(probes)
    tries = marked.select("doc_id", "text_key", (F.greatest(F.size("words") - n + 1, F.lit(1))).alias("_most"), F.explode(hashed("words", n)).alias("gram"))
    hits = tries.join(asked, "gram").where("_most >= fewest")
    candidates = stored(hits.select("doc_id", "text_key", "item_id").distinct(), "candidates")

    # the texts of candidates once more, by exact n-grams
    rows = sent(stored(candidates.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "suspects"))
    suspects = marked.join(rows, marked["doc_id"].eqNullSafe(rows["_id"]) & (marked["text_key"] == rows["_key"]), "left_semi")
    item_words = items.select("item_id", words_of("text").alias("words"))
    item_sets = item_words.select("item_id", F.array_distinct(spelled("words", n)).alias("held"))
    spelt = stored(item_sets.where("held IS NOT NULL").select("item_id", F.size("held").alias("n_item"), F.explode("held").alias("gram")), "items")
    shared = (
        suspects.dropDuplicates(["doc_id", "text_key"])
        .select("doc_id", "text_key", F.explode(F.array_distinct(spelled("words", n))).alias("gram"))
        .join(sent(spelt), "gram")
        .groupBy("doc_id", "text_key", "item_id", "n_item")
        .agg(F.count("*").cast("int").alias("n_shared"))
        .where(F.col("n_shared") * 100 >= F.col("n_item") * PERCENT)
    )
    pairs = candidates.withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "item_id": "_item"})
    same = shared["doc_id"].eqNullSafe(pairs["_id"]) & (shared["text_key"] == pairs["_key"]) & shared["item_id"].eqNullSafe(pairs["_item"])
    return shared.join(pairs, same, "left_semi")


def contained(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """`doc_id`, `item_id`, `n_item`, `n_shared` and `containment` of every item that a document contains."""
    found = held_by(docs, items, n).groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def op7_minhash_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return contained(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows whose own text contains no item; another text under the same id, or without one, decides nothing."""
    found = held_by(docs, items).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    found = stored(found.distinct(), "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_key"]), "left_anti")


ORACLE = """
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
    ), b AS (
        SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark
    ), dg AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS gram FROM d
    ), bg AS (
        SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS gram FROM b
    ), sized AS (SELECT item_id, count(*)::INT AS n_item FROM bg GROUP BY item_id)
    SELECT doc_id, item_id, n_item, count(*)::INT AS n_shared, count(*)::DOUBLE / n_item AS containment
    FROM dg JOIN bg USING (gram) JOIN sized USING (item_id)
    GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""
