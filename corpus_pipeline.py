"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input.

All but the last keep the columns of documents. Language ID drops texts whose language cannot be told, the n-gram join
keeps one row of each near-duplicate component, decontamination drops rows that contain a benchmark item, mixing repeats
or drops documents to meet the source targets, and sharding places what is left.

Defined results: rows are told apart by id and text, never by id alone, so NULL and repeated ids do no harm. NULL or empty texts
and texts without a letter go at the first stage; should a later stage meet them, they are no copies of anything, leak
nothing, and the mix takes nothing of them. Of repeated rows one stays. Ties go to the smaller id, a NULL id last, then to
the smaller text hash. NULL in `source` is a source, NULL in `lang` is not learned from. Texts of any length are read
whole. Columns beyond those of documents, whatever their names, are carried to the last stage; empty tables give an empty result.
Tables written between the stages lie in `spark.checkpoint.dir`; each goes once the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm import decontamination, langid, mixing, sharding, trie_join
from veilstone.llm.common import read_table, removed, scratch, work_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    return langid.identified(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows in each component of linked texts, one: with the smallest id, or without one where none has an id."""
    return trie_join.survivors(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix begins them."""
    return mixing.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row that is left."""
    tree = sharding.even_tree(2, 2, 2)
    return sharding.shard_documents(docs, tree, sharding.with_shard(tree, 8))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: Trained models and 64-bit hashes are not SQL that DuckDB has; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES[:-1]:
        path = work_path(spark, "stage")
        with scratch(spark):  # what a stage stores on its way is of no use to the next one
            kept = stage(spark, docs, sf_dir).select(*[F.col(c) for c in docs.columns])
            kept.write.parquet(path)
            schema = kept.schema
        if before:
            removed(spark, before)
        docs, before = spark.read.schema(schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
