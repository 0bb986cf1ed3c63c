"""Personal data: find, resolve, number, redact, keep the way back, rehydrate, report."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions import spans as S
from veilstone.functions.frames import exploded
from veilstone.functions.patterns import BOOTSTRAP, Pattern
from veilstone.functions.spans import Finder

Patterns = Sequence[Pattern]


def _literal_lookup(values: Sequence[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def pii_spans(df: DataFrame, key: str, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """Every match of every pattern, one row each; matches may overlap."""
    found = S.with_spans(df.select(key, text), text, patterns, "spans")
    rows = exploded(found, "spans", "span", key)
    return rows.select(
        key,
        F.col("span.start").alias("start"),
        F.col("span.end").alias("end"),
        F.col("span.ord").alias("pattern_ord"),
        _literal_lookup([p.name for p in patterns], F.col("span.ord")).alias("type"),
        F.col("span.original").alias("original"),
    )


def with_kept_spans(df: DataFrame, text: str = "text", patterns: Patterns = BOOTSTRAP, out: str = "kept") -> DataFrame:
    """The table with an array of its non-overlapping, numbered spans."""
    return S.with_resolved(df, text, patterns, out, "_redacted").drop("_redacted")


def _kept_rows(df: DataFrame, keys: Sequence[str], text: str, patterns: Patterns) -> DataFrame:
    return exploded(with_kept_spans(df.select(*keys, text), text, patterns), "kept", "k", *keys)


def resolve_overlaps(df: DataFrame, key: str, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """Spans that survive overlap resolution: the earlier start wins, then the earlier pattern."""
    return _kept_rows(df, [key], text, patterns).select(key, "k.start", "k.end", "k.type", "k.original")


def number_tokens(df: DataFrame, key: str, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """Kept spans with their token; each prefix counts from one inside each text."""
    return _kept_rows(df, [key], text, patterns).select(key, "k.start", "k.prefix", "k.token")


def pii_redact(df: DataFrame, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """The table with redacted text, entries, flag and count in place of the text."""
    kept = S.with_resolved(df, text, patterns, "_kept", "_redacted")
    return kept.select(
        *[c for c in df.columns if c != text],
        F.col("_redacted").alias("redacted_text"),
        F.expr(S.entries_sql("_kept")).alias("redactions"),
        (F.size("_kept") > 0).alias("pii_detected"),
        F.size("_kept").alias("redaction_count"),
    )


def redaction_vault(df: DataFrame, key: str, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """The way back as a table. It holds raw personal data: store it apart from the redacted text."""
    return _kept_rows(df, [key], text, patterns).select(
        key, "k.token", "k.original", "k.type", F.col("k.byte_start").alias("position")
    )


def pii_rehydrate(texts: DataFrame, vault: DataFrame, key: str, text: str = "redacted_text") -> DataFrame:
    """Texts with their tokens filled from the vault. A text has no more entries than it has room for tokens."""
    entry = F.struct("position", "token", "original")
    entries = vault.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    joined = texts.join(entries, key, "left")
    filled = F.coalesce(S.rehydrated(text, "_entries"), F.col(text))
    return joined.withColumn("rehydrated_text", filled).drop("_entries")


def redaction_summary(df: DataFrame, key: str, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """Count per text and type, with no raw values; counted inside the row, so nothing is shuffled."""
    kept = with_kept_spans(df.select(key, text), text, patterns)
    rows = exploded(kept.select(key, F.expr(S.type_counts_sql("kept", patterns)).alias("counts")), "counts", "c", key)
    return rows.select(key, "c.type", "c.n")


def pii_profile(
    df: DataFrame, key: str, dims: Sequence[str], text: str = "text", patterns: Patterns = BOOTSTRAP
) -> DataFrame:
    """Spans and texts with spans per combination of `dims` and type, with every subtotal.

    Counting per text happens inside the row, so a text adds one row per type to the cube and distinct texts need
    no distinct aggregate below the type level.
    """
    kept = with_kept_spans(df.select(key, *dims, text), text, patterns)
    counted = kept.select(*dims, F.expr(S.type_counts_sql("kept", patterns)).alias("counts"))
    whole = F.struct(
        F.lit("(all)").alias("type"),
        F.aggregate("counts", F.lit(0).cast("bigint"), lambda acc, c: acc + c["n"]).alias("n"),
    )
    with_total = counted.withColumn("counts", F.when(F.size("counts") > 0, F.array_append("counts", whole)))
    rows = exploded(with_total, "counts", "c", *dims).select(*dims, "c.type", "c.n")
    levels = [[*chosen, "type"] for size in range(len(dims) + 1) for chosen in combinations(dims, size)]
    return (
        rows.groupingSets(levels, *dims, "type")
        .agg(
            F.sum("n").alias("spans"),
            F.count(F.lit(1)).alias("texts"),
            *[F.grouping(d).alias(f"_all_{d}") for d in dims],
        )
        .select(
            *[F.when(F.col(f"_all_{d}") == 1, F.lit("(all)")).otherwise(F.col(d)).alias(d) for d in dims],
            "type",
            "spans",
            "texts",
        )
    )


def pii_leak_check(df: DataFrame, text: str = "text", patterns: Patterns = BOOTSTRAP) -> DataFrame:
    """One row: texts, texts with spans, texts whose redacted form still shows an original, broken round trips."""
    kept = S.with_resolved(df.select(text), text, patterns, "kept", "redacted")
    done = kept.select(text, "redacted", F.expr(S.entries_sql("kept")).alias("entries"))
    checked = done.select(
        (F.size("entries") > 0).alias("found"),
        S.shows_any("redacted", "entries").alias("leaks"),
        (F.coalesce(S.rehydrated("redacted", "entries"), "redacted") != F.col(text)).alias("broken"),
    )
    return checked.agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if("found").alias("texts_with_pii"),
        F.count_if("leaks").alias("texts_leaking"),
        F.count_if("broken").alias("broken_roundtrips"),
    )


def register_span_function(spark: SparkSession, name: str = "pii_spans_of", patterns: Patterns = BOOTSTRAP) -> None:
    """Offer spans to SQL as a table function: `SELECT d.id, s.* FROM d, LATERAL pii_spans_of(d.text) s`."""
    detectors = [(p.regex, p.name, p.prefix, 0) for p in patterns]
    names = [p.name for p in patterns]

    @F.udtf(returnType="start INT, end INT, pattern_ord INT, type STRING, original STRING")
    class SpansOf:
        def __init__(self) -> None:
            self.finder = Finder(detectors)

        def eval(self, text: str):
            for start, order, end, _, original in self.finder.spans([text or ""], [1])[0]:
                yield start, end, order, names[order], original

    spark.udtf.register(name, SpansOf)
