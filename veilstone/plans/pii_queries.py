"""Registered queries over texts: personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions.patterns import BOOTSTRAP, Pattern, extended, without
from veilstone.operators import pii
from veilstone.operators.patterns import load_patterns
from veilstone.plans import duckdb_sql as D
from veilstone.sources.tables import read_text_table


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_text_table(spark, folder, "documents", "doc_id")


def pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_spans(_documents(spark, folder), "doc_id")


def pii_spans_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_spans(read_text_table(spark, folder, "pages", "page_id"), "page_id", "html")


def resolve_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return pii.resolve_overlaps(_documents(spark, folder), "doc_id")


def number_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return pii.number_tokens(_documents(spark, folder), "doc_id")


def pii_redact(spark: SparkSession, folder: str) -> DataFrame:
    done = pii.pii_redact(_documents(spark, folder).select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.sha2("redacted_text", 256).alias("redacted_sha"),
        F.length("redacted_text").alias("redacted_chars"),
        F.array_join(F.transform("redactions", lambda e: e["token"]), " ").alias("tokens"),
        "pii_detected",
        "redaction_count",
    )


def redaction_vault(spark: SparkSession, folder: str) -> DataFrame:
    return pii.redaction_vault(_documents(spark, folder), "doc_id")


def pii_rehydrate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    texts = pii.pii_redact(docs.select("doc_id", "text")).select("doc_id", "redacted_text")
    filled = pii.pii_rehydrate(texts, pii.redaction_vault(docs, "doc_id"), "doc_id")
    return filled.select("doc_id", F.sha2("rehydrated_text", 256).alias("text_sha"))


def redaction_summary(spark: SparkSession, folder: str) -> DataFrame:
    return pii.redaction_summary(_documents(spark, folder), "doc_id")


def pii_profile(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_profile(_documents(spark, folder), "doc_id", ["lang", "source"])


def pii_leak_check(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_leak_check(_documents(spark, folder))


# A pattern feed as the pattern service would send it: good rows, one bad expression, one row without a type.
FEED_ROWS: tuple[tuple[str, str, float, str], ...] = (
    (r"\b[a-z]{2}[0-9]{2}[a-z0-9]{10,30}\b", "pii_iban", 0.90, "IBAN"),
    (r"\b\d{3}-?\d{2}-?\d{4}\b", "pii_ssn", 0.95, "SSN"),
    (r"\b[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}\b", "pii_email", 0.92, ""),
    (r"\b(?:19|20)\d{2}\b", "pii_year_of_birth", 0.40, "YEAR"),
    (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "pii_ip_address", 0.80, "IP"),
    (r"\b\d{1,3}\.\d{1,3}\b", "pii_ip_address", 0.60, "IP"),
    (r"[invalid", "pii_broken", 0.99, "BAD"),
    (r"\bcode\b", "", 0.99, "NONE"),
)


def _feed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FEED_ROWS), "pattern string, threat_type string, confidence double, prefix string")


# What loading the feed must give: by confidence per name, highest first, ties in feed order.
LOADED = (
    Pattern("ssn", FEED_ROWS[1][0], "SSN"),
    Pattern("email", FEED_ROWS[2][0], "EMAIL"),
    Pattern("iban", FEED_ROWS[0][0], "IBAN"),
    Pattern("ip_address", FEED_ROWS[4][0], "IP"),
    Pattern("ip_address", FEED_ROWS[5][0], "IP"),
    Pattern("year_of_birth", FEED_ROWS[3][0], "YEAR"),
)


def load_patterns_(spark: SparkSession, folder: str) -> DataFrame:
    """Load the feed and count what it keeps over the documents."""
    return pii.redaction_summary(_documents(spark, folder), "doc_id", patterns=load_patterns(_feed(spark)))


# A swapped set: some detectors removed, one added behind the rest.
SWAPPED = extended(without(BOOTSTRAP, "phone", "ssn"), Pattern("short_number", r"\b\d{3}[-. ]\d{3,4}\b", "NUM"))


def with_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return pii.number_tokens(_documents(spark, folder), "doc_id", patterns=SWAPPED)


QUERIES = {
    "pii_spans": pii_spans,
    "pii_spans_pages": pii_spans_pages,
    "resolve_overlaps": resolve_overlaps,
    "number_tokens": number_tokens,
    "pii_redact": pii_redact,
    "redaction_vault": redaction_vault,
    "pii_rehydrate": pii_rehydrate,
    "redaction_summary": redaction_summary,
    "load_patterns": load_patterns_,
    "with_patterns": with_patterns,
    "pii_profile": pii_profile,
    "pii_leak_check": pii_leak_check,
}

_R = "WITH RECURSIVE "
_DOC = ("documents", "doc_id", "text")

ORACLE = {
    "pii_spans": f'WITH {D.spans_cte(*_DOC)} SELECT doc_id, start, "end", ord AS pattern_ord, type, original FROM spans',
    "pii_spans_pages": f"WITH {D.spans_cte('pages', 'page_id', 'html')} "
    'SELECT page_id, start, "end", ord AS pattern_ord, type, original FROM spans',
    "resolve_overlaps": f'{_R}{D.kept_cte(*_DOC)} SELECT doc_id, start, "end", type, original FROM kept',
    "number_tokens": f"{_R}{D.kept_cte(*_DOC)} SELECT doc_id, start, prefix, token FROM kept",
    "pii_redact": f"""{_R}{D.redacted_cte(*_DOC)},
tokens AS (SELECT doc_id, string_agg(token, ' ' ORDER BY start) AS tokens FROM kept GROUP BY doc_id)
SELECT doc_id, sha256(redacted_text) AS redacted_sha, CAST(length(redacted_text) AS INTEGER) AS redacted_chars,
       coalesce(tokens, '') AS tokens, n_kept > 0 AS pii_detected, CAST(n_kept AS INTEGER) AS redaction_count
FROM redacted LEFT JOIN tokens USING (doc_id)""",
    "redaction_vault": f"{_R}{D.kept_cte(*_DOC)} SELECT doc_id, token, original, type, byte_start AS position FROM kept",
    "pii_rehydrate": "SELECT doc_id, sha256(text) AS text_sha FROM documents",
    "redaction_summary": f"{_R}{D.kept_cte(*_DOC)} SELECT doc_id, type, count(*) AS n FROM kept GROUP BY ALL",
    "load_patterns": f"{_R}{D.kept_cte(*_DOC, LOADED)} SELECT doc_id, type, count(*) AS n FROM kept GROUP BY ALL",
    "with_patterns": f"{_R}{D.kept_cte(*_DOC, SWAPPED)} SELECT doc_id, start, prefix, token FROM kept",
    "pii_profile": f"""{_R}{D.kept_cte(*_DOC)},
per_type AS (SELECT doc_id, type, count(*) AS n FROM kept GROUP BY ALL),
both_levels AS (SELECT * FROM per_type UNION ALL SELECT doc_id, '(all)', sum(n) FROM per_type GROUP BY doc_id)
SELECT CASE WHEN grouping(lang) = 1 THEN '(all)' ELSE lang END AS lang,
       CASE WHEN grouping(source) = 1 THEN '(all)' ELSE source END AS source,
       type, CAST(sum(n) AS BIGINT) AS spans, count(*) AS texts
FROM both_levels JOIN documents USING (doc_id)
GROUP BY GROUPING SETS ((lang, source, type), (lang, type), (source, type), (type))""",
    "pii_leak_check": f"""{_R}{D.redacted_cte(*_DOC)},
leaks AS (SELECT DISTINCT k.doc_id FROM kept k JOIN redacted r USING (doc_id) WHERE contains(r.redacted_text, k.original))
SELECT (SELECT count(*) FROM documents) AS texts, (SELECT count(DISTINCT doc_id) FROM kept) AS texts_with_pii,
       (SELECT count(*) FROM leaks) AS texts_leaking, CAST(0 AS BIGINT) AS broken_roundtrips""",
}
