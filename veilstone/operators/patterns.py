"""Pattern sets from a feed of backend rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilstone.functions.patterns import BOOTSTRAP, Pattern
from veilstone.functions.regex import UnsupportedPattern, can_match_empty, compiled, java_regex, python_regex

FEED_SCHEMA = (
    "STRUCT<patterns: ARRAY<STRUCT<pattern: STRING, threat_type: STRING, confidence: DOUBLE, prefix: STRING>>, "
    "total: INT, version: STRING>"
)

# Token prefixes by threat type, used by the strict way of loading.
KNOWN_PREFIXES: dict[str, str] = {
    "pii_ssn": "SSN",
    "pii_ssn_alt": "SSN",
    "pii_credit_card": "CARD",
    "pii_email": "EMAIL",
    "pii_phone": "PHONE",
    "pii_phone_intl": "PHONE",
    "pii_street_address": "ADDR",
    "pii_city_state_zip": "ADDR",
    "pii_bank_account": "ACCOUNT",
    "pii_routing_number": "ROUTING",
    "pii_iban": "IBAN",
    "pii_swift": "SWIFT",
    "pii_medical_record": "MRN",
    "pii_health_insurance": "HEALTHID",
    "pii_drivers_license": "DL",
    "pii_passport": "PASSPORT",
    "pii_dob": "DOB",
    "pii_medical_diagnosis": "MEDINFO",
    "pii_medical_code": "MEDCODE",
    "pii_prescription": "RX",
    "pii_ein": "TAXID",
    "pii_tin": "TAXID",
    "pii_potential_name": "NAME",
}


def feed_rows(feed_json: DataFrame, column: str = "value") -> DataFrame:
    """Rows of a feed that arrives as one JSON text: an object with an array `patterns`."""
    parsed = feed_json.select(F.from_json(column, FEED_SCHEMA).alias("feed"))
    return parsed.select(F.explode("feed.patterns").alias("p")).select("p.*")


def usable(spark: SparkSession, regex: str) -> bool:
    """Whether all engines can run the pattern, and it has no empty match, which would have no span to replace."""
    try:
        if can_match_empty(regex):
            return False
        compiled(python_regex(regex))
        pc.match_substring_regex(pa.array([""]), pattern=regex)
        spark.sql("SELECT '' RLIKE :java FROM VALUES (1) AS t(x)", args={"java": java_regex(regex)}).first()
        return True
    except (UnsupportedPattern, PySparkException, ValueError, IndexError, re.error):
        return False


def load_patterns(
    feed: DataFrame, current: Sequence[Pattern] = BOOTSTRAP, strict: bool = False
) -> tuple[Pattern, ...]:
    """A pattern set from feed rows (pattern, threat_type, confidence, prefix), or `current` if none is usable.

    A detector is named after its threat type without `pii_`. Detectors come by the highest confidence any row of
    their name has, ties in feed order. `strict` drops unknown threat types, takes prefixes from the fixed list and
    ignores case. Feed rows are configuration, read on the driver; the data never passes through it.
    """
    spark = feed.sparkSession
    numbered = feed.withColumn("_pos", F.monotonically_increasing_id())
    given = numbered.where((F.coalesce("threat_type", F.lit("")) != "") | F.lit(strict)).where(
        (F.coalesce("pattern", F.lit("")) != "") | F.lit(strict)
    )
    bare = F.regexp_replace("threat_type", "^pii_", "")
    if strict:
        known = F.create_map(*[F.lit(x) for pair in KNOWN_PREFIXES.items() for x in pair])
        shaped = given.withColumn("prefix", F.try_element_at(known, "threat_type")).where("prefix IS NOT NULL")
        regex = F.when(F.col("pattern").startswith("(?i)"), F.col("pattern")).otherwise(
            F.concat(F.lit("(?i)"), "pattern")
        )
        shaped = shaped.withColumn("pattern", regex)
    else:
        derived = F.coalesce(F.nullif(F.upper(bare), F.lit("")), F.lit("PII"))
        own = F.col("prefix") if "prefix" in feed.columns else F.lit(None).cast("string")
        shaped = given.withColumn("prefix", F.coalesce(F.nullif(own, F.lit("")), derived))
    rows = shaped.withColumn("name", bare).select("_pos", "name", "pattern", "prefix", "confidence").collect()
    good = [r for r in rows if usable(spark, r["pattern"])]
    if not good:
        return tuple(current)
    kept = spark.createDataFrame(good, "_pos bigint, name string, pattern string, prefix string, confidence double")
    best = F.greatest(F.lit(0.0), F.max("confidence").over(Window.partitionBy("name")))
    ordered = kept.withColumn("best", best).orderBy(F.desc("best"), "_pos").collect()
    return tuple(Pattern(r["name"], r["pattern"], r["prefix"], r["best"]) for r in ordered)
