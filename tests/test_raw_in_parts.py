"""Raw verdicts are put together in parts: the same texts, by code that Java compiles."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

from veilstone.plans.views import EVENT_COLUMNS, event_columns

KINDS = ("view", "signup", "error", "click", "purchase", None)


def _events(spark):
    rows = [
        (i if i % 211 else None, datetime(2024, 1, 1 + i % 28, i % 24), i % 9, KINDS[i % 6], i * 1.7 % 120 if i % 13 else None, f'{{"k": {i % 101}}}' if i % 17 else None)
        for i in range(1_500)
    ]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def test_raw_is_the_same_text_as_in_one_expression(spark):
    events = _events(spark)
    got = event_columns(events, "raw").select("request_id", "raw")
    base = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    want = base.select(F.col("event_id").alias("request_id"), F.expr(EVENT_COLUMNS["raw"]).alias("raw"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.where("request_id IS NULL").where("raw IS NOT NULL").isEmpty() and got.where("raw IS NOT NULL").count() > 1_400


def test_no_method_is_too_long_to_be_compiled(spark, tmp_path, capsys):
    """Java interprets methods of 8,000 bytes of code and more."""
    _events(spark).write.parquet(str(tmp_path / "events"))
    event_columns(spark.read.parquet(str(tmp_path / "events")), "raw", "session_id").explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8_000, sizes
