from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SCHEMAS = {
    "documents": DOCUMENTS,
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


@pytest.fixture
def tables(spark, tmp_path):
    """Writes rows as the given tables, the others empty, and gives their folder. Extra columns carry names that the
    operators use inside."""

    def write(**rows):
        for name, schema in SCHEMAS.items():
            clash = T.StructType.fromDDL(schema + ", `row` string, `n` string, `score` string, `_part` string, `taken` string")
            data = [(*r, "x", None, "y", "z", None) for r in rows.get(name, [])]
            spark.createDataFrame(data, clash).repartition(2).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


@pytest.fixture
def run(spark, tables):
    """Rows of a registered query over the given tables."""
    from veilstone.llm.queries import QUERIES

    def of(query, **rows):
        return QUERIES[query](spark, tables(**rows)).collect()

    return of

