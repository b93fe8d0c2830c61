"""Reviews that the queries make up, for row numbers that smaller tables don't have."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fissure.plans import catalog


@pytest.mark.parametrize(("query", "column", "want"), [("v01_reviews", "regenerate", 0.0), ("v02_confidence", "confidence", 0.613)])
def test_short_reviews_are_as_long_as_the_sql_takes_them_to_be(spark, tmp_path, query, column, want):
    spark.range(3465, 3466).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    assert float(catalog.QUERIES[query](spark, str(tmp_path)).first()[column]) == want
