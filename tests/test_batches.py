"""Python workers get batches of bounded size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__
from fissure import session

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_of_queries_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    def query(spark, sf_dir):
        return spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text")).mapInArrow(sizes, "n long")

    run = __spark_entry__._ready(query)
    try:
        found = [r["n"] for r in run(spark, "").collect()]
        assert sum(found) > 20_000_000 and max(found) < 5_000_000
        spark.conf.set(KEY, "1m")
        assert max(r["n"] for r in run(spark, "").collect()) < 1_100_000
    finally:
        spark.conf.unset(KEY)
    assert session.SETTINGS[KEY] == "4m"
