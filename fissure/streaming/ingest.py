"""Incremental cleaning of canonical rows that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fissure.functions.text import content_hash
from fissure.operators import clean

SCHEMA = "row_id long, source string, cwe string, code_before string, code_after string, commit_url string, language string, arrived timestamp"


def cleaned(spark: SparkSession, folder: str, delay: str = "7 days") -> DataFrame:
    """Cleaned rows of new Parquet files; a pair of contents that arrives again within ``delay`` goes."""
    rows = spark.readStream.schema(SCHEMA).parquet(folder).withWatermark("arrived", delay)
    rows = clean.clean(rows).withColumn("before_hash", content_hash(F.col("code_before"))).withColumn("after_hash", content_hash(F.col("code_after")))
    return rows.dropDuplicatesWithinWatermark(["before_hash", "after_hash"])


def run_available(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; the next call goes on where this one ended."""
    return cleaned(spark, folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
