"""Labels grow with the corpus, so the driver must not build a table of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fissure.llm import quality


def test_labels_are_not_broadcast(spark, monkeypatch):
    plans, cut = [], quality.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(quality, "cut", seen)
    stats = spark.range(40).select(F.col("id").alias("doc_id"), *(F.col("id").alias(c) for c in quality.COUNTS + quality.MORE))
    assert quality.train(stats, spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))) is not None
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
