"""What grows with the corpus must not be built on the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from fissure.llm import components, simhash


def test_links_are_not_broadcast(spark, monkeypatch):
    plans = []

    def cut(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(simhash, "cut", cut)
    fps = spark.range(300).select(F.xxhash64("id").alias("fp"))
    links = simhash.links(fps)
    links.collect()
    stars = components._star(links.filter("a > b"), True)
    plans += [x._jdf.queryExecution().executedPlan().toString() for x in (links, stars)]
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastHashJoin" in p for p in plans)
