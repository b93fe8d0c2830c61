"""Samples of groups with nulls, and clusters of large groups."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fissure.operators import cluster, sampling


def gaps(spark):
    rows = [(i, ["c", "java", None][i % 3], ["CWD-1", None, "CWD-2", None, "CWD-3"][i % 5], [None, "a", "b", "c"][i % 4], float(i)) for i in range(240)]
    return spark.createDataFrame(rows, "row_id long, language string, cwd string, source string, x double")


def test_nulls_are_groups_and_strata(spark):
    few = spark.createDataFrame([(1, "c", "CWD-1", "a"), (2, "c", None, "a"), (3, "c", None, None), (4, None, "CWD-1", "b")], "row_id long, language string, cwd string, source string")
    assert sorted(r["row_id"] for r in sampling.capped(few, ["language", "cwd"], "source").collect()) == [1, 2, 3, 4]
    half = spark.createDataFrame([(i, "c", "CWD-1", None if i % 2 else "a") for i in range(10)], "row_id long, language string, cwd string, source string")
    out = sampling.capped(half, ["language", "cwd"], "source", 4).collect()
    assert len(out) == 4 and sum(r["source"] is None for r in out) == 2
    rows = gaps(spark)
    for most in (3, 8, 16, 300):
        out = sampling.capped(rows, ["language", "cwd"], "source", most)
        sizes = {(r["language"], r["cwd"]): r["count"] for r in out.groupBy("language", "cwd").count().collect()}
        assert len(sizes) == 12 and all(n == min(most, 32 if c is None else 16) for (_, c), n in sizes.items()), sizes
        assert out.columns == rows.columns and out.select("row_id").distinct().count() == out.count()
    assert sampling.with_sizes(rows, ["language", "cwd"]).filter("cwd is null").select("group_size").distinct().collect() == [(32,)]


@pytest.mark.parametrize("method", ["kmeans", "stratified"])
def test_selection_with_nulls(spark, method):
    rows = gaps(spark).withColumn("embedding", F.when(F.col("language").isNull() & (F.col("row_id") == 2), None).otherwise(F.array(F.col("x").cast("float"))))
    out = cluster.select(rows, ["language", "cwd"], 4, method)
    assert {(r["language"], r["cwd"]): r["count"] for r in out.groupBy("language", "cwd").count().collect()} == {(a, b): 4 for a in ("c", "java", None) for b in ("CWD-1", None, "CWD-2", "CWD-3")}
    assert cluster.tiered(rows, ["language", "cwd"], 5, 20).count() == 60


def inertia(x, centers):
    return sum(((p - centers) ** 2).sum(1).min() for p in x)


def test_large_groups_come_near_a_local_run(spark, monkeypatch):
    monkeypatch.setattr(cluster, "SHARD", 100)
    r = np.random.default_rng(3)
    data, rows = {}, []
    for g, (n, k) in {"blobs": (900, 12), "even": (700, 0), None: (500, 5)}.items():
        x = r.normal(size=(n, 4)) if not k else r.normal(size=(k, 4))[r.integers(k, size=n)] * 10 + r.normal(size=(n, 4)) * 0.3
        data[g] = x
        rows += [(g, len(rows) + i, v.tolist()) for i, v in enumerate(x)]
    rows += [("small", len(rows) + i, [float(i), 0.0, 0.0, 0.0]) for i in range(30)] + [("same", len(rows) + 100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, row_id long, embedding array<float>").repartition(5)
    at = {i: np.array(v) for _, i, v in rows}
    count = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    jobs = {}
    for n in (4, 12):
        before = count()
        picked: dict = {}
        for x in cluster.representatives(df, ["g"], n).collect():
            picked.setdefault(x["g"], []).append(x["row_id"])
        jobs[n] = count() - before
        assert len(picked["small"]) == n and len(picked["same"]) == 1
        for g, x in data.items():
            assert len(picked[g]) == n and all(y in range(len(rows)) for y in picked[g])
            local, of = cluster.kmeans(x, n)
            near = np.stack([x[i] for i in cluster.nearest(x, local, of)])
            # both are judged by the rows that stand for the centers
            assert inertia(x, np.stack([at[i] for i in picked[g]])) <= 1.05 * inertia(x, near) + 1e-9, (g, n)
    assert abs(jobs[4] - jobs[12]) <= 3 * cluster.STEPS, jobs
    again = {x["row_id"] for x in cluster.representatives(df.repartition(2), ["g"], 12).collect()}
    assert again == {i for x in picked.values() for i in x}


def test_large_groups_take_turns(spark, monkeypatch):
    monkeypatch.setattr(cluster, "SHARD", 20)
    rows = spark.createDataFrame([(f"g{i % 6}", i, [float(i // 6 % 4 * 100), float(i % 3)]) for i in range(600)], "g string, row_id long, embedding array<float>")
    one = {tuple(r) for r in cluster.representatives(rows, ["g"], 4).collect()}
    monkeypatch.setattr(cluster, "SENT", 1000)
    assert {tuple(r) for r in cluster.representatives(rows, ["g"], 4).collect()} == one and len(one) == 24
