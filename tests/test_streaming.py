"""Drops of a stream against those of one batch."""

from __future__ import annotations

import random

import pytest

from fissure.operators import dedup
from fissure.streaming import drops


@pytest.mark.parametrize("mode", ["compat", "fixed"])
def test_batches_drop_what_one_batch_drops(spark, tmp_path, mode):
    r = random.Random(6)
    ids = ["", "CWE-1", "CWE-20|CWE-3", "CWE-7;CWE-9", "CWE-2,CWE-1"]
    rows = [(r.choice(["", "f()", "g()", "h(int a)", *(f"one{i}()" for i in range(30))]), r.choice(["a", "a", "a", "b", "c"]), i, r.choice(ids), "c", "x", "y", "") for i in range(400)]
    # a key whose rows of one source all come before the first of another, which is better than they are
    rows += [("late()", "z", 1000 + i, "CWE-1|CWE-2" if mode == "fixed" else "CWE-1;CWE-2", "c", "x", "y", "") for i in range(50)] + [("late()", "y", 2000, "", "c", "x", "y", "")]
    whole = spark.createDataFrame(rows, drops.LINES)
    want = sorted(map(tuple, dedup.drops(whole, mode).collect()))
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for at in range(0, len(rows), 120):
            spark.createDataFrame(rows[at : at + 120], drops.LINES).coalesce(2).write.mode("append").parquet(folder)
            drops.run_available(spark, folder, out, checkpoint, mode).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == want and len(want) > 100
