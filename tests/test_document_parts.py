"""Nested documents in parts of bounded size."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fissure.operators import benchmark

ENTRY = "named_struct('benign_code', named_struct('context', 'a', 'class', cast(null as string), 'func', cast(null as string), 'lines', cast(array() as array<array<string>>)))"


def test_large_documents_come_in_parts(spark):
    found = spark.range(300).select(F.col("id").alias("row_id"), F.lit("c").alias("language"), F.expr("concat('CWD-\n', id % 2)").alias("cwd"), F.expr(ENTRY.replace("'a'", "cast(id as string)")).alias("entry"))
    parts = benchmark.nested_parts(found)
    assert all(len(items) <= benchmark.PART for r in parts.collect() for groups in json.loads(r["document"]).values() for items in groups.values())
    whole, cut = (sorted((r["language"], r["cwd"], r["pos"], r["entry"]["benign_code"]["context"]) for r in benchmark.flattened(d).collect()) for d in (benchmark.nested(found), parts))
    assert whole == cut and len(cut) == 300
    few = found.filter("row_id % 3 = 0")
    one, two = (sorted(map(tuple, benchmark.merged(a, b).collect())) for a, b in ((benchmark.nested(found), benchmark.nested(few)), (parts, benchmark.nested_parts(few))))
    assert one == two and len(two) == 400
