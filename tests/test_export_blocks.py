"""Exported documents are read in blocks."""

from __future__ import annotations

from fissure.sources import files


def test_export_state_crosses_blocks_and_looks_forward_in_linear_time(spark, monkeypatch):
    values = ["    - CWD Number: D1", "        - CWE: CWE-1", "x", "        - CWE: CWE-2", "          other CWEs(CWDs): [CWE-9]", "x", "  Language: c", "    - CWD Number: D2", "        - CWE: CWE-3", "x", "x", "  Language: java", "        - CWE: CWE-4"]
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(values)], "file string, ord long, value string")
    want = [(1, "c", "D1", "CWE-1", False), (3, "c", "D1", "CWE-2", True), (8, "java", "D2", "CWE-3", False), (12, None, "D2", "CWE-4", False)]
    for block in (2, 3, 100_000):
        monkeypatch.setattr(files, "BLOCK", block)
        found = files.export_lines(lines)
        assert sorted(tuple(r[c] for c in ("ord", "language", "cwd", "cwe", "has_others")) for r in found.collect()) == want
    assert "unboundedfollowing" not in found._jdf.queryExecution().executedPlan().toString().lower()
