"""Pairs of vulnerable and fixed functions of a commit."""

from __future__ import annotations

from itertools import groupby

from fissure.sources import datasets

COLUMNS = "project string, commit_id string, target int, file_name string, func string, idx string, cwe array<string>, commit_url string"


def test_pairs_are_shuffled_once(spark):
    rows = [(None if n % 3 == 0 else "p", None if n % 5 == 0 else str(n % 7), (0, 1, None)[n % 3], f"{n % 2}.c", f"\n f{n % 11} \n{n}", f" {n % 4} ", None if n % 4 else ["CWE-1"], None) for n in range(200)]
    rows += [("q", "alone", 1, "a", "x", "1", None, "u"), ("q", "fixed alone", 0, "a", "x", "1", None, "u"), ("q", "none", 1, None, None, None, None, None), ("q", "none", 0, None, None, "x", ["CWE-2"], "v")]
    found = datasets.paired(spark.createDataFrame(rows, COLUMNS).repartition(3, "func"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(project") == 1 and "Join" not in plan
    assert found.columns == ["project", "commit_id", "rank", "target", "file_name", "func", "idx", "cwe", "commit_url", *(f"after_{c}" for c in ("target", "file_name", "func", "idx", "cwe", "commit_url"))]

    def place(row):
        lines = [x.strip() for x in (row[4] or "").split("\n") if x.strip()]
        index = (row[5] or "").strip()
        return row[3] or "", lines[0] if lines else "", int(index) if index.isdigit() else 0, row[4] or ""

    wanted = []
    commit = lambda row: (row[0] or "", row[1] or "")
    for key, of in groupby(sorted(rows, key=commit), commit):
        of = list(of)
        before, after = (sorted((r for r in of if (r[2] == 1) == side), key=place) for side in (True, False))
        wanted += [(*key, i + 1, *b[2:], *a[2:]) for i, (b, a) in enumerate(zip(before, after, strict=False))]
    assert len(wanted) > 50
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted))
