"""The queries of the operators against their SQL at the smallest scale."""

from __future__ import annotations

import os
from collections import Counter

import pytest

from fissure.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(tuple(dict(zip(want.columns, r, strict=True))[c] for c in columns) for r in want.fetchall())


def test_every_operator_has_one_query():
    assert [sum(n.startswith(f"op{i}_") for n in queries.QUERIES) for i in range(1, 14)] == [1] * 13
