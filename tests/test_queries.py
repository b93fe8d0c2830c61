"""Every query against its SQL at the smallest scale, and the driver's contract."""

from __future__ import annotations

import math
import os
import shutil
import subprocess
import sys
from collections import Counter

import pytest

import __spark_entry__
from fissure.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else float(x) if type(x).__name__ == "Decimal" else x


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in catalog.ORACLE_SQL:
        found = duck.sql(catalog.ORACLE_SQL[name])
        names = list(found.columns)
        assert sorted(names) == columns
        assert rows == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    else:
        assert sum(rows.values()) > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_optional_parts(tmp_path):
    shutil.copytree(os.path.join(ROOT, "fissure"), tmp_path / "fissure", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'flagship' in q and not any(n.startswith('op') or n == 'pipeline' for n in q), q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
