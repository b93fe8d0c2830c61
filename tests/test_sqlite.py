"""The SQLite source: ranges, columns, filters, odd values and odd tables."""

from __future__ import annotations

import sqlite3

import pytest
from pyspark.sql import functions as F

from fissure.sources import datasets, sqlite


@pytest.fixture
def database(tmp_path):
    file = str(tmp_path / "a b%.db")
    with sqlite3.connect(file) as db:
        db.execute('CREATE TABLE t (id INTEGER, "odd ""name" VARCHAR(9), x DOUBLE, raw BLOB, day DATETIME, folded TEXT COLLATE NOCASE)')
        db.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", [(i, f"n{i % 7}", i / 4, bytes([i % 256]), f"2024-01-{i % 28 + 1:02}", "Ab" if i % 2 else "aB") for i in range(1000)])
        db.execute("INSERT INTO t VALUES ('no number', x'ff41', 'text', 'text', 5, NULL)")
        db.execute("DELETE FROM t WHERE id BETWEEN 100 AND 180")
        db.execute("CREATE TABLE keyed (k TEXT PRIMARY KEY, v INTEGER) WITHOUT ROWID")
        db.execute("INSERT INTO keyed VALUES ('a', 1), ('b', 2)")
        db.execute("CREATE VIEW seen AS SELECT id FROM t WHERE id < 5")
        db.execute("CREATE TABLE hollow (v INTEGER)")
    return file


def test_types_and_ranges(spark, database):
    df = sqlite.table(spark, database, "t", ranges=5)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("id", "bigint"), ('odd "name', "string"), ("x", "double"), ("raw", "binary"), ("day", "string"), ("folded", "string")]
    assert df.rdd.getNumPartitions() == 5
    rows = df.collect()
    assert len(rows) == 1000 - 81 + 1 and {r["id"] for r in rows} == {*range(100), *range(181, 1000), None}
    odd = next(r for r in rows if r["id"] is None)
    assert (odd[1], odd["x"], bytes(odd["raw"]), odd["day"], odd["folded"]) == ("\xffA", None, b"text", "5", None)
    assert max(df.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 300


def test_columns_and_filters(spark, database):
    df = sqlite.table(spark, database, "t", "id long, folded string, absent string")
    assert df.filter("id between 90 and 200 and folded = 'Ab'").count() == sum(i % 2 for i in [*range(90, 100), *range(181, 201)])
    assert df.filter("folded in ('aB', 'x') and id > 990").count() == 4
    assert df.filter("id is null").count() == 1 and df.filter("folded is null").count() == 1
    assert df.filter("absent is not null").count() == 0
    # what is asked of SQLite alone
    reader = sqlite.Reader({"path": database, "table": "t", "ranges": "3"}, df.schema)
    asked = [sqlite.GreaterThan(("id",), 990), sqlite.EqualTo(("folded",), "Ab"), sqlite.IsNotNull(("id",)), sqlite.EqualTo(("folded",), 1)]
    assert list(reader.pushFilters(asked)) == asked and len(reader.where) == 3
    assert sorted(x for p in reader.partitions() for b in reader.read(p) for x in b.column(0).to_pylist()) == [991, 993, 995, 997, 999]


def test_odd_tables(spark, database, tmp_path):
    assert sorted(map(tuple, sqlite.table(spark, database, "keyed").collect())) == [("a", 1), ("b", 2)]
    assert sorted(r[0] for r in sqlite.table(spark, database, "seen").collect()) == [0, 1, 2, 3, 4]
    assert sqlite.table(spark, database, "hollow").count() == 0
    with pytest.raises(Exception, match="no table"):
        sqlite.table(spark, database, "absent").count()
    with pytest.raises(Exception, match="mount"):
        sqlite.table(spark, "hdfs://a/b.db", "t").count()
    # a folder is one table; files without it have no rows
    with sqlite3.connect(str(tmp_path / "c.db")) as db:
        db.execute("CREATE TABLE keyed (k TEXT, v INTEGER)")
        db.execute("INSERT INTO keyed VALUES ('c', 3)")
    sqlite3.connect(str(tmp_path / "d.db")).execute("CREATE TABLE other (k TEXT)").connection.close()
    assert sorted(map(tuple, sqlite.table(spark, str(tmp_path), "keyed").collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_shipped(spark, database):
    spark.sparkContext.addFile(database)
    assert sqlite.table(spark, "a b%.db", "keyed", shipped=True).count() == 2


def test_cvefixes(spark, tmp_path):
    (tmp_path / "cvefixes" / "CVEfixes_v1.0.8" / "Data").mkdir(parents=True)
    (tmp_path / "cvefixes" / "CVEfixes_v1.0.10" / "Data").mkdir(parents=True)
    for version, name in (("8", "old.c"), ("10", "new.c")):
        with sqlite3.connect(str(tmp_path / "cvefixes" / f"CVEfixes_v1.0.{version}" / "Data" / "CVEfixes.db")) as db:
            db.execute("CREATE TABLE file_change (file_change_id TEXT, hash TEXT, filename TEXT, code_after TEXT, code_before TEXT, programming_language TEXT)")
            db.execute("CREATE TABLE fixes (cve_id TEXT, hash TEXT, repo_url TEXT)")
            db.execute("CREATE TABLE cwe_classification (cve_id TEXT, cwe_id TEXT)")
            db.executemany("INSERT INTO file_change VALUES (?, ?, ?, ?, ?, ?)", [("1", "h1", name, "int a;", name, "C"), ("2", "h1", "x.py", "a", "b", "Python"), ("3", "h2", "y.c", "same", "same", "C"), ("4", "h3", "z.c", "a", "b", None)])
            db.execute("INSERT INTO fixes VALUES ('CVE-1', 'h1', 'https://github.com/o/r')")
            db.executemany("INSERT INTO cwe_classification VALUES (?, ?)", [("CVE-1", "CWE-79"), ("CVE-1", "CWE-20"), ("CVE-1", "CWE-79")])
    rows = [tuple(r) for r in datasets.READERS["cvefixes"](spark, str(tmp_path)).collect()]
    assert rows == [("CWE-20|CWE-79", "new.c", "int a;", "https://github.com/o/r/commit/h1", "c")]
