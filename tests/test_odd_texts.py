"""Queries over texts that are empty, null or hold other line ends and blank lines, against their SQL."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fissure.functions import code, text
from fissure.plans import catalog

TEXTS = [None, "", "\n", "\n\n\n", " ", "\n \n", "\r", "\r\n", "a", "a\n", "\na", "a\n\n\nb", "a\n \nb", "a\r\n\r\nb", "a\u2028b\x0cc\x85d\n", "|", "a|\n|\n\n|b", "x" * 201, "é " * 120, "😀" * 9000]
PIECES = ["\n", "\n\n", " ", "\t", "\r", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "|", "a", "bc", "😀"]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    import duckdb

    r = random.Random(1)
    texts = [t for t in TEXTS for _ in range(3)] + ["".join(r.choice(PIECES) for _ in range(r.randint(1, 30))) for _ in range(600)]
    folder = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts, 1)))
    con.execute(f"copy documents to '{folder}/documents.parquet' (format parquet)")
    for table in ("nation", "region"):
        con.execute(f"create table {table} as select 0 as n_nationkey, 0 as n_regionkey, 0 as r_regionkey, '' as r_name, '' as n_name")
    return con, str(folder)


@pytest.mark.parametrize("name", ["p33_prepared", "p35_blank_lines", "p40_excerpts"])
def test_odd_texts(spark, odd, name):
    con, folder = odd
    found = con.sql(catalog.ORACLE_SQL[name])
    df = catalog.QUERIES[name](spark, folder).select(*found.columns)
    assert Counter(map(tuple, df.collect())) == Counter(found.fetchall())


def test_long_blank_runs(spark):
    n = 100_000
    data = ["a" + "\n" * n + "b", " \n" * n + "b", "b" + "\n\t" * n, "\n" * n, "a\n" + " " * n + "\nb", "a" + " " * n + "b"]
    got = spark.createDataFrame([(d,) for d in data], "x string").select(text.drop_blank_runs(F.col("x"))).collect()
    assert [r[0] for r in got] == ["a\n\nb", "b", "b", "", "a\n\nb", data[5]]


def test_embedding_text_of_empty_sides(spark):
    rows = [([], ["x"]), ([""], ["x"]), (None, ["x"]), (["a", "b"], None), (["a"], ["x", "y"]), (None, None)]
    got = spark.createDataFrame(rows, "b array<string>, v array<string>").select(code.embedding_text(F.col("b"), F.col("v"), F.lit("other"))).collect()
    assert [r[0] for r in got] == ["\n\nx", "\n\nx", "x", "a\nb", "a\n\nx\ny", "other"]
