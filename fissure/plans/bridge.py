"""Canonical rows and companion tables derived from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, and the SQL that returns the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql if sql.lstrip().startswith("WITH RECURSIVE") else f"WITH {VULN} {sql}"
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vuln_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.expr("concat('ds', doc_id % 5)").alias("source"),
        F.expr("element_at(array('c', 'C++', 'cpp', 'java', ' Java ', 'python', ''), cast(doc_id % 7 as int) + 1)").alias("language"),
        F.expr("case when doc_id % 13 = 0 then 'Unknown' when doc_id % 17 = 0 then '' when doc_id % 5 = 0 then concat('cwe_0', doc_id % 23 + 1, '|CWE ', doc_id % 29 + 1) else concat('CWE-', doc_id % 23 + 1) end").alias("cwe"),
        F.col("text").alias("code_before"),
        F.expr("case when doc_id % 19 = 0 then text when doc_id % 31 = 0 then '' else concat(text, ' fixed') end").alias("code_after"),
        F.expr("concat('github.com/org', doc_id % 20, '/repo/commit/', substring(md5(cast(doc_id as string)), 1, 12))").alias("commit_url"),
    )


VULN = r"""
    vuln_rows AS (
        SELECT doc_id AS row_id, 'ds' || (doc_id % 5) AS source,
            CASE doc_id % 7 WHEN 0 THEN 'c' WHEN 1 THEN 'C++' WHEN 2 THEN 'cpp' WHEN 3 THEN 'java' WHEN 4 THEN ' Java ' WHEN 5 THEN 'python' ELSE '' END AS language,
            CASE WHEN doc_id % 13 = 0 THEN 'Unknown' WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 5 = 0 THEN 'cwe_0' || (doc_id % 23 + 1) || '|CWE ' || (doc_id % 29 + 1) ELSE 'CWE-' || (doc_id % 23 + 1) END AS cwe,
            text AS code_before,
            CASE WHEN doc_id % 19 = 0 THEN text WHEN doc_id % 31 = 0 THEN '' ELSE text || ' fixed' END AS code_after,
            'github.com/org' || (doc_id % 20) || '/repo/commit/' || left(md5(CAST(doc_id AS VARCHAR)), 12) AS commit_url
        FROM documents),
    norm AS (
        SELECT *,
            CASE WHEN row_id % 13 = 0 OR row_id % 17 = 0 THEN CAST([] AS VARCHAR[]) WHEN row_id % 5 = 0 THEN ['CWE-' || (row_id % 23 + 1), 'CWE-' || (row_id % 29 + 1)] ELSE ['CWE-' || (row_id % 23 + 1)] END AS cwes,
            CASE WHEN row_id % 7 IN (0, 1, 2) THEN 'c/c++' WHEN row_id % 7 IN (3, 4) THEN 'java' WHEN row_id % 7 = 5 THEN 'python' ELSE '' END AS lang
        FROM vuln_rows),
    strips AS (
        SELECT *, regexp_replace(code_before, '^[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]+|[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]+$', '', 'g') AS b, regexp_replace(code_after, '^[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]+|[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]+$', '', 'g') AS a
        FROM norm),
    steps AS (
        SELECT *, lang IN ('c/c++', 'java') AS k1, row_id % 13 <> 0 AND row_id % 17 <> 0 AS k2, length(b) >= 10 AND length(a) >= 10 AND b <> a AS k3 FROM strips),
    cleaned AS (SELECT row_id, source, lang AS language, cwes, code_before, code_after, commit_url FROM steps WHERE k1 AND k2 AND k3),
    pairs AS (SELECT 'CWE-' || (n_nationkey % 20 + 1) AS cwe, 'CWD-' || (1000 + n_nationkey) AS cwd, CAST(n_nationkey AS INTEGER) AS ord FROM nation),
    first_cwd AS (SELECT cwe, arg_min(cwd, ord) AS cwd FROM pairs GROUP BY cwe),
    nodes AS (SELECT CAST(n_nationkey AS INTEGER) AS ord, r_name AS category, 'CWD-' || (1000 + n_nationkey) AS cwd, n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 3 END AS level FROM nation JOIN region ON n_regionkey = r_regionkey),
    classed AS (SELECT c.*, c.cwes[1] AS primary_cwe, f.cwd FROM cleaned c LEFT JOIN first_cwd f ON f.cwe = c.cwes[1])
"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cwe, cwd, ord): some ids have two classes."""
    return read(spark, sf_dir, "nation").select(F.expr("concat('CWE-', n_nationkey % 20 + 1)").alias("cwe"), F.expr("concat('CWD-', 1000 + n_nationkey)").alias("cwd"), F.col("n_nationkey").cast("int").alias("ord"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("int").alias("ord"), F.col("r_name").alias("category"), F.expr("concat('CWD-', 1000 + n_nationkey)").alias("cwd"), F.col("n_name").alias("name"), F.expr("case when n_nationkey % 3 = 0 then 2 else 3 end").alias("level"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fissure.functions import cwe
    from fissure.operators import clean

    return clean.clean(vuln_rows(spark, sf_dir)).withColumn("cwes", cwe.tokens(F.col("cwe")))


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fissure.operators import taxonomy

    return taxonomy.with_cwds(cleaned(spark, sf_dir), pairs(spark, sf_dir))
