"""Rows are not worked on again for each part of a result."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fissure.operators import review


def test_a_report_reviews_each_entry_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def generate(prompt: str) -> str:
        calls.add(1)
        return json.dumps({"severity": "HIGH", "fix_quality": "GOOD"})

    rows = spark.range(4).select(F.col("id").alias("row_id"), F.lit("CWE-1").alias("CWE"), F.lit("a").alias("vulnerable"), F.lit("b").alias("benign"))
    out = review.review(rows, generate, {s: "x" for s in review.STAGES}, tries=1, delay=0.0)
    report = {(r["metric"], r["value"]): r["n"] for r in review.quality_report(out).collect()}
    assert report["severity", "HIGH"] == 4 and report["fix_quality", "GOOD"] == 4 and report["confidence", "average"] == 4
    assert calls.value == 12


def test_prompts_get_differences_where_they_ask_for_them(spark):
    rows = spark.createDataFrame([(1, "CWE-1", "a\n", "b\n")], "row_id long, CWE string, vulnerable string, benign string")
    got = review.review(rows, lambda p: json.dumps({"severity": p}), {s: "{code_before}|{diff}|{previous}" for s in review.STAGES}, tries=1, delay=0.0).first()
    said = json.loads(got["review"])["vulnerability_analysis"]["severity"]
    assert said.startswith("a\n|--- vulnerable.c") and said.endswith("|{}")


def test_tokens_are_counted_once(spark, tmp_path):
    from fissure.llm import queries

    spark.createDataFrame([(1, "a b\nc"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.tokens_base(spark, str(tmp_path))
    assert all(r["adds_up"] for r in found.collect())
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
