"""Single files that are written at once or not at all, documents of any size, and zipped dumps that several tasks read."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from fissure.operators import benchmark
from fissure.sources import files, sinks, stores


def test_a_file_appears_when_it_is_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "SENT", 5)
    path = str(tmp_path / "x.txt")
    for text in ("first é\n", "second 日本\n"):
        with stores.writing(spark, path) as file:
            for c in text:
                file.write(c)
        assert open(path, encoding="utf-8").read() == text
    with pytest.raises(ZeroDivisionError), stores.writing(spark, path) as file:
        file.write("third")
        1 / 0  # noqa: B018
    assert open(path, encoding="utf-8").read() == text and [n for n in os.listdir(tmp_path) if not n.endswith(".crc")] == ["x.txt"]


def found(spark, n: int):
    rows = spark.range(n).select(F.col("id").alias("row_id"), F.expr("element_at(array('C', 'Java', 'odd \"{name}\\n'), cast(id % 3 as int) + 1)").alias("language"), F.expr("concat('CWD-', id % 7, if(id % 5 = 0, ': [', ''))").alias("cwd"))
    return rows.withColumn("entry", F.struct(F.concat(F.lit('{"] }\n'), F.col("row_id")).alias("CWE"), F.lit(None).cast("string").alias("nothing"), F.array("row_id").alias("xs")))


@pytest.mark.parametrize("n", [0, 1, 400])
def test_documents(spark, tmp_path, n):
    path, rows = str(tmp_path / "doc.json"), found(spark, n).repartition(6)
    sinks.document(rows, path)
    want = json.loads(benchmark.nested(rows).first()["document"]) if n else {}
    with open(path, encoding="utf-8") as file:
        assert json.load(file) == want
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 900)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        back = sinks.document_entries(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got: dict = {}
    for r in sorted(back, key=lambda r: (r["language"], r["cwd"], r["pos"])):
        items = got.setdefault(r["language"], {}).setdefault(r["cwd"], [])
        assert r["pos"] == len(items)
        items.append(json.loads(r["line"]))
    assert got == want


def test_a_document_is_written_in_parts(spark, tmp_path, monkeypatch):
    seen = []
    joined = stores.joined
    monkeypatch.setattr(stores, "joined", lambda s, file, folder: (seen.append(len(stores.listed(s, f"{folder}/part-*"))), joined(s, file, folder)))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.document(found(spark, 3000), str(tmp_path / "doc.json"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert seen[0] > 1


def test_zipped_dumps_are_laid_out_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ZIPPED", 1000)
    lines = [f"INSERT INTO cwe_classification VALUES('CVE-{i}','CWE-{i % 13}');" for i in range(5000)] + ["INSERT INTO fixes VALUES('CVE-1','h','u');"]
    for name, part in (("big", lines), ("small", lines[:3])):
        with gzip.open(tmp_path / f"{name}.sql.gz", "wt") as file:
            file.write("\n".join(part) + "\n")
    path = f"{tmp_path}/*.sql.gz"
    paths = files.splittable(spark, path, 700)
    assert len(paths) == 2 and paths[1].endswith("small.sql.gz") and len(stores.listed(spark, f"{paths[0]}/part-*")) == 8
    assert files.splittable(spark, path, 700) == paths
    assert {r["cwe"]: r["n"] for r in files.dump_cwe_tally(spark, path).collect()} == {f"CWE-{k}": sum(i % 13 == k for i in range(5000)) + (k < 3) for k in range(13)}
    assert files.dump_lines(spark, path, "fixes").count() == 1
    monkeypatch.setattr(files, "ZIPPED", 1 << 40)
    assert files.dump_lines(spark, path, "cwe_classification").count() == 5003
    with pytest.raises(Exception, match="(?i)path"):
        files.dump_lines(spark, f"{tmp_path}/none/*.sql.gz", "fixes").count()
