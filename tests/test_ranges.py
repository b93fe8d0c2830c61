"""JSON arrays and quoted CSV in byte ranges: the same rows as a reader of whole files gives, however the files are cut."""

from __future__ import annotations

import csv
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from fissure.sources import datasets, files, ranges


@pytest.fixture
def cut(spark):
    """Ranges of so many bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def at(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield at
    for k, v in before.items():
        spark.conf.set(k, v)


def odd_text(r: random.Random, n: int) -> str:
    return "".join(r.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "\n", "\r\n", "a", "é", "日", " ", "\\\\", '\\"', "\t", "}{"]) for _ in range(r.randint(0, n)))


@pytest.mark.parametrize("size", [37, 300, 5000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays(spark, tmp_path, cut, size, indent):
    cut(size)
    r = random.Random(size)
    want = {}
    for name, n in (("a", 60), ("b", 1), ("c", 0), ("d", 3)):
        rows = [{"id": i, "t": odd_text(r, 40 if name != "d" else 3000), "more": {"xs": [[i], [odd_text(r, 5)]], "y": {}}} for i in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, ensure_ascii=name == "a", indent=indent))
        want |= {(f"{name}.json", i + 1): (x["id"], x["t"], len(x["more"]["xs"])) for i, x in enumerate(rows)}
    df = ranges.json_array(spark, str(tmp_path), "id long, t string, more struct<xs: array<array<string>>>")
    got = {(os.path.basename(x["file"]), x["number"]): (x["id"], x["t"], len(x["more"]["xs"])) for x in df.collect()}
    assert got == want


@pytest.mark.parametrize("part", [64, 4 << 20])
def test_ranges_in_parts(spark, tmp_path, cut, monkeypatch, part):
    monkeypatch.setattr(ranges, "PART", part)
    r = random.Random(7)
    rows = [{"t": odd_text(r, 100)} for _ in range(50)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    cut(1500)
    assert [x["t"] for x in ranges.json_array(spark, str(tmp_path), "t string").orderBy("number").collect()] == [x["t"] for x in rows]


@pytest.mark.parametrize("size", [37, 300, 5000, 1 << 20])
def test_csv(spark, tmp_path, cut, size):
    cut(size)
    r = random.Random(size)
    want = {}
    for name, n, end in (("a", 50, "\r\n"), ("b", 1, "\n"), ("c", 0, "\n"), ("d", 4, "\n")):
        rows = [[str(i), odd_text(r, 30 if name != "d" else 2000), odd_text(r, 4)] for i in range(n)]
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8-sig" if name == "b" else "utf-8") as file:
            writer = csv.writer(file, lineterminator=end)
            writer.writerow(["id", "odd\nname", "z"])
            for row in rows:
                if r.random() < 0.2:
                    file.write(end)
                writer.writerow(row)
        want |= {(f"{name}.csv", i + 1): tuple(row) for i, row in enumerate(rows)}
    got = {(os.path.basename(x["file"]), x["number"]): (x["id"], x["odd\nname"], x["z"]) for x in ranges.csv_rows(spark, str(tmp_path), ["id", "odd\nname", "z"]).collect()}
    assert got == want


def test_canonical_rows_and_their_numbers(spark, tmp_path, cut):
    r = random.Random(3)
    rows = [(f"CWE-{i}", odd_text(r, 60), odd_text(r, 60), "", "c") for i in range(80)]
    with open(tmp_path / "x.csv", "w", newline="") as file:
        csv.writer(file).writerows([("cwe", "code_before", "code_after", "commit_url", "language"), *rows])
    for size in (200, 1 << 20):
        cut(size)
        df = files.canonical_csv(spark, str(tmp_path / "x.csv"))
        assert df.columns == ["cwe", "code_before", "code_after", "commit_url", "language", "source", "row_id"]
        assert [tuple(x) for x in df.orderBy("row_id").collect()] == [(*row, "x", i + 1) for i, row in enumerate(rows)]


def test_one_file_by_many_tasks(spark, tmp_path, cut):
    text = json.dumps({"cwe_ids": ["CWE-1"], "commits": [{"git_url": "https://x/y/commit/1", "repo_name": "x/y", "commit_hash": "1", "files": [{"language": "C", "vulnerable_functions": [{"func_before": "int a() { return \"}\"; }" * 20, "func_after": "{[\\\"" * 50}]}]}]})
    with open(tmp_path / "big.json", "w") as file:
        file.write("[" + ", ".join([text] * 8000) + "]")
    cut(1 << 20)
    assert ranges.pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() >= 8
    df = datasets.megavul(spark, str(tmp_path / "big.json"))
    assert df.groupBy("cwe", "language").agg(F.count("*"), F.count_distinct("code_before")).collect() == [("CWE-1", "C", 8000, 1)]


def test_row_numbers_depend_on_the_data_alone(spark, tmp_path, cut):
    r = random.Random(5)
    os.makedirs(tmp_path / "MSR")
    os.makedirs(tmp_path / "megavul" / "megavul" / "x" / "c_cpp")
    with open(tmp_path / "MSR" / "MSR_data_cleaned.csv", "w", newline="") as file:
        csv.writer(file).writerows([("", "CWE ID", "func_before", "func_after", "codeLink", "lang"), *((i, "CWE-1", f"a{i % 9}" + odd_text(r, 9), "b", "", "C") for i in range(90))])
    entry = lambda i: {"cwe_ids": ["CWE-2"], "commits": [{"git_url": "", "repo_name": "o/r", "commit_hash": str(i), "files": [{"language": "C", "vulnerable_functions": [{"func_before": f"f{j}", "func_after": "g"} for j in range(i % 3)]}]}]}
    (tmp_path / "megavul" / "megavul" / "x" / "c_cpp" / "cve_with_graph_abstract_commit.json").write_text(json.dumps([entry(i) for i in range(70)]))
    for name, n in (("msr", 90), ("megavul", sum(i % 3 for i in range(70)))):
        found = []
        for size, partitions in ((150, 3), (1 << 20, 7)):
            cut(size)
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append(sorted(map(tuple, datasets.normalize(spark, name, str(tmp_path)).select("row_id", "code_before", "commit_url").collect())))
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        assert found[0] == found[1] and [x[0] for x in found[0]] == list(range(1, n + 1))
    # in the order of the file, and without one, by content
    assert [x[2].rsplit("/", 1)[1] for x in found[0]] == [str(i) for i in range(70) for _ in range(i % 3)]
    rows = spark.createDataFrame([(f"x{i % 7}", i) for i in range(60)], "a string, b long")
    one, two = ({tuple(x) for x in datasets.numbered(rows.repartition(k)).collect()} for k in (2, 9))
    assert one == two and sorted(x[2] for x in one) == list(range(1, 61))
    assert datasets.numbered(rows.limit(0)).count() == 0
