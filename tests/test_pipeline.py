"""Operators on small tables, readers on generated files, and the pipeline end to end."""

from __future__ import annotations

import argparse
import csv
import gzip
import json
import os
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fissure import cli
from fissure.operators import benchmark, clean, cluster, dedup, review, sampling, stats, taxonomy
from fissure.plans import pipeline
from fissure.sources import datasets, files, sinks
from fissure.streaming import ingest

ROW = "row_id long, source string, cwe string, code_before string, code_after string, commit_url string, language string"
TREE = {"Security": {"id": "S", "items": [{"id": "CWD-1001", "cwe": ["CWE-79", "79"]}, {"id": "CWD-1002", "cwe": ["CWE-89"], "children": [{"id": "CWD-1003", "cwe": ["CWE-89"]}]}]}, "Memory": {"items": [{"id": "CWD-1004", "name": "m", "cwe": ["CWE-22"]}]}}


def six(spark):
    a, b = "int f() { return 1; } // old", "int f() { return 2; } // new"
    data = [("CWE-79", a, b, "c"), ("CWE-89", a, b, "Java"), ("CWE-22", a, b, "python"), ("Unknown", a, b, "c"), ("CWE-125", "", b, "c"), ("CWE-787", a, a, "c")]
    return spark.createDataFrame([(i + 1, "six", w, x, y, f"github.com/o/r/commit/{i}a", z) for i, (w, x, y, z) in enumerate(data)], ROW)


def test_cleaning(spark):
    out = clean.clean(six(spark)).orderBy("row_id").collect()
    assert [(r["row_id"], r["language"], r["cwe"]) for r in out] == [(1, "c/c++", "CWE-79"), (2, "java", "CWE-89")]
    got = [(r["name"], r["input"], r["output"]) for r in clean.funnel(six(spark)).orderBy("step").collect()]
    assert got == [("language_filter", 6, 5), ("cwe_filter", 5, 4), ("code_filter", 4, 2), ("url_filter", 2, 2), ("deduplicator", 2, 2)]
    assert clean.funnel(six(spark).limit(0)).count() == 0


@pytest.mark.parametrize(("step", "row", "kept"), [
    (clean.cwe_step(), {"cwe": "CWE-79|Unknown|CWE-89"}, False), (clean.cwe_step(), {"cwe": "|||"}, False), (clean.cwe_step(), {"cwe": "79"}, True),
    (clean.cwe_step(reject_unknown=False), {"cwe": "Unknown"}, True), (clean.cwe_step(reject_invalid=False), {"cwe": ""}, True),
    (clean.code_step(), {"code_before": "x" * 10, "code_after": "y" * 10}, True), (clean.code_step(), {"code_before": "x" * 9, "code_after": "y" * 10}, False),
    (clean.code_step(), {"code_before": " " + "x" * 12, "code_after": "x" * 12 + "\n"}, False), (clean.code_step(skip_empty=False), {"code_before": "", "code_after": "y" * 10}, False),
    (clean.code_step(False, False, 0), {"code_before": None, "code_after": ""}, True),
])
def test_steps(spark, step, row, kept):
    full = {"row_id": 1, "source": "s", "cwe": "CWE-1", "code_before": "a" * 20, "code_after": "b" * 20, "commit_url": "", "language": "c"} | row
    assert clean.clean(spark.createDataFrame([tuple(full.values())], ROW), (step,)).count() == int(kept)


def test_taxonomy(spark):
    nodes, pairs = taxonomy.flatten(spark, TREE)
    assert [(r["cwe"], r["cwd"]) for r in pairs.orderBy("ord").collect()] == [("CWE-79", "CWD-1001"), ("79", "CWD-1001"), ("CWE-89", "CWD-1002"), ("CWE-89", "CWD-1003"), ("CWE-22", "CWD-1004")]
    assert [(r["cwd"], r["level"], r["parent_cwd"]) for r in nodes.orderBy("ord").collect()] == [("CWD-1001", 2, None), ("CWD-1002", 2, None), ("CWD-1003", 3, "CWD-1002"), ("CWD-1004", 2, None)]
    rows = spark.createDataFrame([(1, ["CWE-89", "CWE-79", "CWE-999", "CWE-79"]), (2, ["CWE-999"]), (3, [])], "row_id long, cwes array<string>")
    out = [(r["cwd"], r["other_cwds"], r["primary_cwe"]) for r in taxonomy.with_cwds(rows, pairs).orderBy("row_id").collect()]
    assert out == [("CWD-1002", ["CWD-1001"], "CWE-89"), (None, [], "CWE-999"), (None, [], None)]
    assert taxonomy.target_ids(TREE) >= {"CWE-79", "CWE-89", "CWE-22"}
    counted = spark.createDataFrame([("CWD-1001",), ("CWD-1001",), ("CWD-9",), (None,)], "cwd string")
    assert tuple(taxonomy.progress_summary(nodes, counted).first()) == (4, 1, 2)
    assert [r["cwd"] for r in taxonomy.outside(nodes, counted).collect()] == ["CWD-9"]


def test_dedup(spark):
    lines = [("s", "A", 1, "CWE-5"), ("s", "A", 2, ""), ("s", "B", 1, "CWE-1"), ("t", "A", 3, "x"), ("t", "A", 4, "x"), ("", "A", 5, ""), ("", "B", 2, "")]
    df = spark.createDataFrame(lines, "signature string, dataset string, row long, cwe string")
    drops = lambda mode: sorted(map(tuple, dedup.drops(df, mode).collect()))
    assert drops("compat") == [("A", 1), ("B", 1), ("B", 2)] and drops("fixed") == [("A", 1), ("B", 1)]
    rows = six(spark).withColumn("source", F.expr("if(row_id < 4, 'A', 'B')"))
    kept = dedup.renumbered(dedup.without_drops(rows, spark.createDataFrame([("A", 2), ("B", 5)], "dataset string, row long")), block=2)
    assert sorted((r["source"], r["row_id"], r["kept_row"]) for r in kept.collect()) == [("A", 1, 1), ("A", 3, 2), ("B", 4, 1), ("B", 6, 2)]
    manifest = dedup.manifest(six(spark))
    assert manifest.first()["signature"] == "f() -> int" and dedup.checked_manifest(six(spark).withColumn("source", F.lit("six")), manifest).count() == 6
    with pytest.raises(Exception, match="no manifest line"):
        dedup.checked_manifest(six(spark), manifest.filter("row > 1")).collect()


def loop_quota(counts, n):
    """Quotas handed out one stratum after the other."""
    left, out = n, dict.fromkeys(counts, 0)
    for s in sorted(counts):
        share = min(left, max(1, int(n * (counts[s] / sum(counts.values())))))
        out[s] = min(share, counts[s])
        left -= share
        if left <= 0:
            break
    return out


def test_samples(spark):
    import random

    r = random.Random(2)
    data = [(i, f"g{r.randint(0, 2)}", f"s{r.choice('aaab')}{r.randint(0, 3)}", r.randint(0, 9)) for i in range(600)]
    rows = spark.createDataFrame(data, "row_id long, g string, source string, total_lines int").withColumn("vuln_lines", F.col("total_lines") % 4)
    for n in (1, 3, 40, 1000):
        got = Counter((x["g"], x["source"]) for x in sampling.stratified(rows, ["g"], "source", n).collect())
        for g in ("g0", "g1", "g2"):
            want = loop_quota(Counter(s for _, h, s, _ in data if h == g), n)
            assert {s: got[g, s] for s in want} == want
        for strategy in ("stratified", "balanced"):
            picked = Counter((x["g"], x["row_id"]) for x in sampling.select(rows, ["g"], n, strategy).collect())
            for g in ("g0", "g1", "g2"):
                mine = sorted(((t if strategy == "stratified" else t % 4), i) for i, h, _, t in data if h == g)
                step = len(mine) / n
                want = {i for _, i in mine} if len(mine) <= n else {mine[int(k * step + step / 2)][1] for k in range(n)}
                assert {i for h, i in picked if h == g} == want
        assert all(c <= n for c in Counter(x["g"] for x in sampling.select(rows, ["g"], n, "top").collect()).values())
    a, b = (sorted(x["row_id"] for x in sampling.random(d, ["g"], 5).collect()) for d in (rows, rows.repartition(7)))
    assert a == b and len(a) == 15
    with pytest.raises(ValueError, match="strategy"):
        sampling.select(rows, ["g"], 1, "nope")


def test_clusters(spark):
    import numpy as np

    r = np.random.default_rng(0)
    data = [(i, "g", f"s{i % 2}", (r.normal(0, 0.1, 4) + 5 * (i % 3)).tolist()) for i in range(90)] + [(200, "h", "s0", [0.0] * 4), (201, "h", "s1", None)]
    rows = spark.createDataFrame(data, "row_id long, g string, source string, embedding array<float>")
    picked = [x["row_id"] for x in cluster.representatives(rows, ["g"], 3).filter("g = 'g'").collect()]
    assert len(picked) == 3 and {i % 3 for i in picked} == {0, 1, 2}
    out = Counter(x["g"] for x in cluster.select(rows, ["g"], 3).collect())
    assert out == {"g": 3, "h": 2}
    calls = cluster.embed(spark.createDataFrame([("a",), ("b",), ("a",)], "text string"), lambda ts: [None if t == "b" else [1.0] for t in ts])
    assert sorted(x["embedding"] is None for x in calls.collect()) == [False, True]


def test_large_groups_are_clustered_as_a_whole(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(cluster, "SHARD", 20)
    r = np.random.default_rng(1)
    near = lambda i, k: (r.normal(0, 0.1, 4) + 9 * np.array([i % k, (i % k) ** 2 % 5, 0, 1])).tolist()
    data = [(i, "g", near(i, 10)) for i in range(300)] + [(1000 + i, "one", near(i, 3)) for i in range(20)] + [(2000 + i, "same", [1.0] * 4) for i in range(25)]
    rows = spark.createDataFrame(data, "row_id long, g string, embedding array<float>")
    picked = cluster.representatives(rows, ["g"], 10).collect()
    assert {x["row_id"] % 10 for x in picked if x["g"] == "g"} == set(range(10))
    assert {(x["row_id"] - 1000) % 3 for x in picked if x["g"] == "one"} == {0, 1, 2}
    assert [x["row_id"] for x in picked if x["g"] == "same"] == [2000]
    by = {x[0]: np.array(x[2], np.float32).astype(float) for x in data}
    for k in range(10):
        mine = [i for i in range(300) if i % 10 == k]
        middle = np.mean([by[i] for i in mine], 0)
        assert min(mine, key=lambda i: ((by[i] - middle) ** 2).sum()) in {x["row_id"] for x in picked}
    assert sorted(picked) == sorted(cluster.representatives(rows.repartition(7), ["g"], 10).collect())


def test_tiers(spark):
    at = lambda i: [50.0 * (i % 10), float(i % 3)]
    data = [(i, "large", at(i)) for i in range(120)] + [(200 + i, "small", at(i)) for i in range(99)] + [(400 + i, "missing", at(i) if i else None) for i in range(120)]
    data += [(600 + i, "ragged", at(i) if i else [1.0]) for i in range(120)] + [(800 + i, "nan", at(i) if i else [float("nan"), 1.0]) for i in range(120)] + [(1000 + i, "few", None) for i in range(7)]
    rows = spark.createDataFrame(data, "row_id long, g string, embedding array<float>")
    got = {}
    for x in cluster.tiered(rows, ["g"]).collect():
        got.setdefault(x["g"], set()).add(x["row_id"])
    assert {g: len(x) for g, x in got.items()} == {"large": 10, "small": 10, "missing": 10, "ragged": 10, "nan": 10, "few": 7}
    assert {i % 10 for i in got["large"]} == set(range(10))
    for g in ("small", "missing", "ragged", "nan"):
        assert got[g] == {x["row_id"] for x in sampling.random(rows.filter(f"g = '{g}'"), ["g"], 10).collect()}


def test_reviews_are_tried_again_on_errors(spark, tmp_path):
    folder = str(tmp_path)

    def generate(prompt: str) -> str:
        n = len(os.listdir(folder))
        open(f"{folder}/{n}", "w").close()
        if prompt == "never" or n < 2:
            raise ConnectionError("down")
        return '{"confidence": 1}'

    rows = spark.createDataFrame([(1, "CWE-1", "a", "b")], "row_id long, CWE string, vulnerable string, benign string")
    ask = lambda text: review.review(rows, generate, {s: text for s in review.STAGES}, tries=1, delay=0.01).collect()[0]["status"]
    assert ask("late") == "ok" and len(os.listdir(folder)) == 5
    assert ask("never") == "failed" and len(os.listdir(folder)) == 8


def test_counts_json_has_all_lines(spark, tmp_path):
    counts = spark.range(100_003).select(F.concat(F.lit("sé"), F.col("id") % 3).alias("source"), F.format_string("CWE-%06d", "id").alias("cwe"), F.col("id").alias("n"))
    for name, rows in (("all", counts), ("none", counts.filter("n < 0"))):
        sinks.counts_json(rows, str(tmp_path / name))
        want = {}
        for r in rows.orderBy("source", "cwe").collect():
            want.setdefault(r["source"], {})[r["cwe"]] = r["n"]
        assert (tmp_path / name).read_text(encoding="utf-8") == json.dumps(want, indent=2, ensure_ascii=False)


def test_entries_and_documents(spark, tmp_path):
    pairs = taxonomy.flatten(spark, TREE)[1]
    cleaned = clean.clean(six(spark))
    found = benchmark.entries(cleaned, pairs, with_hunks=True)
    rows = found.orderBy("row_id").collect()
    assert [(r["language"], r["cwd"], r["entry"]["CWE"]) for r in rows] == [("c/c++", "CWD-1001", "CWE-79"), ("java", "CWD-1002", "CWE-89")]
    assert rows[0]["entry"]["vulnerable_code"]["context"] == "int f() { return 1; } " and rows[0]["entry"]["commit_url"] == "https://github.com/o/r/commit/0a"
    assert rows[0]["entry"]["vulnerable_code"]["lines"] == [["int f() { return 1; } // old"]]
    document = json.loads(benchmark.nested(found).first()["document"])
    assert list(document) == ["c/c++", "java"] and document["java"]["CWD-1002"][0]["CVE"] is None and document["java"]["CWD-1002"][0]["other_CWEs"] == []
    back = benchmark.flattened(benchmark.nested(found)).orderBy("language").collect()
    assert [r["entry"] for r in back] == [r["entry"] for r in rows]
    own = spark.createDataFrame([('{"c": {"CWD-1": [{"language": "mine", "CWE": "CWE-1"}]}}',)], "document string")
    assert benchmark.flattened(own).first()["language"] == "mine" and benchmark.flattened(own, outer_wins=True).first()["language"] == "c"
    sinks.both_documents(found, str(tmp_path / "both"))
    sinks.yaml_export(found, str(tmp_path / "x.yaml"))
    sinks.samples(found, str(tmp_path / "samples"), "2024-01-01")
    assert spark.read.json(str(tmp_path / "samples")).first()["metadata"]["language"] == "c/c++" and os.path.getsize(tmp_path / "x.yaml") > 100
    assert sinks.human_size(1536) == "1.5 KB" and sinks.human_size(-1) == "Unknown"


def test_urls_and_cves(spark):
    rows, calls = six(spark), spark.sparkContext.accumulator(0)
    cache = spark.createDataFrame([("x/y", True, 200)], "repo_key string, valid boolean, status_code int")

    def check(key):
        calls.add(1)
        return 301

    known = benchmark.checked_urls(rows, cache, check)
    assert [tuple(r) for r in known.collect()] == [("o/r", True, 301)] and calls.value == 1
    assert benchmark.valid_urls(rows, known).count() == 6 and benchmark.valid_urls(rows, benchmark.checked_urls(rows, cache)).count() == 0
    fixes = spark.createDataFrame([("0a", "CVE-2"), ("0a", "CVE-1")], "hash string, cve_id string")
    assert benchmark.with_cve(rows, fixes).filter("CVE = 'CVE-1'").count() == 1


def write_csv(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["cwe", "code_before", "code_after", "commit_url", "language"], *rows])


def test_csv(spark, tmp_path):
    data = [['CWE-1', 'a "q", b\n\r\n\\ é', "x\ry", "", "c"], ["", "", "", "", ""], ["a", "b", "c", "d", "e"]]
    write_csv(str(tmp_path / "in" / "one.csv"), data)
    rows = files.canonical_csv(spark, str(tmp_path / "in"))
    got = rows.orderBy("row_id").collect()
    assert [[r[c] for c in ("cwe", "code_before", "code_after", "commit_url", "language")] for r in got] == data and [r["row_id"] for r in got] == [1, 2, 3] and got[0]["source"] == "one"
    sinks.canonical_csv(rows, str(tmp_path / "out"))
    again = files.canonical_csv(spark, str(tmp_path / "out"))
    assert Counter(tuple(r[:5]) for r in again.select("cwe", "code_before", "code_after", "commit_url", "language").collect()) == Counter(map(tuple, data))


def test_readers(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/MSR")
    with open(f"{root}/MSR/MSR_data_cleaned.csv", "w", newline="") as f:
        csv.writer(f).writerows([["func_before", "func_after", "CWE ID", "codeLink", "lang"], ["int a;\nx", "int b;", "CWE-079", "github.com/a", " C "], ["", "z", "", "", ""]])
    os.makedirs(f"{root}/megavul/megavul/v1/c_cpp")
    entry = {"cwe_ids": ["CWE-1", "", "cwe_1"], "commits": [{"git_url": None, "repo_name": "/o/r/", "commit_hash": "ab", "files": [{"language": "c", "vulnerable_functions": [{"func_before": "x", "func_after": "y"}, {"func_before": "", "func_after": "y"}]}, {"language": "c"}]}, {"git_url": "h"}]}
    json.dump([entry, {"cwe_ids": None}], open(f"{root}/megavul/megavul/v1/c_cpp/cve_with_graph_abstract_commit.json", "w"))
    os.makedirs(f"{root}/primevul")
    p = lambda target, name, func, idx: json.dumps({"project": "p", "commit_id": "1", "target": target, "file_name": name, "func": func, "idx": idx, "cwe": ["CWE-7"], "commit_url": "u"})
    for split, lines in {"train": [p(1, "b.c", "B", 2), p(1, "a.c", "A", 1), p(1, "c.c", "C", 3)], "valid": [p(0, "a.c", "A2", 4), "", p(0, "b.c", " B ", 5)], "test": []}.items():
        with open(f"{root}/primevul/primevul_{split}_paired.jsonl", "w") as f:
            f.write("\n".join(lines))
    for split in ("train", "val"):
        os.makedirs(f"{root}/sven/data_train_val/{split}")
        with open(f"{root}/sven/data_train_val/{split}/cwe-1.jsonl", "w") as f:
            f.write(json.dumps({"func_src_before": "a", "func_src_after": "b", "vul_type": "cwe-022", "commit_link": "l", "file_name": "x.py"}) + "\n")
    os.makedirs(f"{root}/juliet")
    table = pa.table({"filename": ["CWE15_x.c", "y"], "good": ["a\r\nb", ""], "bad": [b"c\rd", b"e"]})
    for name, open_ in (("train", pa.ipc.new_file), ("test", pa.ipc.new_stream)):
        with pa.OSFile(f"{root}/juliet/juliet_test_suite_c_1_3-{name}.arrow", "wb") as sink, open_(sink, table.schema) as writer:
            writer.write_table(table)
    os.makedirs(f"{root}/JaConTeBe/docs")
    html = "<table><TR><td>SIR name</td><td>l</td><td>c</td><td>x</td></TR><tr><td>s1</td><td>l<br>&amp;</td><td> Race\n</td><td>x</td></tr><tr><td>few</td></tr><tr><td>s2</td><td>m</td><td>odd</td><td>x</td></tr></table>"
    open(f"{root}/JaConTeBe/docs/bugList.html", "wb").write(html.encode("gb2312"))
    os.makedirs(f"{root}/JaConTeBe/versions.alt/s1/orig/d")
    open(f"{root}/JaConTeBe/versions.alt/s1/orig/d/A.java", "wb").write("class A { } // é".encode("latin-1"))
    os.makedirs(f"{root}/cvefixes/CVEfixes_v1.0.8/Data")
    dump = ["INSERT INTO fixes VALUES('CVE-1','h1','https://github.com/o/r/');", "INSERT INTO fixes VALUES('CVE-2','h1','https://github.com/o/r');", "INSERT INTO cwe_classification VALUES('CVE-1','CWE-9');", "INSERT INTO cwe_classification VALUES('CVE-2','CWE-119');", "INSERT INTO cve VALUES('CVE-1','d','d','[{''lang'': ''en'', ''value'': ''text''}]');"]
    dump += ["INSERT INTO file_change VALUES('1','h1','f.c','o','n','t','d','d','1','int b;','int a;','1','1','C','1');", "INSERT INTO file_change VALUES('2','h1','g.py','o','n','t','d','d','1','b','a','1','1','Python','1');"]
    with gzip.open(f"{root}/cvefixes/CVEfixes_v1.0.8/Data/x.sql.gz", "wt") as f:
        f.write("\n".join(dump))
    os.makedirs(f"{root}/cvefixes/CVEfixes_v1.0.7/Data")
    with gzip.open(f"{root}/cvefixes/CVEfixes_v1.0.7/Data/x.sql.gz", "wt") as f:
        f.write("\n".join(x.replace("int a;", "int old;") for x in dump))
    rows, errors = datasets.normalize_all(spark, root, f"{root}/canonical")
    assert not errors
    got = {}
    for r in rows.collect():
        got.setdefault(r["source"], []).append((r["cwe"], r["code_before"], r["code_after"], r["commit_url"], r["language"]))
    assert got["msr"] == [("CWE-79", "int a;\nx", "int b;", "https://github.com/a", "C")]
    assert got["megavul"] == [("CWE-1|CWE-1", "x", "y", "https://github.com/o/r/commit/ab", "c")]
    assert got["primevul"] == [("CWE-7", "A", "A2", "https://u", "c")]
    assert got["sven"] == [("CWE-22", "a", "b", "https://l", "python")] * 2
    assert got["juliet"] == [("CWE-15", "c\nd", "a\nb", "", "c")] * 2
    assert got["jacontebe"] == [("CWE-362", "class A { } // é", "", "https://l &", "java")]
    assert got["cvefixes"] == [("CWE-119|CWE-9", "int a;", "int b;", "https://github.com/o/r/commit/h1", "c")]
    path = datasets.newest_dump(spark, f"{root}/cvefixes")
    assert path.endswith("CVEfixes_v1.0.8/Data/*.sql.gz")
    open(f"{root}/sven/data_train_val/val/cwe-1.jsonl", "w").write("x")
    open(f"{root}/juliet/juliet_test_suite_c_1_3-test.arrow", "wb").write(b"damaged")
    some, errors = datasets.normalize_all(spark, root, f"{root}/again", ["juliet", "msr", "primevul", "megavul"], 1)
    assert set(errors) == {"juliet"} and {r["source"]: r["count"] for r in some.groupBy("source").count().collect()} == {"msr": 1, "primevul": 1, "megavul": 1}
    assert Counter(map(tuple, datasets.dump_fixes(spark, path).collect())) == Counter([("h1", "CVE-1"), ("h1", "CVE-2")])
    assert datasets.dump_descriptions(spark, path).first()["description"] == "[{'lang': 'en', 'value': 'text'}]"
    assert {r["cwe"]: r["n"] for r in files.dump_cwe_tally(spark, path).collect()} == {"CWE-9": 1, "CWE-119": 1}
    assert datasets.newest_version(["CVEfixes_v1.0.8", "CVEfixes_v1.0.10", "x"]) == "CVEfixes_v1.0.10"
    with pytest.raises(ValueError, match="unknown dataset"):
        datasets.normalize(spark, "nope", root)
    listed = spark.createDataFrame([("a",), ("b",)], "subject string")
    assert {tuple(r) for r in datasets.unmatched_subjects(listed, spark.createDataFrame([("b",), ("c",)], "subject string"))
            .collect()} == {("a", "no sources"), ("c", "not listed")}


def test_pair_files(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/c")
    for name, body in {"bad_1_0": "x", "good_1_0": "y", "bad_2_0": "only"}.items():
        open(f"{root}/c/{name}", "w").write(body)
    json.dump([{"cwe": "CWE-5", "url": "u", "files": [{"database_name": n} for n in ("bad_1_0", "good_1_0", "bad_2_0", "none", None)]}], open(f"{root}/metadata.json", "w"))
    assert [tuple(r) for r in datasets.crossvul(spark, root).collect()] == [("CWE-5", "x", "y", "https://u", "c")]


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "x.jsonl")
    open(path, "w").write('{"a": 1}\n\nbroken\n{"a": 2}\n')
    assert tuple(files.bad_json_lines(spark, path).first()) == (3, 1)
    assert sorted(r["a"] for r in files.json_lines(spark, path, "a long", strict=False).collect()) == [1, 2]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.json_lines(spark, path, "a long").collect()


def test_reviews(spark):
    rows = spark.createDataFrame([(1, "CWE-1", "a", "b"), (2, "CWE-2", "bad", "b")], "row_id long, CWE string, vulnerable string, benign string")

    def generate(prompt):
        if "bad" in prompt:
            raise RuntimeError("down")
        return 'Sure: ```json\n{"summary": "CWE-1", "severity": "HIGH"}\n```'

    out = review.review(rows, generate, {s: "{code_before} {diff}" for s in review.STAGES}).orderBy("row_id").collect()
    assert [r["status"] for r in out] == ["ok", "failed"] and json.loads(out[0]["review"])["fix_analysis"]["severity"] == "HIGH" and out[1]["confidence"] == 0.0
    done = spark.createDataFrame([(1,)], "row_id long")
    assert [r["row_id"] for r in review.pending(rows, done).collect()] == [2]


def test_pipeline_and_commands(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/raw/sven/data_train_val/train")
    os.makedirs(f"{root}/raw/sven/data_train_val/val")
    for split in ("train", "val"):
        with open(f"{root}/raw/sven/data_train_val/{split}/cwe-1.jsonl", "w") as f:
            for i in range(3):
                f.write(json.dumps({"func_src_before": f"int f{i}() {{ return {i}; }}", "func_src_after": f"int f{i}() {{ return -{i}1; }}", "vul_type": "CWE-22", "commit_link": "l", "file_name": "x.c" if i else "x.py"}) + "\n")
    json.dump(TREE, open(f"{root}/tree.json", "w"))
    open(f"{root}/run.yaml", "w").write(f"datasets: [sven]\nclean:\n  min_length: 5\ntransform:\n  max_per_group: 3\nsource: {root}/raw\nout: {root}/out\ntaxonomy: {root}/tree.json\n")
    config = pipeline.Config.from_yaml(f"{root}/run.yaml")
    assert config.min_length == 5 and config.max_per_group == 3
    open(f"{root}/bad.yaml", "w").write("clean:\n  min_lenght: 5\n")
    with pytest.raises(ValueError, match="min_lenght"):
        pipeline.Config.from_yaml(f"{root}/bad.yaml")
    for wrong in ({"url_validation": True}, {"cluster_method": "kmeans"}, {"cluster_method": "x"}, {"dedup": "x"}):
        with pytest.raises(ValueError, match="url_cache|embeddings|cluster_method|dedup"):
            pipeline.Config(**wrong).check()
    assert [tuple(r) for r in pipeline.run(spark, config).collect()] == [("c/c++", "CWD-1004", 3)]
    assert os.path.isdir(f"{root}/out/benchmark") and os.path.isdir(f"{root}/out/samples")
    with pytest.raises(RuntimeError, match="no dataset"):
        pipeline.normalize(spark, pipeline.Config(source=f"{root}/none", out=f"{root}/none"))
    asked = cli.parser().parse_args(["clean", "--set", "dedup=fixed", "min_length=3", "taxonomy=a=b"])
    assert asked.set == [("dedup", "fixed"), ("min_length", 3), ("taxonomy", "a=b")]
    assert cli.number(0, 1, float)("0.5") == 0.5
    for text in ("2", "x", "-1"):
        with pytest.raises(argparse.ArgumentTypeError):
            cli.number(0, 1)(text)
    assert cli.parser().parse_args(["clean", "--limit", "3"]).limit == 3
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["clean", "--limit", "0"])


def test_pipeline_with_cves_addresses_and_clusters(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/raw/sven/data_train_val/train")
    os.makedirs(f"{root}/raw/sven/data_train_val/val")
    entry = lambda i, repo: json.dumps({"func_src_before": f"int f{i}() {{ return {i}; }}", "func_src_after": f"int f{i}() {{ return -{i}1; }}", "vul_type": "CWE-22", "commit_link": f"https://github.com/o/{repo}/commit/a{i}", "file_name": "x.c"})
    with open(f"{root}/raw/sven/data_train_val/train/cwe-1.jsonl", "w") as f:
        f.write("\n".join([entry(i, "good") for i in range(6)] + [entry(6, "gone"), entry(7, "asked")]))
    open(f"{root}/raw/sven/data_train_val/val/cwe-1.jsonl", "w").close()
    with gzip.open(f"{root}/dump.sql.gz", "wt") as f:
        f.write("INSERT INTO fixes VALUES('CVE-9','a1','r');\nINSERT INTO cve VALUES('CVE-9','d','d','[{''lang'': ''en'', ''value'': ''what went wrong''}]');\n")
    json.dump(TREE, open(f"{root}/tree.json", "w"))
    os.makedirs(f"{root}/cache")
    open(f"{root}/cache/a.json", "w").write(json.dumps({"repo_key": "o/good", "valid": True, "status_code": 200}) + "\n")
    calls = str(tmp_path / "calls")
    os.makedirs(calls)

    def ask(key):
        open(f"{calls}/{key.replace('/', '-')}", "w").close()
        return 200 if key == "o/asked" else 404

    config = pipeline.Config(source=f"{root}/raw", out=f"{root}/out", taxonomy=f"{root}/tree.json", datasets=["sven"], url_validation=True, url_cache=f"{root}/cache", cvefixes_dump=f"{root}/dump.sql.gz")
    pipeline.run(spark, config, ask)
    found = spark.read.parquet(f"{root}/out/entries")
    assert found.count() == 7 and not found.filter("entry.commit_url like '%gone%'").count()
    assert [(r[0], r[1]) for r in found.filter("entry.CVE is not null").select("entry.CVE", "entry.review_message").collect()] == [("CVE-9", "what went wrong")]
    assert sorted(os.listdir(calls)) == ["o-asked", "o-gone"]
    assert {(r["repo_key"], r["valid"]) for r in spark.read.json(f"{root}/cache").collect()} == {("o/good", True), ("o/asked", True), ("o/gone", False)}
    rows = spark.read.parquet(f"{root}/out/canonical")
    rows.select("source", "row_id", F.array(F.when(F.col("code_before").rlike("return [0-3]"), 0.0).otherwise(9.0), F.lit(1.0)).cast("array<float>").alias("embedding")).write.parquet(f"{root}/vectors")
    config.cluster_method, config.embeddings, config.max_per_group = "kmeans", f"{root}/vectors", 2
    pipeline.run(spark, config)
    picked = [r[0] for r in spark.read.parquet(f"{root}/out/entries").select("entry.vulnerable_code.context").collect()]
    assert len(picked) == 2 and len({bool(re.search("return [0-3]", x)) for x in picked}) == 2


def test_optimized_entries_are_written_back(spark, tmp_path):
    side = lambda y: {"func": f"def f():\n    x = 1\n    y = {y}\n    z = x + y", "language": "python"}
    entry = {"vulnerable_code": side(2), "benign_code": side(3), "other_data": "some_value"}
    plain = {"vulnerable_code": "a\nb", "benign_code": "a\nc", "n": [1, {"k": None}]}
    lines = [json.dumps(entry), "", "{broken", "[1]", json.dumps(plain), json.dumps({"vulnerable_code": "only", "benign_code": None})]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    assert review.optimize_files(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out")) == 2
    got = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    first = next(x for x in got if "other_data" in x)
    assert first["_optimization"]["enabled"] and ">>>    3 |     y = 2" in first["vulnerable_code"]["context"] and ">>>    3 |     y = 3" in first["benign_code"]["context"]
    assert first["vulnerable_code"]["_original_size"] == len(side(2)["func"]) * 2 and first["vulnerable_code"]["language"] == "python" and first["other_data"] == "some_value"
    second = next(x for x in got if "n" in x)
    assert second["n"] == plain["n"] and second["vulnerable_code"] == "       1 | a\n>>>    2 | b" and {"vulnerable_code": "only", "benign_code": None} in got
    rows = spark.createDataFrame([(entry["vulnerable_code"], entry["benign_code"], 7), ({"func": "x", "language": "c"}, None, 8)], "vulnerable_code struct<func:string,language:string>, benign_code struct<func:string,language:string>, more int")
    out = {r["more"]: r for r in review.optimized_entries(rows).collect()}
    assert out[7]["vulnerable_code"]["context"] == first["vulnerable_code"]["context"] and out[7]["_optimization"]["original_size"] == first["_optimization"]["original_size"]
    assert out[8]["_optimization"] is None and out[8]["vulnerable_code"]["func"] == "x" and out[8]["vulnerable_code"]["context"] is None


def test_clients_with_a_backup():
    seen = []

    def down(prompt):
        seen.append("down")
        raise ConnectionError("down")

    assert review.client(down, lambda p: seen.append("up") or p + "!", attempts=2, delay=0.0)("a") == "a!" and seen == ["down", "down", "up"]
    with pytest.raises(ConnectionError):
        review.client(down, down, attempts=1, delay=0.0)("a")


def test_review_counters(spark):
    rows = spark.createDataFrame([(i, "CWE-1", "a" if i else "bad", "b") for i in range(4)], "row_id long, CWE string, vulnerable string, benign string")

    def generate(prompt):
        if "bad" in prompt:
            raise RuntimeError("down")
        return '{"summary": "x"}'

    left = review.pending(rows, rows.filter("row_id = 3").select("row_id"))
    out = review.review(left, generate, {s: "{code_before}" for s in review.STAGES}, limit=2, attempts=2, delay=0.0)
    assert {(r["row_id"], r["status"], r["calls"], r["regenerations"]) for r in out.collect()} == {(0, "failed", 2, 0), (1, "ok", 6, 1)}
    assert tuple(review.review_stats(rows, out).first()) == (4, 2, 8, 1, 1)
    report = review.quality_report(out).filter("metric = 'low_confidence'").orderBy("value").collect()
    assert [r["value"] for r in report] == ["0", "1"]


def test_merged_documents(spark):
    first = spark.createDataFrame([('{"c": {"A": [{"n": 1}, {"n": 2}]}, "java": {"B": [{"n": 3}]}}',)], "document string")
    second = spark.createDataFrame([('{"c": {"A": [{"n": 4, "x": [1]}], "C": [{"n": 5}]}}',)], "document string")
    got = [tuple(r) for r in benchmark.merged(first, second).orderBy("language", "key", "pos").collect()]
    assert got == [("c", "A", 0, '{"n":1}'), ("c", "A", 1, '{"n":2}'), ("c", "A", 2, '{"n":4,"x":[1]}'), ("c", "C", 0, '{"n":5}'), ("java", "B", 0, '{"n":3}')]


def test_numbers_within_groups(spark):
    import random

    r = random.Random(3)
    data = [(i, r.choice(["a", "b", None]), r.choice([1, 2, 3, None])) for i in r.sample(range(5000), 300)]
    rows = spark.createDataFrame(data, "row_id long, g string, by int")
    for block in (1, 64, 1 << 20):
        got = {x["row_id"]: (x["at"], x["of"]) for x in sampling.numbered(rows, ["g"], "by", block=block).collect()}
        for g in ("a", "b", None):
            mine = sorted((x for x in data if x[1] == g), key=lambda x: (x[2] is not None, x[2] or 0, x[0]))
            assert [got[x[0]] for x in mine] == [(i, len(mine)) for i in range(len(mine))]


def test_spot_check(spark):
    checked = sampling.spot_check(spark.range(100).withColumnRenamed("id", "row_id"), F.col("row_id") % 4 == 0, 60)
    assert checked.count() == 60 and tuple(sampling.tally(checked).first())[0] == 60 and sampling.tally(checked).first()["passed"] == checked.filter("row_id % 4 = 0").count()


def test_classes_of_many_ids(spark, monkeypatch):
    pairs = taxonomy.flatten(spark, TREE)[1]
    rows = spark.createDataFrame([(1, ["CWE-79", "CWE-89", "CWE-22", "CWE-9"]), (2, []), (3, ["Unknown", "CWE-22"]), (4, ["CWE-22", "CWE-22"]), (5, ["CWE-9"])], "row_id long, cwes array<string>")
    want = sorted(map(str, taxonomy.with_cwds(rows, pairs).collect()))
    monkeypatch.setattr(taxonomy, "FEW", 0)
    assert sorted(map(str, taxonomy.with_cwds(rows, pairs).collect())) == want


def test_statistics(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, None), (5, ""), (6, "Unknown"), (7, "b"), (8, "c")], "row_id long, cwe string")
    got = stats.statistics(rows).first()
    assert tuple(got)[:4] == (8, 5, 3, 5) and [tuple(x) for x in got["most_common"]] == [("b", 2), ("a", 2), ("", 2), ("Unknown", 1), ("c", 1)]
    assert tuple(stats.statistics(rows.limit(0)).first())[:4] == (0, 0, 0, 0)


def test_stream(spark, tmp_path):
    rows = six(spark).withColumn("arrived", F.lit("2024-01-01").cast("timestamp"))
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for _ in range(2):
        rows.write.mode("append").parquet(folder)
        ingest.run_available(spark, folder, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 1
