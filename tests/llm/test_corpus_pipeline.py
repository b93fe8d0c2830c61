"""The pipeline as a whole and stage by stage, on awkward rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tests.llm.conftest import COLUMNS, make_rows  # noqa: E402
from tests.llm.test_operators import WORD, brute_base, brute_counts, brute_fingerprint, linked  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(make_rows(), COLUMNS).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0, "x") for i in range(0, 70)], "doc_id long, quality int, toxic int, text string").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """What goes into and comes out of each stage."""
    out = []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_order_and_columns(stages):
    assert [s[0] for s in stages] == ["quality rules", "near dedup", "secret scan", "mixing", "bpe encoding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.schema == before.schema


def test_quality_stage(stages):
    _, before, after = stages[0]
    had, kept = bag(before), bag(after)
    at = before.columns.index("text")
    assert kept and not kept - had
    for row in had:
        c = brute_counts(row[at])
        if c[0] < 10 or 100 * c[4] > 20 * c[0]:
            assert row not in kept
        elif row in kept:
            assert kept[row] == had[row]


def test_near_dedup_stage(stages):
    _, before, after = stages[1]
    had, kept = bag(before), bag(after)
    at = before.columns.index("text")
    root = linked({brute_fingerprint(r[at]) for r in had})
    groups = Counter()
    for row, n in kept.items():
        assert row in had
        groups[root[brute_fingerprint(row[at])]] += n
    assert groups == Counter(set(root.values()))


def test_secret_stage(spark, stages, folder):
    _, before, after = stages[2]
    assert before.count() == after.count()
    text = {r["doc_id"]: r["text"] for r in after.collect()}
    for r in before.collect():
        if brute_base(r["text"] or ""):
            assert "[SECRET]" in text[r["doc_id"]]
    docs = spark.createDataFrame([make_rows()[16], make_rows()[20]], COLUMNS)
    out = {r["doc_id"]: r for r in corpus_pipeline.secret_scan(spark, docs, folder).collect()}
    assert "AKIA" not in out[16]["text"] and out[20]["text"] == make_rows()[20][1]


def test_mixing_stage(stages):
    _, before, after = stages[3]
    had, out = bag(before), bag(after)
    assert not set(out) - set(had) and all(n <= 3 * had[row] for row, n in out.items())
    at, source = before.columns.index("text"), before.columns.index("source")
    words = defaultdict(int)
    for row, n in had.items():
        words[row[source]] += n * len(WORD.findall(row[at] or ""))
    taken = defaultdict(int)
    for row, n in out.items():
        taken[row[source]] += n * len(WORD.findall(row[at] or ""))
    assert abs(sum(taken.values()) - sum(words.values())) <= 0.05 * sum(words.values())


def test_encoding_stage(stages):
    from tokenizers import Tokenizer

    from fissure.llm import bpe

    t = Tokenizer.from_file(bpe.default_vocabulary())
    _, before, after = stages[4]
    want = Counter((r["doc_id"], r["source"], tuple(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in before.collect())
    assert Counter((r["doc_id"], r["source"], tuple(r["ids"])) for r in after.collect()) == want


def test_run_is_the_stages(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder)
    assert bag(got.select("doc_id", "source", "n_tokens", "decoded")) == bag(stages[-1][2].select("doc_id", "source", "n_tokens", "decoded"))


def test_stages_on_an_empty_table(spark, folder, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_stages_on_one_hot_group(spark, folder):
    r = np.random.default_rng(1)
    text = " ".join(f"w{i}" for i in r.integers(0, 1000, 80))
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i in range(500)] + [(1000 + i, " ".join(f"x{i}y{j * j % 83}" for j in range(40)), "en", None, 3) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        if name == "near dedup":
            assert docs.filter(F.col("text") == text).count() == 1 and docs.count() == 21
