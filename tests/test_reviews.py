"""Reviews that go on where a lost run ended, and calls that run at the same time."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections import Counter

import pytest

from fissure.operators import review

SHAPE = "row_id long, CWE string, vulnerable string, benign string"
TEMPLATES = {review.STAGES[0]: "{code_before}", review.STAGES[1]: "{code_before}", review.STAGES[2]: "{code_before}"}
REPLY = '{"summary": "CWE-1", "severity": "HIGH"}'


def client(folder: str, wait: float = 0.0, dies_at: int | None = None):
    """A client that leaves a file for each call; it kills its process at a call while the file ``deadly`` is there."""

    def generate(prompt: str) -> str:
        if dies_at is not None and os.path.exists(f"{folder}/deadly") and len(os.listdir(folder)) > dies_at:
            os._exit(1)
        began = time.time()
        time.sleep(wait)
        with open(f"{folder}/{uuid.uuid4()}", "w") as file:
            json.dump([prompt, os.getpid(), began, time.time()], file)
        if prompt == "bad":
            raise RuntimeError("down")
        return REPLY

    return generate


def calls(folder: str) -> list[list]:
    return [json.load(open(f"{folder}/{n}")) for n in os.listdir(folder) if n != "deadly"]


def test_a_lost_run_is_resumed(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "out")
    os.mkdir(log)
    open(f"{log}/deadly", "w").close()
    rows = spark.createDataFrame([(i, "CWE-1", f"code {i % 40}", "b") for i in range(50)], SHAPE)
    run = lambda: review.review_saved(rows, client(log, dies_at=60), TEMPLATES, path, batch=2, tasks=2, delay=0.0)
    with pytest.raises(Exception):  # noqa: B017
        run()
    saved = {r["key"] for r in review.saved_reviews(spark, path).collect()}
    before = Counter(c[0] for c in calls(log))
    assert 5 < len(saved) < 40
    os.remove(f"{log}/deadly")
    out = run().collect()
    assert len(out) == 50 and {r["status"] for r in out} == {"ok"}
    after = Counter(c[0] for c in calls(log)) - before
    # 40 texts differ; those that were saved are not asked about again, and each other one in three stages
    assert sum(after.values()) == 3 * (40 - len(saved)) and set(after.values()) == {3}
    # a third run asks nothing
    assert run().count() == 50 and len(calls(log)) == sum(before.values()) + sum(after.values())


def test_failures_are_asked_about_again(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "out")
    os.mkdir(log)
    rows = spark.createDataFrame([(1, "CWE-1", "bad", "b"), (2, None, "good", None), (3, None, "good", None)], SHAPE)
    run = lambda generate: {r["row_id"]: r["status"] for r in review.review_saved(rows, generate, TEMPLATES, path, attempts=1, delay=0.0).collect()}
    assert run(client(log)) == {1: "failed", 2: "ok", 3: "ok"} and len(calls(log)) == 4
    assert run(lambda prompt: REPLY) == {1: "ok", 2: "ok", 3: "ok"} and len(calls(log)) == 4
    assert run(client(log)) == {1: "ok", 2: "ok", 3: "ok"} and len(calls(log)) == 4
    assert review.review_saved(rows.limit(0), client(log), TEMPLATES, str(tmp_path / "none")).count() == 0


def most_at_once(spans: list[tuple[float, float]]) -> int:
    marks = sorted([(a, 1) for a, _ in spans] + [(b, -1) for _, b in spans])
    now = most = 0
    for _, step in marks:
        now += step
        most = max(most, now)
    return most


@pytest.mark.parametrize("limit", [None, 30])
def test_calls_run_at_the_same_time(spark, tmp_path, limit):
    log = str(tmp_path)
    rows = spark.createDataFrame([(i, "CWE-1", f"code {i}", "b") for i in range(40)], SHAPE).coalesce(1)
    out = review.review(rows, client(log, wait=0.05), TEMPLATES, limit=limit, tries=1, delay=0.0, concurrency=5, tasks=3)
    assert out.rdd.getNumPartitions() == 3
    parts = out.rdd.glom().collect()
    assert [sorted(r["row_id"] for r in p) for p in parts] == [sorted(p) for p in ([r["row_id"] for r in p] for p in parts)]
    assert sorted(r["row_id"] for p in parts for r in p) == list(range(limit or 40))
    by_process: dict[int, list] = {}
    for _, process, began, ended in calls(log):
        by_process.setdefault(process, []).append((began, ended))
    assert len(by_process) >= 2 and 3 <= max(most_at_once(x) for x in by_process.values()) <= 5


def test_results_stay_in_the_order_of_rows(spark):
    def generate(prompt: str) -> str:
        time.sleep(0.02 if int(prompt) % 3 else 0.1)
        return REPLY

    rows = spark.createDataFrame([(i, "CWE-1", str(i), "b") for i in range(30)], SHAPE).coalesce(1)
    out = review.review(rows, generate, TEMPLATES, tries=1, delay=0.0, concurrency=8).collect()
    assert [r["row_id"] for r in out] == list(range(30))
