"""Review of entries by a language model that the caller provides."""

from __future__ import annotations

import json
import time
import uuid
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fissure.functions import code, diffs, replies, udfs
from fissure.functions.text import strip
from fissure.session import shared

STAGES = ("vulnerability_analysis", "fix_analysis", "code_review")
REVIEW = "review string, confidence double, status string, calls int, regenerations int"
SAVED = f"key string, {REVIEW}"


def cwe_info(rows: DataFrame, names: DataFrame, key: str = "CWE") -> DataFrame:
    """``rows`` with ``cwe_info``: the taxonomy's class of an id, else a pointer to the public definition.

    ``names``: (cwe, name, description, cwd, cwd_name), one row per id.
    """
    asked = F.upper(strip(F.coalesce(F.col(key), F.lit(""))))
    full = F.when(F.startswith(asked, F.lit("CWE-")) | (asked == ""), asked).otherwise(F.concat(F.lit("CWE-"), asked))
    rows = rows.withColumn("cwe_key", full).join(names.withColumnRenamed("cwe", "cwe_key"), "cwe_key", "left")
    number = F.substring_index(F.substring(F.col("cwe_key"), 5, 1000), "-", 1)
    none = F.col("cwe_key") == ""
    info = F.struct(
        F.when(none, "Unknown").otherwise(F.col("cwe_key")).alias("id"),
        F.when(none, "Unknown Weakness").otherwise(F.coalesce("name", F.concat(F.lit("CWE-"), number))).alias("name"),
        F.when(none, "No CWE information available").otherwise(F.coalesce("description", F.concat(F.lit("See https://cwe.mitre.org/data/definitions/"), number, F.lit(".html")))).alias("description"),
        F.col("cwd").alias("cwd_id"), "cwd_name",
    )
    return rows.withColumn("cwe_info", info).drop("cwe_key", "name", "description", "cwd", "cwd_name")


def prompt(template: str, **fields: Column) -> Column:
    """A template with ``{name}`` places filled in; a missing template gives the empty string."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def client(primary: Callable[[str], str], backup: Callable[[str], str] | None = None, attempts: int = 3, delay: float = 1.0, backup_delay: float | None = None) -> Callable[[str], str]:
    """A ``generate`` that asks ``primary`` up to ``attempts`` times, ``delay`` seconds apart, then twice as many, and then ``backup`` in the same way; the last error is raised."""

    def ask(prompt: str) -> str:
        error: Exception = RuntimeError("nothing to ask")
        for endpoint, wait in ((primary, delay), (backup, delay if backup_delay is None else backup_delay)):
            for attempt in range(attempts if endpoint else 0):
                if attempt:
                    time.sleep(wait * 2 ** (attempt - 1))
                try:
                    return endpoint(prompt)
                except Exception as e:  # noqa: BLE001  the endpoint is the caller's
                    error = e
        raise error

    return ask


def review(rows: DataFrame, generate: Callable[[str], str], templates: dict[str, str], *, limit: int | None = None, tries: int = 2, attempts: int = 3, delay: float = 1.0, version: str = "v1", now: str = "1970-01-01T00:00:00Z", concurrency: int = 1, tasks: int | None = None) -> DataFrame:
    """(row_id, review, confidence, status, calls, regenerations) of ``rows(row_id, CWE, vulnerable, benign)``, or of the first ``limit`` of them by row_id, in three stages each.

    ``generate(prompt)`` is called on the executors, up to ``attempts`` times where it raises an error, with ``delay`` seconds, then twice as many, in between. The last error, or a reply without
    JSON, gives a placeholder. A review below the confidence threshold is asked for again, ``tries`` times in all. ``now`` is the stamp of
    all reviews, so that reruns agree.

    Each task has up to ``concurrency`` rows under way at once, whose results it returns in the order of the rows; it reads at most twice as many ahead. ``tasks``: how many tasks share the rows, else as many as there are partitions,
    and with a ``limit`` as many as Spark runs at a time.
    """

    def one(row) -> tuple[str, float, str, int, int]:
        done: dict = {}
        calls = 0

        def counted(text: str) -> str:
            nonlocal calls
            calls += 1
            return generate(text)

        ask = client(counted, attempts=attempts, delay=delay)
        for turn in range(tries):
            try:
                # what no prompt asks for is not made
                values = {"code_before": lambda: row.vulnerable or "", "code_after": lambda: row.benign or "", "cwe": lambda: row.CWE or "", "diff": lambda: diffs.compact(row.vulnerable, row.benign), "previous": lambda: json.dumps(done)}
                for stage in STAGES:
                    text = templates.get(stage, "")
                    for name, value in values.items():
                        text = text.replace("{" + name + "}", value()) if "{" + name + "}" in text else text
                    reply = replies.parse_reply(ask(text))
                    if reply is None:
                        raise ValueError("no JSON in the reply")
                    done[stage] = json.loads(reply)
            except Exception as e:  # noqa: BLE001  the client is the caller's
                return json.dumps({"error": str(e), "metadata": {"generated_at": now, "prompt_version": version}}), 0.0, "failed", calls, turn
            score = replies.confidence(done, row.CWE)
            if score >= replies.REGENERATE_BELOW:
                break
        return json.dumps({**done, "metadata": {"generated_by": "model", "generated_at": now, "prompt_version": version, "confidence": score}}), score, "ok", calls, turn

    def run(frames):
        with ThreadPoolExecutor(concurrency) as pool:
            under_way, out = deque(), []
            for frame in frames:
                for row in frame.itertuples(index=False):
                    under_way.append((row.row_id, pool.submit(one, row)))
                    if len(under_way) > 2 * concurrency:
                        id_, result = under_way.popleft()
                        out.append((id_, *result.result()))
                if out:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            out = [(id_, *result.result()) for id_, result in under_way]
            if out:
                yield pd.DataFrame(out, columns=names)

    names = ["row_id", "review", "confidence", "status", "calls", "regenerations"]
    asked = rows.select("row_id", "CWE", "vulnerable", "benign")
    if limit is not None:
        asked = asked.orderBy("row_id").limit(limit)
        # the first rows come in one partition
        tasks = tasks or rows.sparkSession.sparkContext.defaultParallelism
    if tasks:
        asked = asked.repartition(tasks, "row_id")
    return asked.mapInPandas(run, f"row_id long, {REVIEW}")


def review_saved(rows: DataFrame, generate: Callable[[str], str], templates: dict[str, str], path: str, *, batch: int = 100, tasks: int = 8, **options) -> DataFrame:
    """``review`` of ``rows`` with results that are saved under ``path`` while the run goes on, so that a run that was lost goes on where it ended.

    Entries are known by ``cache_key``: equal ones are asked about once, and what ``path`` holds from runs before, failures apart, is not asked about again. The rest is laid out in files of up to ``batch`` entries; a stream takes ``tasks`` of them
    at a time and appends their reviews, which Spark commits as a whole. So what a lost run has to repeat is one such step, and what a lost task has to repeat is one file. (row_id, key, review, confidence, status, calls, regenerations)
    of all rows; ``calls`` are those that the saved review took.
    """
    spark = rows.sparkSession
    keyed = rows.select("row_id", "CWE", "vulnerable", "benign", cache_key(F.col("vulnerable"), F.col("benign"), F.col("CWE")).alias("key"))
    todo = keyed.groupBy("key").agg(F.min_by(F.struct("row_id", "CWE", "vulnerable", "benign"), "row_id").alias("r")).select("key", "r.*")
    todo = todo.join(saved_reviews(spark, path).filter("status = 'ok'").select("key"), "key", "left_anti")
    own = f"{path}/run-{uuid.uuid4()}"
    todo.write.option("maxRecordsPerFile", batch).parquet(f"{own}/rows")

    def step(part: DataFrame, number: int) -> None:
        part = part.persist()
        done = review(part, generate, templates, **options)
        done.join(part.select("row_id", "key"), "row_id").drop("row_id").write.mode("append").parquet(f"{own}/reviews")
        part.unpersist()

    shape = spark.read.parquet(f"{own}/rows").schema
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", tasks).parquet(f"{own}/rows")
    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{own}/progress").trigger(availableNow=True).start().awaitTermination()
    return keyed.select("row_id", "key").join(saved_reviews(spark, path), "key")


def saved_reviews(spark: SparkSession, path: str) -> DataFrame:
    """One review per key of those that all runs have saved under ``path``: one that went well, if there is any."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run-*/reviews")
    # by name, since Spark takes two reads of one folder for the same, whatever was added in between
    runs = sorted(x.getPath().toString() for x in place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or [])
    found = spark.read.schema(SAVED).parquet(*runs) if runs else spark.createDataFrame([], SAVED)
    columns = [c for c in found.columns if c != "key"]
    return found.groupBy("key").agg(F.min_by(F.struct(*columns), F.struct(F.col("status") != "ok", "review")).alias("r")).select("key", "r.*")


def review_stats(rows: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: the entries of ``rows``, those that were not asked about since they had a review, calls of the model, failures and regenerations."""
    done = reviews.agg(F.count("*").alias("asked"), F.coalesce(F.sum("calls"), F.lit(0)).alias("api_calls"), F.count_if(F.col("status") == "failed").alias("failures"), F.coalesce(F.sum("regenerations"), F.lit(0)).alias("regenerations"))
    return rows.agg(F.count("*").alias("total_processed")).crossJoin(done).select("total_processed", (F.col("total_processed") - F.col("asked")).alias("cache_hits"), "api_calls", "failures", "regenerations")


def pending(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows that have no review yet."""
    return rows.join(done.select("row_id"), "row_id", "left_anti")


def cache_key(vulnerable: Column, benign: Column, cwe: Column) -> Column:
    """The same for the same entry in every process."""
    return F.sha2(F.concat_ws("\x1f", F.coalesce(vulnerable, F.lit("")), F.coalesce(benign, F.lit("")), F.coalesce(cwe, F.lit(""))), 256)


def quality_report(reviews: DataFrame, low: float = 0.75) -> DataFrame:
    """(metric, value, n, x): average confidence, the number of reviews of low confidence, the 20 lowest by row number, and histograms of severity and fix quality."""
    # all parts are made of one table of a few short columns, so that no entry is reviewed again for each of them
    path = shared(reviews.sparkSession, "report")
    field = lambda path: F.coalesce(F.get_json_object("review", path), F.lit("UNKNOWN"))
    reviews.select("row_id", "confidence", field("$.vulnerability_analysis.severity").alias("severity"), field("$.fix_analysis.fix_quality").alias("fix_quality")).write.parquet(path)
    reviews = reviews.sparkSession.read.parquet(path)
    histogram = lambda name: reviews.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("x")).select(F.lit(name).alias("metric"), "value", "n", "x")
    mean = reviews.agg(F.count("*").alias("n"), F.bround(F.avg("confidence"), 3).alias("x")).select(F.lit("confidence").alias("metric"), F.lit("average").alias("value"), "n", "x")
    few = reviews.agg(F.count_if(F.col("confidence") < low).alias("n")).select(F.lit("confidence").alias("metric"), F.lit("low").alias("value"), "n", F.lit(low).alias("x"))
    lowest = low_confidence(reviews, low).select(F.lit("low_confidence").alias("metric"), F.col("row_id").cast("string").alias("value"), F.lit(1).cast("long").alias("n"), F.col("confidence").alias("x"))
    return mean.unionByName(few).unionByName(lowest).unionByName(histogram("severity")).unionByName(histogram("fix_quality"))


def low_confidence(reviews: DataFrame, low: float = 0.75, n: int = 20) -> DataFrame:
    return reviews.filter(F.col("confidence") < low).orderBy("confidence", "row_id").limit(n)


def optimize(rows: DataFrame) -> DataFrame:
    """``rows`` with ``opt``: both sides cut to their changes, for nested or plain code columns."""
    return rows.withColumn("opt", udfs.optimized(_code(rows, "vulnerable_code"), _code(rows, "benign_code")))


def _code(rows: DataFrame, name: str) -> Column:
    """A plain column, or the first of a nested one's fields context, func and code that is not empty."""
    kind = rows.schema[name].dataType
    if not isinstance(kind, T.StructType):
        return F.col(name)
    return code.first_field(*[F.col(f"{name}.{f}") for f in ("context", "func", "code") if f in kind.names] or [F.lit("")])


def optimized_entries(rows: DataFrame) -> DataFrame:
    """``rows`` whose code is replaced by its excerpt where it was cut, with ``_optimization``; nested sides keep their other fields and get ``_original_size``."""
    cut = optimize(rows)
    done = F.col("opt.optimized")

    def side(name: str) -> Column:
        kind = rows.schema[name].dataType
        if not isinstance(kind, T.StructType):
            return F.when(done, F.col(f"opt.{name}")).otherwise(F.col(name)).alias(name)
        before = F.col(f"{name}.context") if "context" in kind.names else F.lit(None).cast("string")
        new = F.col(name).withField("context", F.when(done, F.col(f"opt.{name}")).otherwise(before)).withField("_original_size", F.when(done, F.col("opt.original_size")))
        return new.alias(name)

    facts = F.when(done, F.struct(F.lit(True).alias("enabled"), F.col("opt.reduction_ratio").alias("reduction_ratio"), F.col("opt.original_size").alias("original_size"), F.col("opt.optimized_size").alias("optimized_size")))
    return cut.select(*[side(c) if c in ("vulnerable_code", "benign_code") else F.col(f"`{c}`") for c in rows.columns], facts.alias("_optimization"))


def optimize_files(spark: SparkSession, source: str, target: str) -> int:
    """Write the JSON lines of ``source`` with their entries optimized to ``target``, whatever other fields they have; the number of lines that are no JSON objects, which are left out."""
    lines = spark.read.text(source).filter("trim(value) <> ''").select(udfs.optimized_line("value").alias("value"))
    lines.filter("value is not null").write.mode("overwrite").text(target)
    return lines.filter("value is null").count()
