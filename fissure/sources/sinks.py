"""Writers."""

from __future__ import annotations

import bisect
import itertools
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fissure.operators import benchmark, sampling
from fissure.session import shared
from fissure.sources import ranges, stores


def parquet(rows: DataFrame, path: str) -> None:
    """Canonical rows by source, so that excluding a source prunes its files."""
    rows.write.mode("overwrite").partitionBy("source").parquet(path)


def canonical_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header, minimal quotes and CRLF between rows; line ends inside fields stay as they are.

    Spark's own writer turns inner line feeds into its line separator, so the lines are built here. The first row of each file carries the header.
    """
    columns = ["cwe", "code_before", "code_after", "commit_url", "language"]

    def field(name: str):
        value = F.coalesce(F.col(name), F.lit(""))
        return F.when(value.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)

    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.concat(F.when(first, ",".join(columns) + "\r\n").otherwise(""), F.concat_ws(",", *map(field, columns)))
    rows.select(line.alias("value")).write.mode("overwrite").text(path, lineSep="\r\n")


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def document(entries: DataFrame, path: str, key: str = "cwd") -> None:
    """The nested document ``{language: {key: [entries]}}`` as one file of any size, an entry a line, keys in order, entries by row number.

    Spark sorts and writes the lines in parts, each with what opens and closes groups before it; the parts are then joined, stream to stream, and the file appears under its name when it is whole. ``document_entries`` reads it in ranges.
    """
    spark = entries.sparkSession
    lines = benchmark.group_lines(entries, key)
    # a row for each group, of which there are languages times classes
    groups = lines.filter("pos = 0").select("language", key)
    order = Window.orderBy("language", key)
    name = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("k"))), r'^\{"k":(.*)\}$', 1)
    inner = F.concat(name(key), F.lit(": [\n"))
    opened = F.when(F.row_number().over(order) == 1, F.concat(F.lit("{"), name("language"), F.lit(": {"), inner)).when(F.lag("language").over(order) == F.col("language"), F.concat(F.lit("], "), inner)).otherwise(F.concat(F.lit("]}, "), name("language"), F.lit(": {"), inner))
    groups = groups.select("language", key, opened.alias("opened"))
    first = F.col("pos") == 0
    text = F.concat(F.when(first, F.col("opened")).otherwise(""), F.col("line"), F.when(F.col("pos") + 1 < F.col("of"), ",").otherwise(""))
    sized = lines.join(groups.withColumn("pos", F.lit(0)), ["language", key, "pos"], "left").join(lines.groupBy("language", key).agg(F.count("*").alias("of")), ["language", key])
    folder = shared(spark, "document")
    sized.orderBy("language", key, "pos").select(text.alias("value")).write.text(folder)
    empty = spark.read.text(folder).isEmpty()
    with stores.writing(spark, path) as file:
        if not empty:
            stores.joined(spark, file, folder)
        file.write("{}\n" if empty else "]}}\n")


def document_entries(spark: SparkSession, path: str, key: str = "cwd") -> DataFrame:
    """(language, key, pos, line) of a file that ``document`` wrote, read in ranges."""
    found, _, _ = ranges.records(spark, path, ranges.Lines())
    opens = found.filter(F.endswith("record", F.lit(": [\n"))).select("number", "record").orderBy("number").collect()
    # a line for each group
    starts, names, language = [], [], None
    for r in opens:
        text = r["record"].lstrip("{]}, ") if not r["record"].startswith("{") else r["record"][1:]
        found_names, at = [], 0
        while len(found_names) < 2 and at < len(text) and text[at] == '"':
            value, end = json.JSONDecoder().raw_decode(text, at)
            found_names.append(value)
            at = end + 3 if text[end : end + 3] == ": {" else len(text)
        language = found_names[0] if len(found_names) == 2 else language
        starts.append(r["number"])
        names.append((language, found_names[-1]))

    def run(batches):
        for batch in batches:
            out = []
            for number, record in zip(batch.column("number").to_pylist(), batch.column("record").to_pylist(), strict=True):
                at = bisect.bisect_right(starts, number) - 1
                if at >= 0 and number != starts[at] and record.startswith("{"):
                    out.append((*names[at], number - starts[at] - 1, record.rstrip("\n").removesuffix(",")))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)], names=["language", key, "pos", "line"])

    return found.select("number", "record").mapInArrow(run, f"language string, {key} string, pos int, line string")


def both_documents(entries: DataFrame, path: str) -> None:
    """By class and by id, from one cached table of entries."""
    entries = entries.withColumn("cwe", F.col("entry.CWE")).persist()
    document(entries.filter("cwd is not null"), f"{path}/by_cwd", "cwd")
    document(entries, f"{path}/by_cwe", "cwe")
    entries.unpersist()


def samples(entries: DataFrame, path: str, now: str) -> None:
    """One entry per source with its language and a stamp that the caller gives."""
    picked = sampling.one_per_source(entries.withColumn("pos", F.col("row_id")))
    out = picked.select("source", F.struct(F.col("source").alias("dataset"), "language", "cwd", F.lit(now).alias("generated_at")).alias("metadata"), F.col("entry").alias("sample"))
    out.write.mode("overwrite").partitionBy("source").option("ignoreNullFields", "false").json(path)


def stats_csv(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").csv(path, header=True)


def counts_json(counts: DataFrame, path: str) -> None:
    """{source: {cwe: n}} of all lines of a report, written source by source."""
    lines = counts.orderBy("source", "cwe").select("source", "cwe", "n").toLocalIterator()
    with stores.writing(counts.sparkSession, path) as file:
        i = -1
        file.write("{")
        for i, (source, rows) in enumerate(itertools.groupby(lines, key=lambda r: r["source"])):
            body = json.dumps({source: {r["cwe"]: r["n"] for r in rows}}, indent=2, ensure_ascii=False)
            file.write(("," if i else "") + body[1:-2])
        file.write("\n}" if i >= 0 else "}")


def yaml_export(entries: DataFrame, path: str, per_group: int = 5) -> None:
    """Up to ``per_group`` samples per language and class as YAML: a report for people, gathered on the driver."""
    import yaml

    few = sampling.top(entries, ["language", "cwd"], per_group, [])
    groups: dict[str, dict[str, list]] = {}
    for row in few.orderBy("language", "cwd", "row_id").select("language", "cwd", F.to_json("entry", {"ignoreNullFields": "false"}).alias("e")).toLocalIterator():
        groups.setdefault(row["language"], {}).setdefault(row["cwd"], []).append(json.loads(row["e"]))
    out = [{"Language": language, "CWEs": [{"CWD Number": cwd, "samples": samples_} for cwd, samples_ in body.items()]} for language, body in groups.items()]
    with stores.writing(entries.sparkSession, path) as file:
        yaml.safe_dump(out, file, sort_keys=False, allow_unicode=True)


def markdown_report(report: DataFrame, path: str) -> None:
    """A quality report as Markdown; its lines are few by nature."""
    rows = report.orderBy("metric", "value").collect()
    lines = ["# Review quality", "", "| metric | value | n | figure |", "|-|-|-|-|", *[f"| {r['metric']} | {r['value']} | {r['n']} | {'' if r['x'] is None else r['x']} |" for r in rows]]
    with stores.writing(report.sparkSession, path) as file:
        file.write("\n".join(lines) + "\n")


def human_size(n: float) -> str:
    """Bytes in steps of 1024 with one decimal."""
    if n < 0:
        return "Unknown"
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{n:.1f} {unit}"
        n /= 1024
    return ""
