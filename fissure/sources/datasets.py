"""Readers of the raw datasets, each to canonical rows (cwe, code_before, code_after, commit_url, language)."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fissure.functions import cwe, languages, udfs, urls
from fissure.functions.text import squeeze, strip, text, unix_lines
from fissure.session import shared
from fissure.sources import files, ranges, sqlite, stores

#: Bug categories of the HTML list and their ids.
CATEGORIES = {"race": "CWE-362", "resource deadlock": "CWE-833", "wait-notify deadlock": "CWE-833", "inconsistent synchronization": "CWE-820"}
ALLOWED_CVEFIXES = ("c", "c++", "java")


def canonical(id_: Column, before: Column, after: Column, url: Column, language: Column) -> list[Column]:
    return [text(id_).alias("cwe"), text(before).alias("code_before"), text(after).alias("code_after"), text(url).alias("commit_url"), text(language).alias("language")]


def _both(before: str, after: str) -> Column:
    return (text(F.col(before)) != "") & (text(F.col(after)) != "")


def packed(ids: Column) -> Column:
    """Normalized ids of a list, in order, repeats included."""
    return F.array_join(F.filter(F.transform(ids, cwe.normalize), lambda x: x != ""), "|")


def cvefixes_join(changes: DataFrame, fixes: DataFrame, classes: DataFrame) -> DataFrame:
    """One row per changed file: its ids distinct and sorted; of several repositories the smallest address."""
    joined = changes.filter("programming_language is not null").join(fixes, "hash", "left").join(classes, "cve_id", "left")
    id_ = F.nullif(cwe.normalize(F.col("cwe_id")), F.lit(""))
    return joined.groupBy("hash", "filename", "code_before", "code_after").agg(F.min("repo_url").alias("repo_url"), F.min("programming_language").alias("programming_language"), F.array_join(F.array_sort(F.collect_set(id_)), "|").alias("cwes"))


def cvefixes(changes: DataFrame, fixes: DataFrame, classes: DataFrame) -> DataFrame:
    rows = cvefixes_join(changes, fixes, classes)
    rows = rows.withColumn("language", F.lower(strip(F.col("programming_language")))).filter(F.col("language").isin(*ALLOWED_CVEFIXES))
    rows = rows.withColumn("code_before", unix_lines(text(F.col("code_before")))).withColumn("code_after", unix_lines(text(F.col("code_after"))))
    rows = rows.filter(_both("code_before", "code_after")).filter(strip(F.col("code_before")) != strip(F.col("code_after")))
    return rows.select(canonical(F.col("cwes"), F.col("code_before"), F.col("code_after"), urls.commit_url(F.col("repo_url"), F.col("hash")), F.col("language")))


def cvefixes_dump(spark: SparkSession, path: str) -> DataFrame:
    """From a SQL dump whose tables begin with the columns used here."""
    get = lambda *names: [F.get("values", F.lit(i)).alias(n) for i, n in names]
    changes = files.dump_lines(spark, path, "file_change").select(get((1, "hash"), (2, "filename"), (9, "code_after"), (10, "code_before"), (13, "programming_language")))
    fixes = files.dump_lines(spark, path, "fixes").select(get((0, "cve_id"), (1, "hash"), (2, "repo_url")))
    classes = files.dump_lines(spark, path, "cwe_classification").select(get((0, "cve_id"), (1, "cwe_id")))
    return cvefixes(changes, fixes, classes)


def cvefixes_database(spark: SparkSession, path: str, ranges: int = 64, shipped: bool = False) -> DataFrame:
    """From the SQLite database, or the folder of several, that the project ships; each table is read in ranges of rows, and of it the columns used here."""
    get = lambda name, columns: sqlite.table(spark, path, name, columns, ranges, shipped)
    changes = get("file_change", "hash string, filename string, code_before string, code_after string, programming_language string")
    return cvefixes(changes, get("fixes", "cve_id string, hash string, repo_url string"), get("cwe_classification", "cve_id string, cwe_id string"))


def dump_fixes(spark: SparkSession, path: str) -> DataFrame:
    """(hash, cve_id) of a dump."""
    rows = files.dump_lines(spark, path, "fixes").select(F.get("values", F.lit(1)).alias("hash"), F.get("values", F.lit(0)).alias("cve_id"))
    return rows.filter("hash is not null and cve_id is not null").distinct()


def dump_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """(cve_id, description) of a dump."""
    rows = files.dump_lines(spark, path, "cve").select(F.get("values", F.lit(0)).alias("cve_id"), F.get("values", F.lit(3)).alias("description"))
    return rows.filter("cve_id is not null and description is not null")


def newest_version(names: list[str]) -> str | None:
    """The name with the largest version number, compared number by number."""
    found = [(tuple(map(int, m[1].split("."))), n) for n in names if (m := re.search(r"_v(\d+(?:\.\d+)*)", n))]
    return max(found)[1] if found else None


def newest_data(spark: SparkSession, root: str) -> str:
    """The data folder of the newest version under ``root``; of all, if none has a version in its name."""
    name = newest_version([x.getPath().getParent().getName() for x in stores.listed(spark, f"{root}/*/Data")])
    return f"{root}/{name or '*'}/Data"


def newest_dump(spark: SparkSession, root: str) -> str:
    return f"{newest_data(spark, root)}/*.sql.gz"


def cvefixes_newest(spark: SparkSession, root: str) -> DataFrame:
    """The newest version's database, or its dump where it has none."""
    database = f"{newest_data(spark, root)}/*.db"
    return cvefixes_database(spark, database) if stores.listed(spark, database) else cvefixes_dump(spark, newest_dump(spark, root))


def megavul(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    """From JSON arrays, which are read in ranges; entries, commits, files and functions are unfolded, missing lists give no rows. ``places``: with the column ``place``, by which rows are in their order."""
    shape = "cwe_ids array<string>, commits array<struct<git_url:string,repo_name:string,commit_hash:string,files:array<struct<language:string,vulnerable_functions:array<struct<func_before:string,func_after:string>>>>>>"
    rows = ranges.json_array(spark, path, shape)
    rows = rows.select("file", "number", "cwe_ids", F.posexplode("commits").alias("i", "c")).select("*", F.posexplode("c.files").alias("j", "f")).select("*", F.posexplode("f.vulnerable_functions").alias("k", "v"))
    rows = rows.select(F.struct("file", "number", "i", "j", "k").alias("place"), "cwe_ids", "c", "f.language", "v.func_before", "v.func_after").filter(_both("func_before", "func_after"))
    repo = F.regexp_replace(text(F.col("c.repo_name")), "^/+|/+$", "")
    base = F.when(repo.rlike("^https?://"), repo).otherwise(F.concat(F.lit("https://github.com/"), repo))
    built = F.when((repo == "") | (text(F.col("c.commit_hash")) == ""), "").otherwise(F.concat(base, F.lit("/commit/"), F.col("c.commit_hash")))
    url = urls.ensure_https(F.col("c.git_url"))
    return rows.select(*canonical(packed(F.filter("cwe_ids", lambda x: text(x) != "")), F.col("func_before"), F.col("func_after"), F.when(url != "", url).otherwise(built), F.col("language")), *(["place"] if places else []))


def msr(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    rows = ranges.csv_rows(spark, path, ["CWE ID", "func_before", "func_after", "codeLink", "lang"]).filter(_both("func_before", "func_after"))
    return rows.select(*canonical(cwe.normalize(F.col("`CWE ID`")), F.col("func_before"), F.col("func_after"), urls.ensure_https(F.col("codeLink")), strip(F.col("lang"))), *([F.struct("file", "number").alias("place")] if places else []))


def paired(records: DataFrame) -> DataFrame:
    """Pairs of vulnerable and fixed functions of a commit by their rank among (file, first line, index); what has no partner goes.

    ``records``: project, commit_id, target, file_name, func, idx and whatever is to be kept. Columns of the fixed side get the prefix ``after_``. Code is shuffled once: ranks and pairs are found where the rows of a commit lie.
    """
    first_line = F.coalesce(F.get(F.filter(F.transform(F.split(text(F.col("func")), r"\r\n|[\n\r\x0b\x0c]"), strip), lambda x: x != ""), F.lit(0)), F.lit(""))
    keyed = records.withColumn("project", text(F.col("project"))).withColumn("commit_id", text(F.col("commit_id"))).withColumn("side", F.coalesce(F.col("target") == 1, F.lit(False)))
    order = [text(F.col("file_name")), first_line, F.coalesce(strip(F.col("idx").cast("string")).try_cast("bigint"), F.lit(0)), F.col("func")]
    ranked = keyed.repartition("project", "commit_id").withColumn("rank", F.row_number().over(Window.partitionBy("project", "commit_id", "side").orderBy(*order)))
    key = ["project", "commit_id", "rank"]
    others = [c for c in records.columns if c not in key]
    # a rank has at most one row of each side
    of = lambda side, prefix: [F.first(F.when(side, F.col(f"`{c}`")), ignorenulls=True).alias(prefix + c) for c in others]
    both = (F.bool_or("side") & F.bool_or(~F.col("side"))).alias("both")
    return ranked.groupBy(*key).agg(*of(F.col("side"), ""), *of(~F.col("side"), "after_"), both).filter("both").drop("both")


def primevul(spark: SparkSession, paths: list[str]) -> DataFrame:
    shape = "project string, commit_id string, target int, file_name string, func string, idx string, cwe array<string>, commit_url string"
    rows = paired(spark.read.schema(shape).json(paths)).filter(strip(text(F.col("func"))) != strip(text(F.col("after_func"))))
    either = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"after_{c}"))
    return rows.select(canonical(packed(F.filter("cwe", lambda x: text(x) != "")), F.col("func"), F.col("after_func"), urls.ensure_https(either("commit_url")), languages.from_filename(either("file_name"))))


def sven(spark: SparkSession, paths: list[str]) -> DataFrame:
    shape = "func_src_before string, func_src_after string, vul_type string, commit_link string, file_name string"
    rows = spark.read.schema(shape).json(paths).filter(_both("func_src_before", "func_src_after"))
    return rows.select(canonical(cwe.normalize(F.col("vul_type")), F.col("func_src_before"), F.col("func_src_after"), urls.ensure_https(F.col("commit_link")), languages.from_filename(F.col("file_name"))))


def juliet(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = files.arrow_files(spark, paths, "filename string, good string, bad string").filter(_both("good", "bad"))
    return rows.select(canonical(cwe.normalize(F.col("filename")), unix_lines(F.col("bad")), unix_lines(F.col("good")), F.lit(""), F.lit("c")))


def bug_list(html: DataFrame) -> DataFrame:
    """(subject, cwe, link, category) of the rows of HTML tables ``html(text)``: four cells or more, without the header."""
    rows = html.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row")).withColumn("n", F.monotonically_increasing_id())
    cells = rows.select("n", F.posexplode(F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)).alias("i", "cell"))
    plain = cells.filter("i < 4").select("n", "i", squeeze(udfs.unescape(F.regexp_replace("cell", "<[^>]+>", " "))).alias("cell"))
    wide = plain.groupBy("n").agg(*[F.max(F.when(F.col("i") == i, F.col("cell"))).alias(c) for i, c in enumerate(("subject", "link", "category", "fourth"))]).filter("fourth is not null")
    folded = squeeze(F.replace(F.lower("category"), F.lit("windows only"), F.lit("")))
    return wide.filter((F.col("subject") != "") & (F.lower("subject") != "sir name")).select("subject", text(languages.lookup(folded, CATEGORIES)).alias("cwe"), urls.ensure_https(F.col("link")).alias("link"), "category")


def jacontebe(spark: SparkSession, root: str) -> DataFrame:
    """One row per Java file under ``versions.alt/<subject>/orig``, with the subject's id and link."""
    listed = bug_list(files.texts(spark, f"{root}/docs/bugList.html", "GB2312"))
    sources = files.texts(spark, f"{root}/versions.alt/*/orig").filter(F.col("path").rlike(r"\.java$")).withColumn("subject", F.regexp_extract("path", r"versions\.alt/([^/]+)/orig/", 1))
    return sources.join(listed, "subject").select(canonical(F.col("cwe"), F.col("text"), F.lit(""), F.col("link"), F.lit("java")))


def unmatched_subjects(listed: DataFrame, available: DataFrame) -> DataFrame:
    """(subject, problem): listed without sources, or with sources but not listed."""
    a = listed.select("subject").distinct().join(available.select("subject"), "subject", "left_anti").select("subject", F.lit("no sources").alias("problem"))
    return a.unionByName(available.select("subject").distinct().join(listed.select("subject"), "subject", "left_anti").select("subject", F.lit("not listed").alias("problem")))


def file_pairs(records: DataFrame, snippets: DataFrame) -> DataFrame:
    """``bad_x`` with ``good_x`` of the same record: one row per pair that has both sides.

    ``records(record, ord, name, ...)``, ``snippets(name, text, folder)``. Of several files of a side the last counts.
    """
    found = records.join(snippets, "name").withColumn("suffix", F.when(F.col("name").contains("_"), F.regexp_replace("name", "^[^_]*_", "")).otherwise(F.col("name")))
    side = lambda p: F.max_by(F.when(F.startswith("name", F.lit(p)), F.col("text")), F.when(F.startswith("name", F.lit(p)), F.col("ord")))
    return found.groupBy("record", "suffix").agg(side("bad").alias("code_before"), side("good").alias("code_after"), F.min_by("folder", "ord").alias("language")).filter(_both("code_before", "code_after"))


def crossvul(spark: SparkSession, root: str) -> DataFrame:
    meta = spark.read.schema("cwe string, url string, files array<struct<database_name:string>>").json(f"{root}/metadata.json", multiLine=True).withColumn("record", F.monotonically_increasing_id())
    names = meta.select("record", F.posexplode("files").alias("ord", "f")).select("record", "ord", F.col("f.database_name").alias("name"))
    snippets = files.texts(spark, root).withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1)).filter(F.col("name").rlike("^(bad|good)_")).withColumn("folder", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    rows = file_pairs(names, snippets).join(meta.drop("files"), "record")
    return rows.select(canonical(cwe.normalize(F.col("cwe")), F.col("code_before"), F.col("code_after"), urls.ensure_https(F.col("url")), F.col("language")))


def _under(reader: Callable, *places: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, root: reader(spark, [f"{root}/{p}" for p in places] if len(places) > 1 else f"{root}/{places[0]}")


#: Dataset name -> reader of (spark, root). The pair dataset is left out on purpose: later stages exclude it.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cvefixes": lambda spark, root: cvefixes_newest(spark, f"{root}/cvefixes"),
    "jacontebe": _under(jacontebe, "JaConTeBe"),
    "juliet": _under(juliet, "juliet/juliet_test_suite_c_1_3-train.arrow", "juliet/juliet_test_suite_c_1_3-test.arrow"),
    "megavul": _under(partial(megavul, places=True), "megavul/megavul/*/c_cpp/cve_with_graph_abstract_commit.json"),
    "msr": _under(partial(msr, places=True), "MSR/MSR_data_cleaned.csv"),
    "primevul": _under(primevul, "primevul/primevul_train_paired.jsonl", "primevul/primevul_valid_paired.jsonl", "primevul/primevul_test_paired.jsonl"),
    "sven": _under(sven, "sven/data_train_val/train/cwe-*.jsonl", "sven/data_train_val/val/cwe-*.jsonl"),
}


def normalize(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Canonical rows of a registered dataset with source and row_id, as ``numbered`` gives it."""
    if name not in READERS:
        raise ValueError(f"unknown dataset {name!r}; known are {', '.join(sorted(READERS))}")
    return numbered(READERS[name](spark, root)).select("cwe", "code_before", "code_after", "commit_url", "language", F.lit(name).alias("source"), "row_id")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with row_id from 1, which depends on the data alone, not on how Spark cut it.

    Rows that have a ``place`` are numbered in its order; others, whose joins leave no order, in that of a hash of their content. Rows are sorted and written, with their part and their number in it; the sizes of the parts, of which there are few,
    give each part's first number.
    """
    names = [c for c in rows.columns if c != "place"]
    order = [*(["place"] if "place" in rows.columns else []), F.md5(F.to_json(F.struct(*names))), *names]
    path = shared(rows.sparkSession, "numbered")
    rows.orderBy(*order).select(*names, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")).write.parquet(path)
    written = rows.sparkSession.read.parquet(path)
    sizes = written.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    # a row for each part
    sizes = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n") - F.col("low") + 1).alias("add"))
    return written.join(F.broadcast(sizes), "part").withColumn("row_id", F.col("at") + F.col("add")).select(*names, "row_id")


def normalize_all(spark: SparkSession, root: str, path: str, names: list[str] | None = None, limit: int | None = None) -> tuple[DataFrame | None, dict[str, str]]:
    """Canonical rows of all datasets that can be read, at most the first ``limit`` of each, and the errors of the others.

    Each dataset is written by itself under ``path``, so that one whose files turn out to be missing or damaged is reported and leaves the others as they are.
    """
    found, errors = [], {}
    for name in names or sorted(READERS):
        try:
            limited(normalize(spark, name, root), limit)[0].drop("source").write.mode("overwrite").parquet(f"{path}/source={name}")
            found.append(f"{path}/source={name}")
        except Exception as e:  # noqa: BLE001  a missing or damaged dataset is reported, not fatal
            errors[name] = str(e).splitlines()[0]
    return spark.read.option("basePath", path).parquet(*found) if found else None, errors


def limited(rows: DataFrame, n: int | None) -> tuple[DataFrame, Column]:
    """The first ``n`` rows by row_id, and the flag "truncated", which is also set if there are just ``n``."""
    if n is None:
        return rows, F.lit(False)
    return rows.orderBy("row_id").limit(n), F.count("*") >= n
