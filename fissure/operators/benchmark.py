"""From cleaned rows to benchmark entries, nested documents and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fissure.functions import code, cwe, languages, udfs, urls
from fissure.functions.text import text
from fissure.operators import sampling, taxonomy

EXCLUDED = ("crossvul", "bigvul")
SIDE = "struct<context:string,class:string,func:string,lines:array<array<string>>>"
ENTRY = f"struct<benign_code:{SIDE},vulnerable_code:{SIDE},source:string,commit_url:string,review_message:string,CWE:string,other_CWEs:array<string>,other_CWDs:array<string>,CVE:string>"
DOCUMENT = f"map<string,map<string,array<{ENTRY}>>>"


def included(rows: DataFrame, excluded=EXCLUDED) -> DataFrame:
    return rows.filter(~F.col("source").isin(*excluded) & ~F.startswith("source", F.lit("._")))


def commit_cves(fixes: DataFrame) -> DataFrame:
    """(hash, CVE): the smallest id that a commit fixes, by code point."""
    return fixes.groupBy("hash").agg(F.min("cve_id").alias("CVE"))


def with_cve(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    return rows.withColumn("hash", urls.commit_hash(F.col("commit_url"))).join(commit_cves(fixes), "hash", "left").drop("hash")


def with_description(rows: DataFrame, cves: DataFrame) -> DataFrame:
    """``review_message``: the description of an entry's CVE, cleaned."""
    described = cves.select(F.col("cve_id").alias("CVE"), udfs.clean_message(udfs.description("description")).alias("review_message"))
    return rows.join(described, "CVE", "left")


def valid_urls(rows: DataFrame, validity: DataFrame, enabled: bool = True) -> DataFrame:
    """Rows whose repository is known to be valid, their address with a scheme; rows without address stay.

    ``validity``: (repo_key, valid). A repository that isn't listed counts as invalid: nothing is looked up here.
    """
    if not enabled:
        return rows
    keyed = rows.withColumn("repo_key", urls.repo_key(F.col("commit_url"))).join(validity.select("repo_key", "valid").dropDuplicates(["repo_key"]), "repo_key", "left")
    none = text(F.col("commit_url")) == ""
    return keyed.filter(none | F.coalesce("valid", F.lit(False))).withColumn("commit_url", urls.ensure_https(F.col("commit_url"))).drop("repo_key", "valid")


def checked_urls(rows: DataFrame, cache: DataFrame, check=None) -> DataFrame:
    """(repo_key, valid, status_code) of all repositories of ``rows``: from ``cache``, else from ``check(repo_key) -> status or None``, one call each.

    Without ``check`` only the cache counts. Repositories whose check fails are not valid and have no status, so that they can be asked again.
    """
    keys = rows.select(urls.repo_key(F.col("commit_url")).alias("repo_key")).filter("repo_key is not null").distinct()
    known = keys.join(cache.select("repo_key", "valid", "status_code"), "repo_key")
    rest = keys.join(cache.select("repo_key"), "repo_key", "left_anti")
    if check is None:
        return known.unionByName(rest.select("repo_key", F.lit(False).alias("valid"), F.lit(None).cast("int").alias("status_code")))

    def run(frames):
        import pandas as pd

        for frame in frames:
            status = []
            for key in frame["repo_key"]:
                try:
                    status.append(check(key))
                except Exception:  # noqa: BLE001  the callable is the caller's
                    status.append(None)
            yield pd.DataFrame({"repo_key": frame["repo_key"], "valid": [s in (200, 301, 302) for s in status], "status_code": pd.array(status, "Int32")})

    return known.unionByName(rest.mapInPandas(run, "repo_key string, valid boolean, status_code int"))


def _side(structure: str, lines: Column) -> Column:
    return F.struct(*(F.col(f"{structure}.{n}").alias(n) for n in ("context", "class", "func")), lines.alias("lines"))


def entries(rows: DataFrame, pairs: DataFrame, *, keep_classless: bool = False, strip_comments: bool = True, single_function: bool = True, with_hunks: bool = False) -> DataFrame:
    """Benchmark entries of cleaned rows: (row_id, language, cwd, entry).

    ``rows`` may carry CVE and review_message. Cheap conditions come before Python: rows without an id, and without a class unless ``keep_classless``, go first.
    """
    rows = rows.withColumn("cwes", cwe.clean_list(F.col("cwe"))).filter("size(cwes) > 0")
    rows = taxonomy.with_cwds(rows, pairs)
    rows = rows if keep_classless else rows.filter("cwd is not null")
    for name in ("CVE", "review_message"):
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast("string"))
    none = F.array().cast("array<array<string>>")
    if with_hunks:
        rows = rows.withColumn("raw_before", F.col("code_before")).withColumn("raw_after", F.col("code_after"))
    lines = (lambda side: F.col(f"hunks.{side}")) if with_hunks else (lambda side: none)
    for side in ("after", "before"):
        name = f"code_{side}"
        if strip_comments or single_function:
            rows = rows.withColumn(f"k_{side}", udfs.stripped(F.col(name), F.col("language")))
            rows = rows.withColumn(name, F.col(f"k_{side}.code")) if strip_comments else rows
        rows = rows.withColumn(f"s_{side}", code.structure(F.col(name), F.col("language")))
        if single_function:
            rows = rows.filter(F.col(f"s_{side}.func").isNull() | (F.col(f"k_{side}.functions") == 1))
    if with_hunks:  # of the code with its comments, and of the rows that are left
        rows = rows.withColumn("hunks", udfs.hunks("raw_before", "raw_after"))
    entry = F.struct(
        _side("s_after", lines("benign")).alias("benign_code"), _side("s_before", lines("vulnerable")).alias("vulnerable_code"), "source",
        F.nullif(urls.ensure_https(F.col("commit_url")), F.lit("")).alias("commit_url"), "review_message", F.col("primary_cwe").alias("CWE"), F.col("other_cwes").alias("other_CWEs"), F.col("other_cwds").alias("other_CWDs"), "CVE",
    )
    return rows.select("row_id", "source", "language", "cwd", entry.alias("entry"))


def multi_function_reason(benign: Column, vulnerable: Column, language: Column) -> Column:
    """Why a pair is dropped: benign, vulnerable or both have another number of functions than one; null if it stays."""
    b, v = udfs.function_count(benign, language) != 1, udfs.function_count(vulnerable, language) != 1
    return F.when(b & v, "both").when(b, "benign").when(v, "vulnerable")


#: Entries in one of the documents that a large one is cut into.
PART = 64


def _first(documents: DataFrame) -> Column:
    """Entries that stand before a document's own: none, unless it is a part of one."""
    return F.col("first") if "first" in documents.columns else F.lit(0)


def nested(found: DataFrame, key: str = "cwd") -> DataFrame:
    """One row: the whole document as JSON text, keys in order, entries by row number, nulls written out."""
    groups = found.groupBy("language", key).agg(F.array_sort(F.collect_list(F.struct("row_id", "entry"))).alias("e"))
    inner = groups.select("language", F.struct(F.col(key).alias("k"), F.transform("e", lambda x: x["entry"]).alias("v")).alias("kv"))
    per = inner.groupBy("language").agg(F.map_from_entries(F.array_sort(F.collect_list("kv"), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))).alias("m"))
    whole = per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "m")), lambda a, b: F.when(a["language"] < b["language"], -1).otherwise(1))).alias("d"))
    return whole.select(F.to_json("d", {"ignoreNullFields": "false"}).alias("document"))


def nested_parts(found: DataFrame, key: str = "cwd") -> DataFrame:
    """(first, document): the same in documents of up to PART entries of one group each, of which ``first`` stand before in the group. ``flattened`` and ``merged`` take these for one document."""
    lines = sampling.numbered(found.select("row_id", "language", key, F.to_json("entry", {"ignoreNullFields": "false"}).alias("line")), ["language", key])
    parts = lines.groupBy("language", key, F.expr(f"at div {PART}").alias("part")).agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("e"))
    name = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("k"))), r'(?s)^\{"k":(.*)\}$', 1)
    text = F.concat(F.lit("{"), name("language"), F.lit(":{"), name(key), F.lit(":["), F.array_join(F.transform("e", lambda x: x["line"]), ","), F.lit("]}}"))
    return parts.select((F.col("part") * PART).alias("first"), text.alias("document"))


def group_lines(found: DataFrame, key: str = "cwd") -> DataFrame:
    """The same without one row that holds all: (language, key, pos, line), ``line`` being the entry as JSON text."""
    return sampling.numbered(found, ["language", key]).select("language", key, F.col("at").cast("int").alias("pos"), F.to_json("entry", {"ignoreNullFields": "false"}).alias("line"))


def flattened(documents: DataFrame, outer_wins: bool = False) -> DataFrame:
    """Entries of nested documents ``(document)``: language, cwd, pos and the entry's fields.

    An entry's own ``language`` or ``cwd`` field wins over the document's key unless ``outer_wins``.
    """
    parsed = documents.select(_first(documents).alias("first"), F.from_json("document", "map<string,map<string,array<string>>>").alias("d"))
    rows = parsed.select("first", F.explode("d").alias("outer_language", "m")).select("first", "outer_language", F.explode("m").alias("outer_cwd", "items")).select("first", "outer_language", "outer_cwd", F.posexplode("items").alias("at", "item"))
    rows = rows.withColumn("pos", (F.col("first") + F.col("at")).cast("int"))
    own = lambda name: F.get_json_object("item", f"$.{name}")
    pick = lambda name: F.col(f"outer_{name}") if outer_wins else F.coalesce(own(name), F.col(f"outer_{name}"))
    return rows.select(pick("language").alias("language"), pick("cwd").alias("cwd"), "pos", F.from_json("item", ENTRY).alias("entry"))


def flat_entry(rows: DataFrame) -> DataFrame:
    """The older flat entry of canonical rows: lines of both sides, first id, shown language."""
    return rows.select("row_id", languages.shown(F.col("language")).alias("language"), code.lines_of(F.col("code_after")).alias("benign_lines"), code.lines_of(F.col("code_before")).alias("vulnerable_lines"), cwe.normalize_first(F.col("cwe")).alias("CWE"), "source", F.col("commit_url").alias("commit"))


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """(language, key, pos, item) of two nested documents ``(document)``, whole or in parts: under each key the entries of the first, then those of the second, each with all its fields as JSON text."""
    from pyspark.sql import Window

    def items(documents: DataFrame, turn: int) -> DataFrame:
        parsed = documents.select(_first(documents).alias("first"), F.from_json("document", "map<string,map<string,array<string>>>").alias("d")).select("first", F.explode("d").alias("language", "m"))
        return parsed.select("first", "language", F.explode("m").alias("key", "items"), F.lit(turn).alias("turn"))

    both = items(first, 0).unionByName(items(second, 1))
    counts = both.groupBy("language", "key", "turn").agg(F.sum(F.size("items")).alias("n"))
    both = both.select("first", "language", "key", "turn", F.posexplode("items").alias("at", "item"))
    before = counts.select("language", "key", "turn", (F.sum("n").over(Window.partitionBy("language", "key").orderBy("turn")) - F.col("n")).alias("before"))
    return both.join(before, ["language", "key", "turn"]).select("language", "key", (F.col("before") + F.col("first") + F.col("at")).cast("int").alias("pos"), "item")
