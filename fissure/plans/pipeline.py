"""The curation pipeline: normalize, clean, transform, sample, as one lazy plan per output."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fissure.functions import languages
from fissure.operators import benchmark, clean, cluster, dedup, sampling, taxonomy
from fissure.sources import datasets, files, sinks


@dataclass
class Config:
    """Settings of a run. ``source`` is a folder of raw datasets, or of canonical CSV or Parquet files."""

    source: str = ""
    out: str = "out"
    taxonomy: str = ""
    datasets: list[str] | None = None
    excluded: tuple[str, ...] = benchmark.EXCLUDED
    limit: int | None = None
    allowed_languages: tuple[str, ...] = languages.ALLOWED
    language_map: dict[str, str] | None = None
    reject_unknown: bool = True
    reject_invalid: bool = True
    min_length: int = 10
    dedup: str | None = None
    dedup_key: str = "signature"
    filter_multiple_functions: bool = True
    remove_comments: bool = True
    with_hunks: bool = False
    keep_classless: bool = False
    cluster_method: str = "stratified"
    max_per_group: int = 300
    url_validation: bool = False
    url_cache: str = ""
    cvefixes_dump: str = ""
    embeddings: str = ""
    now: str = "1970-01-01T00:00:00Z"

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        """Sections ``clean``, ``transform``, ``sample`` and so on hold settings by the field names above, as does the top; an unknown name is an error."""
        import yaml

        with open(path, encoding="utf-8") as file:
            raw = yaml.safe_load(file) or {}
        known = {k: v for k, v in raw.items() if not isinstance(v, dict) or k in cls.__dataclass_fields__}
        for section in (v for k, v in raw.items() if k not in known):
            known |= section
        if wrong := sorted(set(known) - set(cls.__dataclass_fields__)):
            raise ValueError(f"unknown settings: {', '.join(wrong)}")
        for name in ("excluded", "allowed_languages"):
            if name in known:
                known[name] = tuple(known[name])
        return cls(**known)

    def check(self, can_ask: bool = False) -> None:
        """Raise an error for settings that would have no effect."""
        if self.url_validation and not (self.url_cache or can_ask):
            raise ValueError("url_validation needs url_cache, or a function that asks")
        if self.cluster_method not in ("stratified", "kmeans"):
            raise ValueError(f"unknown cluster_method {self.cluster_method!r}")
        if self.cluster_method == "kmeans" and not self.embeddings:
            raise ValueError("cluster_method kmeans needs embeddings")
        if self.dedup not in (None, "compat", "fixed"):
            raise ValueError(f"unknown dedup {self.dedup!r}")


def steps(config: Config) -> tuple[clean.Step, ...]:
    return (clean.language_step(config.allowed_languages, config.language_map), clean.cwe_step(config.reject_unknown, config.reject_invalid), clean.code_step(min_length=config.min_length), clean.url_step(), clean.dedup_step())


def normalize(spark: SparkSession, config: Config) -> tuple[DataFrame, dict[str, str]]:
    """Canonical rows, written under ``out``, and the errors of datasets that could not be read; an error if none could."""
    rows, errors = datasets.normalize_all(spark, config.source, f"{config.out}/canonical", config.datasets, config.limit)
    if rows is None:
        raise RuntimeError(f"no dataset could be read: {errors}")
    return rows, errors


def load(spark: SparkSession, path: str) -> DataFrame:
    return files.canonical_csv(spark, path) if path.rstrip("/").endswith("csv") else spark.read.parquet(path)


def cleaned(rows: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows, deduplicated if asked for, and the funnel."""
    rows = benchmark.included(rows, config.excluded)
    out = clean.clean(rows, steps(config))
    if config.dedup:
        out = dedup.without_drops(out, dedup.drops(dedup.manifest(out), config.dedup, config.dedup_key))
    return out, clean.funnel(rows, steps(config))


def validity(spark: SparkSession, rows: DataFrame, config: Config, ask: Callable[[str], int | None] | None = None) -> DataFrame:
    """(repo_key, valid, status_code) of the repositories of ``rows``, from the cache and else from ``ask``; what was asked is added to the cache."""
    cache = spark.createDataFrame([], "repo_key string, valid boolean, status_code int")
    if config.url_cache:
        cache = spark.read.schema(cache.schema).json(config.url_cache)
    path = f"{config.out}/urls"
    benchmark.checked_urls(rows, cache, ask).write.mode("overwrite").parquet(path)
    known = spark.read.parquet(path)
    if config.url_cache and ask:
        known.filter("status_code is not null").join(cache, "repo_key", "left_anti").write.mode("append").json(config.url_cache)
    return known


def transformed(spark: SparkSession, rows: DataFrame, config: Config, pairs: DataFrame | None = None, ask: Callable[[str], int | None] | None = None) -> DataFrame:
    """Entries of cleaned rows, with the CVE of their commit and its description where a dump is given, groups capped.

    ``ask(repo_key)`` gives the status of a repository's address; without it only those in ``url_cache`` count as valid.
    """
    config.check(ask is not None)
    pairs = pairs if pairs is not None else taxonomy.flatten(spark, taxonomy.load(config.taxonomy))[1]
    if config.url_validation:
        rows = benchmark.valid_urls(rows, validity(spark, rows, config, ask))
    if config.cvefixes_dump:
        rows = benchmark.with_cve(rows, datasets.dump_fixes(spark, config.cvefixes_dump))
        rows = benchmark.with_description(rows, datasets.dump_descriptions(spark, config.cvefixes_dump))
    found = benchmark.entries(rows, pairs, keep_classless=config.keep_classless, strip_comments=config.remove_comments, single_function=config.filter_multiple_functions, with_hunks=config.with_hunks)
    if config.cluster_method == "kmeans":
        embeddings = spark.read.parquet(config.embeddings).select("source", "row_id", "embedding")
        return cluster.select(cluster.with_embeddings(found, embeddings, ["source", "row_id"]), ["language", "cwd"], config.max_per_group).drop("embedding").select(*found.columns)
    return sampling.capped(found, ["language", "cwd"], "source", config.max_per_group)


def run(spark: SparkSession, config: Config, ask: Callable[[str], int | None] | None = None) -> DataFrame:
    """All steps; canonical rows, funnel, entries and samples are written under ``out``."""
    config.check(ask is not None)
    rows, _ = normalize(spark, config)
    kept, funnel = cleaned(rows, config)
    sinks.parquet(kept, f"{config.out}/cleaned")
    funnel.write.mode("overwrite").parquet(f"{config.out}/funnel")
    found = transformed(spark, spark.read.parquet(f"{config.out}/cleaned"), config, ask=ask)
    found.write.mode("overwrite").parquet(f"{config.out}/entries")
    found = spark.read.parquet(f"{config.out}/entries")
    sinks.json_lines(benchmark.group_lines(found), f"{config.out}/benchmark")
    sinks.samples(found, f"{config.out}/samples", config.now)
    return found.groupBy("language", "cwd").agg(F.count("*").alias("n"))
