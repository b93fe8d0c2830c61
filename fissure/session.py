"""A session with the settings that the library is laid out for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch: what a Python worker holds at a time, several times over as Python objects, whatever the table's size.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: Adaptive plans size and split shuffles; Arrow batches are bounded by bytes and rows, so that long texts don't pile up in one.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.filterPushdown": "true",
} | BATCH


def session(name: str = "fissure", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    builder = builder.master(master) if master else builder
    return builder.config(map=SETTINGS | settings).getOrCreate()


def bounded(spark: SparkSession) -> None:
    """Bound Arrow batches in a session that wasn't made here, unless it has a bound of its own."""
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def _folder(spark: SparkSession) -> str:
    """The cluster's shared folder, or a temporary one where the session names none and has no other machines, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="shared-"))


_own: dict[str, str] = {}


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4()}"


def kept(spark: SparkSession, name: str) -> str:
    """The path of this name in the shared folder, the same in every run."""
    return f"{_folder(spark)}/{name}"
