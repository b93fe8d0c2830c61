"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one kernel call sees; a single longer document is a slice of its own.
SLICE_BYTES = 1 << 20

#: UTF-8 bytes of the white space class ``[\x20\x09-\x0D]`` that the word rules use.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
CONTINUATION = (np.arange(256) & 0xC0) == 0x80


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; one of our own only where the session names none and has no other machines."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that later jobs neither repeat its work nor lose it with an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that must not be broadcast: Spark takes exploded rows for no larger than what they were made of, and would build tables of many millions of them on the driver."""
    return df.hint("merge")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each slice stays near SLICE_BYTES."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)


def release() -> None:
    """Give freed memory back to the system, so that the worker's next task, perhaps of another operator, starts small."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def over_slices(kernel: Callable[[pa.RecordBatch], pa.RecordBatch], done: Callable[[], None] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``kernel`` for text slices of a partition; ``done`` is called at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in slices(batches):
                yield kernel(part)
        finally:
            if done:
                done()
            release()

    return run


def map_text(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType, done: Callable[[], None] | None = None) -> DataFrame:
    """Apply ``kernel`` to text slices of every partition, without a shuffle."""
    return df.mapInArrow(over_slices(kernel, done), schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as the empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def plain_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and the document of each."""
    split = pc.ascii_split_whitespace(pc.fill_null(column, "").cast(pa.large_string()))
    doc = np.repeat(np.arange(len(column)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full), doc[full.to_numpy(zero_copy_only=False)]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, whatever else the table carries; ids as longs."""
    return df.select(*(F.col(f"`{n}`").cast("long").alias(n) if n == "doc_id" else F.col(f"`{n}`") for n in names))


def table(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a Parquet table in the shared folder: smaller for many rows, and read by column."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
