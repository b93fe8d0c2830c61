"""Single files in whatever store Spark's Hadoop configuration reaches: written at a hidden place and renamed when whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Characters that are sent to the store at a time.
SENT = 1 << 20


def place(spark: SparkSession, path: str):
    """(file system, path) of an address."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def listed(spark: SparkSession, pattern: str) -> list:
    """Status of what a pattern names, by path."""
    fs, there = place(spark, pattern)
    return sorted(fs.globStatus(there) or [], key=lambda x: x.getPath().toString())


class Text:
    """Text on its way to a stream."""

    def __init__(self, stream):
        self.stream, self.held, self.size = stream, [], 0

    def write(self, text: str) -> None:
        self.held.append(text)
        self.size += len(text)
        if self.size >= SENT:
            self.flush()

    def flush(self) -> None:
        self.stream.write(bytearray("".join(self.held).encode("utf-8")))
        self.held, self.size = [], 0


@contextmanager
def writing(spark: SparkSession, path: str) -> Iterator[Text]:
    """A file to write text to. It takes the place of what was at ``path`` at the end; after an error nothing has changed."""
    fs, there = place(spark, path)
    fs, hidden = place(spark, f"{there.getParent()}/.{there.getName()}-{uuid.uuid4()}")
    stream = fs.create(hidden, True)
    try:
        text = Text(stream)
        yield text
        text.flush()
        stream.close()
        fs.delete(there, True)
        fs.rename(hidden, there)
    except BaseException:
        stream.close()
        fs.delete(hidden, False)
        raise


def joined(spark: SparkSession, text: Text, folder: str) -> None:
    """The part files that Spark wrote to ``folder``, in order, appended; the bytes go from stream to stream."""
    text.flush()
    for part in listed(spark, f"{folder}/part-*"):
        source = part.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).open(part.getPath())
        try:
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, text.stream, 1 << 16, False)
        finally:
            source.close()
