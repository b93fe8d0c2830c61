"""Large JSON arrays and quoted CSV files, read in byte ranges.

Spark's text reader cuts a file into ranges anywhere; here a piece ends at each ``}`` or line feed. Whether a range begins inside a string, and how deep, is not known to it. So there are two passes. In the first, each range says what it
makes of either beginning: where it ends up, how deep, and how many records end in it. From these few numbers the beginning of every range follows, in the order of the ranges. In the second pass each range returns its records, and the parts
of the records that cross its ends; those of one record are joined. No task holds a file, and each record has its number in the file, however the file was cut.

CSV must have quotes as its writers set them, around fields and doubled inside; a single quote in the middle of a bare field would be taken for the beginning of a string.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are looked at at a time.
PART = 4 << 20


@dataclass
class End:
    """What a range makes of one beginning: inside a string or not at its end, by how much deeper, and the records that end in it, by the depth at which they would."""

    inside: bool
    deeper: int
    records: dict[int, int]


def pieces(spark: SparkSession, path: str | list[str], mark: str) -> DataFrame:
    """(value, file, start) of the pieces of files between marks; ``start`` is that of the range that a piece begins in."""
    return spark.read.option("lineSep", mark).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def parts(batches: Iterator[pa.RecordBatch], mark: bytes) -> Iterator[tuple[tuple[str, int], bytes, bool]]:
    """(range, bytes, is it the range's last) of a partition, in order."""
    now, held, size = None, [], 0
    for batch in batches:
        for value, file, start in zip(batch.column("value"), batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
            if now != (file, start) or size >= PART:
                if held:
                    yield now, b"".join(held), now != (file, start)
                now, held, size = (file, start), [], 0
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            held += [raw, mark]
            size += len(raw) + 1
    if held:
        yield now, b"".join(held), True


def quotes(data: np.ndarray, escape: bool) -> np.ndarray:
    """Places of the quotes that begin or end a string; with ``escape``, not of those behind an odd number of backslashes."""
    at = np.flatnonzero(data == 34)
    if escape and len(at):
        last = np.maximum.accumulate(np.where(data != 92, np.arange(len(data)), -1))
        run = at - 1 - np.where(at > 0, last[at - 1], -1)
        at = at[run % 2 == 0]
    return at


class JsonArray:
    """Records are the objects and arrays in a top-level array."""

    mark, escape = b"}", True

    @staticmethod
    def depths(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        """Places of the brackets outside strings, the depth after each, and whether the end is in a string."""
        at = quotes(data, True)
        marks = np.flatnonzero((data == 123) | (data == 91) | (data == 125) | (data == 93))
        before = np.searchsorted(at, marks)
        marks = marks[(before + inside) % 2 == 0]
        step = np.where((data[marks] == 123) | (data[marks] == 91), 1, -1)
        return marks, np.cumsum(step), bool((len(at) + inside) % 2)

    def end(self, data: np.ndarray, so_far: End) -> End:
        marks, depth, inside = self.depths(data, so_far.inside)
        if not len(marks):
            return End(inside, so_far.deeper, so_far.records)
        depth = depth + so_far.deeper
        # records end where the depth comes down to 1: which relative depth that is, is not known yet
        down, times = np.unique(depth[np.diff(depth, prepend=so_far.deeper) < 0], return_counts=True)
        records = dict(so_far.records)
        for d, n in zip(down.tolist(), times.tolist(), strict=True):
            records[d] = records.get(d, 0) + n
        return End(inside, int(depth[-1]), records)

    def cut(self, data: np.ndarray, inside: bool, depth: int) -> tuple[list[tuple[int, int]], bool, int]:
        """(where a record begins, where it ends) in the bytes, -1 for what is not in them; then the state at the end."""
        marks, depths, end = self.depths(data, inside)
        depths = depths + depth
        step = np.diff(depths, prepend=depth)
        begins = marks[(step > 0) & (depths == 2)].tolist()
        ends = (marks[(step < 0) & (depths == 1)] + 1).tolist()
        if depth >= 2:
            begins.insert(0, -1)
        spans = list(zip(begins, [*ends, -1][: len(begins)], strict=True))
        return spans, end, int(depths[-1]) if len(marks) else depth


class QuotedLines:
    """Records are lines, where a line feed in quotes is none; blank lines don't count."""

    mark, escape = b"\n", False

    @staticmethod
    def lines(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        """Where records begin, -1 for one that is open, and end, and whether the end is in quotes. The bytes end with a line feed, so that a record is open just where quotes are."""
        feeds, at = np.flatnonzero(data == 10), quotes(data, False)
        ends = feeds[(np.searchsorted(at, feeds) + inside) % 2 == 0] + 1
        begins = np.concatenate([[-1 if inside else 0], ends])[: len(ends)]
        blank = (begins >= 0) & ((ends - begins == 1) | (ends - begins == 2) & (data[np.maximum(begins, 0)] == 13))
        return begins[~blank], ends[~blank], bool((len(at) + inside) % 2)

    def end(self, data: np.ndarray, so_far: End) -> End:
        _, ends, inside = self.lines(data, so_far.inside)
        return End(inside, 0, {1: so_far.records.get(1, 0) + len(ends)})

    def cut(self, data: np.ndarray, inside: bool, depth: int) -> tuple[list[tuple[int, int]], bool, int]:
        begins, ends, after = self.lines(data, inside)
        spans = list(zip(begins.tolist(), ends.tolist(), strict=True))
        if after:
            feeds = np.flatnonzero(data == 10)
            closed = feeds[(np.searchsorted(quotes(data, False), feeds) + inside) % 2 == 0]
            spans.append((int(closed[-1]) + 1 if len(closed) else -1 if inside else 0, -1))
        return spans, after, 1


class Lines(QuotedLines):
    """Records are plain lines."""

    @staticmethod
    def lines(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        ends = np.flatnonzero(data == 10) + 1
        return np.concatenate([[0], ends[:-1]]).astype(np.int64), ends, False


def beginnings(found: list, lines: bool) -> tuple[dict[tuple[str, int], tuple[bool, int, int]], dict[str, int]]:
    """(in a string, depth, records that ended before in the file) at the beginning of every range, and the records of every file.

    ``found``: (file, start, inside, End's fields) of every range for either beginning.
    """
    ends: dict[tuple[str, int], dict[bool, End]] = {}
    for r in found:
        ends.setdefault((r["file"], r["start"]), {})[r["inside"]] = End(r["ends_inside"], r["deeper"], dict(zip(r["depths"], r["records"], strict=True)))
    out, counts, file = {}, {}, None
    for key in sorted(ends):
        if key[0] != file:
            file, inside, depth, count = key[0], False, 0, 0
        out[key] = (inside, depth, count)
        end = ends[key][inside]
        count += end.records.get(1 if lines else 1 - depth, 0)
        inside, depth = end.inside, depth + end.deeper
        counts[file] = count
    return out, counts


def records(spark: SparkSession, path: str | list[str], kind: JsonArray | QuotedLines) -> tuple[DataFrame, dict[str, str], dict[str, int]]:
    """(file, number, record): the records of each file, numbered from 1; the first record of each file of lines; and how many records each file has."""
    raw, lines = pieces(spark, path, kind.mark.decode()), isinstance(kind, QuotedLines)

    def first(batches):
        ends: dict[tuple[str, int], list[End]] = {}
        heads: dict[tuple[str, int], str] = {}
        for key, raw_bytes, _ in parts(batches, kind.mark):
            data = np.frombuffer(raw_bytes, np.uint8)
            if lines and key[1] == 0 and key not in heads and (spans := kind.cut(data, False, 0)[0]):
                heads[key] = raw_bytes[slice(*spans[0])].decode()
            ends[key] = [kind.end(data, e) for e in ends.get(key, [End(False, 0, {}), End(True, 0, {})])]
        for key, both in ends.items():
            yield pa.RecordBatch.from_pylist([{"file": key[0], "start": key[1], "inside": bool(i), "ends_inside": e.inside, "deeper": e.deeper, "depths": list(e.records), "records": list(e.records.values()), "head": heads.get(key)} for i, e in enumerate(both)], ENDS)

    # two rows for each range
    found = raw.mapInArrow(first, "file string, start long, inside boolean, ends_inside boolean, deeper long, depths array<long>, records array<long>, head string").collect()
    begin, counts = beginnings(found, lines)
    sent = spark.sparkContext.broadcast(begin)

    def second(batches):
        state = None
        for key, raw_bytes, last in parts(batches, kind.mark):
            if state is None:
                inside, depth, number = sent.value[key]
                state, at = key, 0
            spans, inside, depth = kind.cut(np.frombuffer(raw_bytes, np.uint8), inside, depth)
            out = []
            for a, b in spans:
                number += b >= 0
                whole = a >= 0 and b >= 0
                # the parts of a record have the number that it gets when it ends
                out.append((key[0], number if whole else None, None if whole else number + (b < 0), key[1], at, raw_bytes[max(a, 0) : b if b >= 0 else len(raw_bytes)]))
                at += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["file", "number", "crossing", "start", "at", "record"])
            if last:
                state = None

    cut = raw.mapInArrow(second, "file string, number long, crossing long, start long, at long, record binary")
    joined = cut.filter("crossing is not null").groupBy("file", "crossing").agg(F.array_sort(F.collect_list(F.struct("start", "at", "record"))).alias("p"))
    joined = joined.select("file", F.col("crossing").alias("number"), F.expr("aggregate(p, cast('' as binary), (s, x) -> concat(s, x.record))").alias("record"))
    whole = cut.filter("number is not null").select("file", "number", "record").unionByName(joined).withColumn("record", F.col("record").cast("string"))
    return whole, {r["file"]: r["head"] for r in found if r["head"] is not None}, counts


ENDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("ends_inside", pa.bool_()), ("deeper", pa.int64()), ("depths", pa.list_(pa.int64())), ("records", pa.list_(pa.int64())), ("head", pa.string())])


def json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The objects of JSON files that are one array each, as rows of ``schema`` with ``file`` and ``number``. A file that is damaged in one place gives null fields for that object."""
    found, _, _ = records(spark, path, JsonArray())
    return found.select("file", "number", F.from_json("record", schema).alias("r")).select("file", "number", "r.*")


def csv_rows(spark: SparkSession, path: str | list[str], columns: list[str], together: Callable[[str], str] = str) -> DataFrame:
    """(file, number, columns): rows of CSV files with a header, as text; fields that a row lacks are null. Line ends in quotes stay; rows are numbered from 1.

    Files for which ``together`` returns the same are numbered on, in the order of their paths.
    """
    found, first, counts = records(spark, path, QuotedLines())
    before: dict[str, int] = {}
    sums: dict[str, int] = {}
    for file in sorted(counts):
        before[file] = sums.get(together(file), 0)
        sums[together(file)] = before[file] + counts[file] - 1
    # one for each file
    heads = {file: next(csv.reader(io.StringIO(head.removeprefix("\ufeff"), newline="")), []) for file, head in first.items()}

    def parse(batches):
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            out = []
            for file, number, record in zip(*(batch.column(c).to_pylist() for c in ("file", "number", "record")), strict=True):
                row = next(csv.reader(io.StringIO(record, newline="")), None)
                if number > 1 and row:
                    fields = dict(zip(heads[file], row, strict=False))
                    out.append((file, before[file] + number - 1, *(fields.get(c) for c in columns)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), *[pa.string()] * len(columns)), strict=True)], names=["file", "number", *columns])

    return found.mapInArrow(parse, ", ".join(["file string", "number long", *(f"`{c}` string" for c in columns)]))
