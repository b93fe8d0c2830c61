"""A Spark data source over SQLite files: a table is read in ranges of row numbers, by columns, with filters asked of SQLite.

A SQLite file is read at random places, so it must lie where every executor can open it: on a mount that all share (a path or ``file:`` address; a folder or pattern reads all its files as one table), or shipped with
``spark.sparkContext.addFile`` (option ``shipped``, the path is its name then). Files are opened read-only and taken as unchanging.

Each file is cut into ``ranges`` spans of row numbers, of equal width between the smallest and the largest, so that no pass over the table is needed to cut it; tables without row numbers and views are one range a file. The columns of the schema
that the reader is given are the only ones asked for. Filters are asked of SQLite where they mean the same there, and by Spark once more. Values that don't fit the column's type are null; bytes in a text column are decoded.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual

#: Bytes of text after which a batch ends.
BATCH = 4 << 20
COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def local_files(path: str, shipped: bool = False) -> list[str]:
    """The files that a path, folder or pattern names."""
    if shipped:
        return [SparkFiles.get(os.path.basename(path))]
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"SQLite files are read at random places: mount {path!r} on all machines, or ship the file with addFile")
    path = unquote(parts.path) if parts.scheme else path
    found = sorted(glob.glob(f"{path}/*.db")) if os.path.isdir(path) else [path] if os.path.isfile(path) else sorted(glob.glob(path))
    if not found:
        raise FileNotFoundError(f"no SQLite file at {path!r}")
    return found


def connect(file: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(file)}?mode=ro&immutable=1", uri=True)


def kind_of(declared: str) -> T.DataType:
    """The Spark type of a declared type, by SQLite's rules of affinity. Numbers of no certain kind, dates among them, stay text."""
    name = declared.upper()
    if "INT" in name:
        return T.LongType()
    if any(x in name for x in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    if "BLOB" in name or not name:
        return T.BinaryType()
    return T.DoubleType() if any(x in name for x in ("REAL", "FLOA", "DOUB")) else T.StringType()


def columns_of(connection: sqlite3.Connection, table: str) -> list[tuple[str, str]]:
    """(name, declared type) of a table or view, without rows where there is none."""
    return connection.execute("SELECT name, type FROM pragma_table_info(?)", (table,)).fetchall()


def value(x, kind: T.DataType):
    """A stored value as one of the column's type."""
    if x is None:
        return None
    if isinstance(kind, T.StringType):
        if isinstance(x, bytes):
            try:
                return x.decode()
            except UnicodeDecodeError:
                return x.decode("latin-1")
        return x if isinstance(x, str) else repr(x)
    if isinstance(kind, T.BinaryType):
        return x if isinstance(x, bytes) else str(x).encode()
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return x if isinstance(x, int) else None
    return float(x) if isinstance(x, (int, float)) else None


@dataclass
class Range(InputPartition):
    """Rows of a file with numbers from ``low`` to ``high``; all of them if None."""

    file: str
    low: int | None = None
    high: int | None = None


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.schema, self.where, self.parameters = options, schema, [], []

    def pushFilters(self, filters):
        for f in filters:
            if len(f.attribute if hasattr(f, "attribute") else ()) == 1 and f.attribute[0] in self.schema.names:
                self._ask(f, f.attribute[0])
            yield f

    def _ask(self, f, name: str) -> None:
        kind, column = self.schema[name].dataType, quoted(name)
        if isinstance(f, IsNotNull):
            self.where.append(f"{column} IS NOT NULL")
        elif isinstance(f, IsNull) and isinstance(kind, (T.StringType, T.BinaryType)):
            self.where.append(f"{column} IS NULL")
        elif isinstance(f, (*COMPARISONS, In)):
            values = list(f.value) if isinstance(f, In) else [f.value]
            if isinstance(kind, T.StringType) and all(isinstance(x, str) for x in values):
                # as Spark compares: bytes, whatever the column's collation
                column = f"CAST({column} AS TEXT) COLLATE BINARY"
            elif not (isinstance(kind, (T.LongType, T.IntegerType)) and all(isinstance(x, int) for x in values)):
                return
            self.where.append(f"{column} IN ({', '.join('?' * len(values))})" if isinstance(f, In) else f"{column} {COMPARISONS[type(f)]} ?")
            self.parameters += values

    def partitions(self) -> list[Range]:
        out, n = [], int(self.options.get("ranges", 8))
        for file in local_files(self.options["path"], self.options.get("shipped", "false").lower() == "true"):
            with connect(file) as db:
                if not columns_of(db, self.options["table"]):
                    continue
                try:
                    low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.options['table'])}").fetchone()
                except sqlite3.OperationalError:
                    out.append(Range(file))
                    continue
            if isinstance(low, int):
                edges = [low + (high + 1 - low) * i // n for i in range(n + 1)]
                out += [Range(file, a, b - 1) for a, b in zip(edges, edges[1:], strict=False) if a < b]
            else:
                # empty, or a view, whose rows have no numbers
                out.append(Range(file))
        return out or [Range("")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        file = SparkFiles.get(os.path.basename(partition.file)) if self.options.get("shipped", "false").lower() == "true" else partition.file
        kinds = [f.dataType for f in self.schema.fields]
        arrow = pa.schema([(f.name, {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BinaryType: pa.binary()}.get(type(f.dataType), pa.string())) for f in self.schema.fields])
        where, parameters = list(self.where), list(self.parameters)
        if partition.low is not None:
            where.append("rowid BETWEEN ? AND ?")
            parameters += [partition.low, partition.high]
        with connect(file) as db:
            # texts that are no UTF-8 come as bytes
            db.text_factory = lambda raw: value(raw, T.StringType())
            there = {name for name, _ in columns_of(db, self.options["table"])}
            names = ", ".join(quoted(f.name) if f.name in there else "NULL" for f in self.schema.fields) or "NULL"
            found = db.execute(f"SELECT {names} FROM {quoted(self.options['table'])}" + (f" WHERE {' AND '.join(where)}" if where else ""), parameters)
            rows, size = [], 0
            for row in found:
                rows.append([value(x, k) for x, k in zip(row, kinds, strict=False)])
                size += sum(len(x) if isinstance(x, (str, bytes)) else 8 for x in row)
                if size >= BATCH:
                    yield _batch(rows, arrow)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, arrow)


def _batch(rows: list[list], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


class SQLite(DataSource):
    """``spark.read.format("sqlite").option("table", ...).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        for file in local_files(self.options["path"], self.options.get("shipped", "false").lower() == "true"):
            with connect(file) as db:
                if found := columns_of(db, self.options["table"]):
                    return T.StructType([T.StructField(name, kind_of(kind)) for name, kind in found])
        raise ValueError(f"no table {self.options['table']!r} at {self.options['path']!r}")

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(dict(self.options), schema)


def table(spark: SparkSession, path: str, name: str, columns: str | None = None, ranges: int = 8, shipped: bool = False) -> DataFrame:
    """A table of the files at ``path``; ``columns``: only these, as a schema."""
    spark.dataSource.register(SQLite)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("sqlite").option("table", name).option("ranges", ranges).option("shipped", str(shipped).lower())
    return (reader.schema(columns) if columns else reader).load(path)
