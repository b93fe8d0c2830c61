"""Readers of plain file formats."""

from __future__ import annotations

import hashlib
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fissure.functions import udfs
from fissure.session import kept, shared
from fissure.sources import ranges, stores

CANONICAL = "cwe string, code_before string, code_after string, commit_url string, language string"


def decoded(content: Column, fallback: str = "ISO-8859-1") -> Column:
    """Bytes as UTF-8, or in the fallback encoding where they are none."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, fallback))


def texts(spark: SparkSession, path: str, fallback: str = "ISO-8859-1") -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", decoded(F.col("content"), fallback).alias("text"))


def canonical_csv(spark: SparkSession, path: str) -> DataFrame:
    """Canonical rows of CSV files with a header: source is the file's stem, empty and missing fields are empty strings, row_id counts the rows of a source from 1.

    Quoted line ends stay as they are; files are read in ranges, as ``ranges`` says, and the numbers don't depend on them.
    """
    names = [c.split()[0] for c in CANONICAL.split(", ")]
    rows = ranges.csv_rows(spark, path, names, lambda file: PurePosixPath(unquote(file)).stem).fillna("", names)
    return rows.select(*names, F.regexp_extract(F.url_decode("file"), r"([^/]*?)(?:\.[^./]*)?$", 1).alias("source"), F.col("number").alias("row_id"))


def json_lines(spark: SparkSession, path: str, schema: str | None = None, strict: bool = True) -> DataFrame:
    """One JSON value per line; blank lines are skipped, bad lines raise or are dropped."""
    reader = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def bad_json_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.try_parse_json("value").isNull()).alias("bad"))


def arrow_rows(contents: DataFrame, columns: str) -> DataFrame:
    """Rows of Arrow IPC files or streams in the binary column ``content``; missing columns are null, bytes become text."""
    import pyarrow as pa

    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        for batch in batches:
            for raw in batch.column("content"):
                buffer = raw.as_buffer()
                try:
                    table = pa.ipc.open_file(buffer).read_all()
                except pa.ArrowInvalid:
                    table = pa.ipc.open_stream(buffer).read_all()
                for part in table.select([n for n in names if n in table.column_names]).to_batches():
                    arrays = [(part.column(n) if n in part.schema.names else pa.nulls(part.num_rows)) for n in names]
                    text = [a.cast(pa.binary()).cast(pa.string()) if pa.types.is_binary(a.type) or pa.types.is_large_binary(a.type) else a.cast(pa.string()) for a in arrays]
                    yield pa.RecordBatch.from_arrays(text, names=names)

    return contents.select("content").mapInArrow(run, columns)


def arrow_files(spark: SparkSession, paths: list[str], columns: str) -> DataFrame:
    """The same from files, one task per file; they come through Spark's reader, so any store will do."""
    return arrow_rows(spark.read.format("binaryFile").load(paths), columns)


#: Bytes of a zipped dump from which on it is laid out anew.
ZIPPED = 8 << 20


def splittable(spark: SparkSession, path: str, lines: int = 20_000) -> list[str]:
    """Paths with the same lines as the text files at ``path``, each of which several tasks can read.

    A zipped file is a stream that only one task can get through. Such a file from ZIPPED bytes on is read once and written as files of up to ``lines`` whole lines, zipped one by one, in the shared folder; they are found again by the file's
    place, size and time.
    """
    out = []
    for status in stores.listed(spark, path):
        place = status.getPath().toString()
        if not place.endswith(".gz") or status.getLen() < ZIPPED:
            out.append(place)
            continue
        name = hashlib.sha256(f"{place} {status.getLen()} {status.getModificationTime()} {lines}".encode()).hexdigest()
        target = kept(spark, f"lines-{name}")
        if not stores.listed(spark, f"{target}/_SUCCESS"):
            own = shared(spark, "lines")
            spark.read.text(place).write.option("maxRecordsPerFile", lines).text(own, compression="gzip")
            fs, there = stores.place(spark, target)
            if not fs.rename(stores.place(spark, own)[1], there):
                target = own  # another run was faster, and its files may be at work
        out.append(target)
    # a path that names nothing is for the reader to complain of
    return out or [path]


def dump_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(values): literals of the INSERT lines of one table in SQL dumps, zipped or not. Other tables' lines are filtered before any parsing."""
    lines = spark.read.text(splittable(spark, path)).filter(F.startswith("value", F.lit(f"INSERT INTO {table} ")))
    return lines.select(udfs.sql_values("value").alias("values"))


def dump_cwe_tally(spark: SparkSession, path: str) -> DataFrame:
    """(cwe, n) of the classification lines of a dump."""
    pattern = r"INSERT INTO cwe_classification VALUES\('([^']+)','([^']+)'\);"
    found = spark.read.text(splittable(spark, path)).select(F.regexp_extract("value", pattern, 2).alias("cwe")).filter("cwe <> ''")
    return found.groupBy("cwe").agg(F.count("*").alias("n"))


#: Line numbers in a block of an exported document.
BLOCK = 100_000


def export_lines(lines: DataFrame) -> DataFrame:
    """(ord, language, cwd, cwe, has_others) of each sample of an exported document ``lines(file, ord, value)``.

    A group's language line follows its samples, its class line precedes them; a sample's other ids stand before the next sample.
    The state is carried along inside blocks of line numbers; what each block begins and ends with follows from one row a block. So no task holds a file, and the work grows with the lines.
    """
    found = lambda p: F.nullif(F.trim(F.regexp_extract("value", p, 1)), F.lit(""))
    marks = lines.select("file", "ord", F.expr(f"ord div {BLOCK}").alias("block"), found(r"^\s*-?\s+Language:\s*(.+)").alias("lang"), found(r"^\s+- CWD Number:\s*(.+)").alias("number"), found(r"^\s+- CWE:\s*(.+)").alias("cwe"), found(r"^\s+other CWEs\(CWDs\):\s*(.+)").alias("others"))
    inside, whole = Window.partitionBy("file", "block"), Window.partitionBy("file")
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("ord"))
    blocks = marks.groupBy("file", "block").agg(F.max_by("number", at("number")).alias("number"), F.min_by("lang", at("lang")).alias("lang"), F.count("cwe").alias("n"))
    before, after = (whole.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("block", F.desc("block")))
    blocks = blocks.select("file", "block", F.last("number", True).over(before).alias("number_before"), F.last("lang", True).over(after).alias("lang_after"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("samples_before"))
    # the next language line is looked for from the block's end, since a frame that is open towards the end is gone through anew for every row
    marks = marks.withColumn("cwd", F.last("number", True).over(inside.orderBy("ord"))).withColumn("sample", F.count("cwe").over(inside.orderBy("ord"))).withColumn("language", F.last("lang", True).over(inside.orderBy(F.desc("ord"))))
    marks = marks.join(blocks, ["file", "block"]).withColumns({"cwd": F.coalesce("cwd", "number_before"), "language": F.coalesce("language", "lang_after"), "sample": F.col("sample") + F.col("samples_before")})
    per = marks.filter("sample > 0").groupBy("file", "sample").agg(F.min("ord").alias("ord"), F.min_by("language", "ord").alias("language"), F.min_by("cwd", "ord").alias("cwd"), F.min_by("cwe", "ord").alias("cwe"), F.coalesce(F.max(F.col("others").isNotNull() & (F.col("others") != "[]")), F.lit(False)).alias("has_others"))
    return per.select("file", "ord", "language", "cwd", "cwe", "has_others")
