"""Delimited text, read untyped."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from agrimill.functions.text import header_names

# A text no file contains: keeps unquoted empty cells NULL and quoted ones ''.
NEVER = "\u0001"


def _accept(spark: SparkSession, encoding: str) -> str:
    """Let the text readers take any charset the JVM knows, not only the standard six."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return encoding


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    names: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Every column as text, header names in snake case.

    Unquoted empty cells are NULL, quoted empty cells ``''``. Columns are matched
    by name: the header lines of all files are read in one job, files of one header
    are one scan, and a column that a file lacks is NULL in its rows. Files without
    a line have no columns and no rows. With ``names``
    all files share that layout and no header is looked at. ``multi_line`` allows
    line ends inside quotes and makes each file one task, so it is off unless a
    source needs it.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("encoding", _accept(spark, encoding))
        .option("quote", '"').option("escape", '"').option("nullValue", NEVER).option("emptyValue", "")
        .option("multiLine", multi_line).option("inferSchema", False).option("mode", "FAILFAST")
        .option("enforceSchema", True)
    )
    paths = [path] if isinstance(path, str) else list(path)
    if names is not None:
        return reader.schema(_texts(names)).csv(paths)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers(spark, _files(spark, paths), sep, encoding):
        layouts.setdefault(tuple(header_names(header)), []).append(_literal(file))
    # A reader keeps the schema once given, so each layout's columns are set right before its scan.
    scans = [reader.schema(_texts(h)).csv(f) for h, f in layouts.items() if h]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans) if scans else spark.createDataFrame([], _texts(()))


def headers(spark: SparkSession, files: Sequence[str], sep: str = ",", encoding: str = "UTF-8") -> list[tuple[str, list[str | None]]]:
    """Each file with the cells of its first line that is not blank, in the order given; one job, whatever the number of files.

    Tasks open the files and read no further than that line; files in a store that only Spark's readers know are looked at
    one by one. Compressed files are known by their endings. A cell without a
    name is None; a name that comes twice gets the place of its column behind it.
    """
    charset = "utf-8-sig" if encoding.lower() in ("utf-8", "utf8") else encoding

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file in batch.column(0).to_pylist():
                try:
                    store, name = fs.FileSystem.from_uri(file) if "://" in file else (fs.LocalFileSystem(), re.sub("^file:", "", file))
                except pa.ArrowInvalid:  # a store that only Spark knows
                    found.append(None)
                    continue
                with store.open_input_stream(name, compression="detect") as data:
                    lines = io.TextIOWrapper(data, charset, newline="")
                    rows = csv.reader(lines, delimiter=sep) if len(sep) == 1 else (line.rstrip("\r\n").split(sep) for line in lines)
                    found.append(next((row for row in rows if any(cell.strip() for cell in row) or len(row) > 1), []))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["file", "cells"])

    if not files:
        return []
    listed = spark.createDataFrame([(f,) for f in files], "file string")
    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    cells = {r["file"]: r["cells"] for r in listed.repartition(tasks, "file").mapInArrow(read, "file string, cells array<string>").collect()}
    first = spark.read.option("header", True).option("sep", sep).option("encoding", _accept(spark, encoding)).option("quote", '"').option("escape", '"')
    return [(f, _named(cells[f]) if cells[f] is not None else [None if re.fullmatch("_c[0-9]+", c) else c for c in first.csv(_literal(f)).columns]) for f in files]


def _named(cells: Sequence[str]) -> list[str | None]:
    lowered = [c.lower() for c in cells]
    return [None if not c else f"{c}{i}" if lowered.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _literal(path: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _texts(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files under paths and patterns, in order of name; their content is not read. One string per file reaches the driver."""
    listed = spark.read.format("binaryFile").load(list(paths)).select("path").collect()
    return sorted({r["path"] for r in listed})


def parse_lines(lines: DataFrame, headers: Sequence[str], sep: str = ",", line: str = "value") -> DataFrame:
    """Text lines to columns: blank lines dropped, names given by the caller."""
    schema = ", ".join(f"`{h}` string" for h in headers)
    options = {"sep": sep, "nullValue": NEVER, "emptyValue": "", "quote": '"', "escape": '"'}
    rest = [c for c in lines.columns if c != line]
    return (
        lines.filter(F.length(F.regexp_replace(F.col(line), "[\r\n]+$", "")) > 0)
        .select(*rest, F.from_csv(F.col(line), schema, options).alias("_row"))
        .select(*rest, "_row.*")
    )


def repair_lines(
    spark: SparkSession, path: str, headers: Sequence[str], sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """File with a broken header line: names replaced, blank lines dropped, any charset.

    A line of separators only is a row of NULLs, not a blank line.
    """
    return (
        spark.read.option("header", True).option("enforceSchema", True).option("sep", sep).option("encoding", _accept(spark, encoding))
        .option("quote", '"').option("escape", '"').option("nullValue", NEVER).option("emptyValue", "")
        .schema(StructType([StructField(h, StringType()) for h in headers]))
        .csv(path)
    )


def positional(lines: DataFrame, columns: Sequence[str], sep: str = ";", line: str = "value") -> DataFrame:
    """Headerless lines: quotes stripped, split on the separator, empty cells NULL."""
    cells = F.split(F.replace(F.col(line), F.lit('"'), F.lit("")), sep, -1)
    rest = [c for c in lines.columns if c != line]
    return lines.select(*rest, cells.alias("_cells")).select(
        *rest, *[F.nullif(F.get(F.col("_cells"), i), F.lit("")).alias(c) for i, c in enumerate(columns)]
    )


def read_positional(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";", encoding: str = "windows-1252"
) -> DataFrame:
    """``positional`` over files in the given charset; the split stays on the executors."""
    lines = (
        spark.read.option("sep", NEVER).option("quote", "").option("encoding", _accept(spark, encoding))
        .schema("value string").csv(path)
    )
    return positional(lines, columns, sep)


def read_enterprises(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], codes: Sequence[str], code_col: str
) -> DataFrame:
    """Register extract: a few columns of many, ``-`` as NULL, activity codes filtered."""
    df = read_delimited(spark, path)
    dashed = [F.nullif(F.nullif(F.col(c), F.lit("-")), F.lit("")).alias(c) for c in columns]
    return df.select(*dashed).filter(F.col(code_col).isin(*codes))
