"""CSV tables by their headers: files whose columns differ in order or in number become one frame, united by name.

The first line of every file is found by one scan of the lines (a row per file leaves each task), files of the same header are read by one
scan with the columns of that header, and the scans are united by name.  So there are as many scans as different headers, however many
files there are, and no value gets into a column that its header does not name.  Cells stay text until a caller says what they
are (`typed`) or lets their widest common type be found (`widened`); a number with leading zeros is never read as a number by default."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.functions import text as X
from cardloom.sources.many_files import headed, lines_below

#: Columns beside those of the files: the line of a row whose number of cells is not the header's, and the file of a row.
CORRUPT, FILE = "_corrupt_record", "_file"


def first_lines(spark: SparkSession, *paths: str, glob: str = "*.csv", least_bytes: int = 0) -> DataFrame:
    """path, header: the first line of every file below the paths that has more than so many bytes."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(list(paths))
    at = lines.select("value", "_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    own = at.filter((F.col("file_block_start") == 0) & (F.col("file_size") > least_bytes))
    return own.groupBy(F.col("file_path").alias("path")).agg(F.min_by("value", "n").alias("header"))


def header_names(header: str) -> list[str]:
    """Names of a header's cells.  An empty one is named by its place, a repeated one gets a number."""
    out: list[str] = []
    for n, name in enumerate(next(csv.reader([header.removeprefix("﻿")]), [])):
        name, again = name or f"column_{n + 1}", 0
        while (name if not again else f"{name}_duplicated_{again - 1}") in out:
            again += 1
        out.append(name if not again else f"{name}_duplicated_{again - 1}")
    return out


def _output_names(headers: list[list[str]], known: list[str]) -> dict[str, str]:
    """The column for every name.  Names are told apart by case, columns are not: of two that differ in case alone, the one that is
    known, or else first in order, keeps its name."""
    out: dict[str, str] = {}
    taken = {CORRUPT, FILE}
    for name in [*known, *sorted({n for h in headers for n in h} - {*known})]:
        column, again = name, 1
        while column.lower() in taken:
            again += 1
            column = f"{name}_{again}"
        taken.add(column.lower())
        out[name] = column
    return out


#: How the lines of a file become rows, for the reader of files and for that of lines.
_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def tables_by_header(spark: SparkSession, *paths: str, glob: str = "*.csv", known: tuple[str, ...] = (), least_bytes: int = 0, multiline: bool = False) -> DataFrame:
    """All rows of the CSV files below the paths, every cell as text: the columns that any of them has (null where a file has not), the known
    ones, and CORRUPT and FILE.  A row of more or fewer cells than its header keeps those it has, and its line in CORRUPT.
    multiline: cells may hold line breaks, so that files are not split.  The driver learns the names of all files (`tables_of` for very many)."""
    found = first_lines(spark, *paths, glob=glob, least_bytes=least_bytes).groupBy("header").agg(F.collect_list("path").alias("files")).orderBy("header").collect()
    files = {row["header"]: row["files"] for row in found}

    def read(header: str, schema: T.StructType) -> DataFrame:
        reader = spark.read.schema(schema).options(**_OPTIONS).option("header", True).option("columnPruning", False).option("multiLine", multiline)
        return reader.csv(files[header]).select("*", F.col("_metadata.file_path").alias(FILE))

    return _united(spark, list(files), known, read)


def tables_of(files: DataFrame, known: tuple[str, ...] = (), least_bytes: int = 0) -> DataFrame:
    """The rows of `tables_by_header`, for listed files (`many_files.listed`) of which there may be millions: only the different headers get to the
    driver.  Cells hold no line breaks."""
    own = headed(files.filter(F.col("length") > least_bytes))
    texts = [r["header"] for r in own.select("header").distinct().orderBy("header").collect()]

    def read(header: str, schema: T.StructType) -> DataFrame:
        ddl = ", ".join(f"{f.name} string" for f in schema.fields)
        lines = lines_below(own.filter(F.col("header") == header))
        return lines.select(F.from_csv("line", ddl, _OPTIONS).alias("row"), F.col("path").alias(FILE)).select("row.*", FILE)

    return _united(files.sparkSession, texts, known, read)


def _united(spark: SparkSession, texts: list[str], known: tuple[str, ...], read: Callable[[str, T.StructType], DataFrame]) -> DataFrame:
    """What read gives for each header (c0 and on, CORRUPT, FILE), united by the names of the columns."""
    headers = [header_names(text) for text in texts]
    columns = _output_names(headers, list(known))
    frames = []
    for text, names in zip(texts, headers):
        schema = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(names))] + [T.StructField(CORRUPT, T.StringType())])
        frames.append(read(text, schema).select(*[F.col(f"c{n}").alias(columns[name]) for n, name in enumerate(names)], CORRUPT, FILE))
    if not frames:
        frames = [spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in (CORRUPT, FILE)]))]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    missing = [c for c in columns.values() if c not in out.columns]
    return out.select(*[F.lit(None).cast("string").alias(c) if c in missing else F.col(f"`{c}`") for c in [*columns.values(), CORRUPT, FILE]])


def _as(kind: T.DataType, cell: Column) -> Column:
    return X.as_integer(cell) if isinstance(kind, T.LongType) else X.as_text(cell) if isinstance(kind, T.StringType) else F.trim(cell).try_cast(kind)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """rows with the columns of the schema first and of its types (a cell that does not parse is null), the others as they are."""
    own = schema.fieldNames()
    first = [(_as(f.dataType, F.col(f.name)) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return rows.select(*first, *[F.col(f"`{c}`") for c in rows.columns if c not in own])


def widened(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """rows with each text column, but those to keep, as the narrowest of long, double and string that holds all of its cells in all
    files; one aggregate over the rows finds that.  Empty cells are null and fit any."""
    asked = [c for c, kind in rows.dtypes if kind == "string" and c not in (*keep, CORRUPT, FILE)]
    if not asked:
        return rows
    cell = {c: X.as_text(F.col(f"`{c}`")) for c in asked}
    misfits = lambda c, kind: F.count_if(cell[c].isNotNull() & F.trim(cell[c]).try_cast(kind).isNull())
    seen = rows.agg(*[misfits(c, kind).alias(f"{kind}{n}") for n, c in enumerate(asked) for kind in ("long", "double")]).first()
    kinds = {c: next((kind for kind in ("long", "double") if seen[f"{kind}{n}"] == 0), None) for n, c in enumerate(asked)}
    return rows.select(*[(F.trim(cell[c]).try_cast(kinds[c]) if kinds.get(c) else cell[c]).alias(c) if c in cell else F.col(f"`{c}`") for c in rows.columns])


def csv_report(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Per file: rows, corrupt ones (of more or fewer cells than the header), and cells that are not of the schema's type."""
    bad = [(X.as_text(F.col(f.name)).isNotNull() & _as(f.dataType, F.col(f.name)).isNull()).cast("long") for f in schema.fields if f.name in rows.columns and not isinstance(f.dataType, T.StringType)]
    return rows.groupBy(FILE).agg(F.count("*").alias("rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"), F.coalesce(F.sum(reduce(lambda a, b: a + b, bad, F.lit(0).cast("long"))), F.lit(0)).alias("bad_cells"))
