"""Folders of very many files, listed and read by tasks: the driver learns no name of a file.

Spark's own readers gather the status of every file in the driver before a task starts, for each read anew.  Here a folder is listed level by
level, tasks taking the folders of a level, into a staged table of names, and tasks open the files that rows of that table name.
The number of tasks does not grow with the files.  All goes through pyarrow.fs (shared mounts, object stores, HDFS); what it
does not reach is left to Spark's readers."""

from __future__ import annotations

import fnmatch
import io
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.sources.staging import new_folder

#: Names, bytes and lines of a batch, about.
BATCH_NAMES, BATCH_BYTES, BATCH_LINES = 10_000, 4 << 20, 1_000
#: Rows of a task at least, and tasks at most: so many, or so many per core.
TASK_ROWS, TASKS, TASKS_PER_CORE = 32, 64, 4


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri)) if re.match(r"\w+:", uri) else (fs.LocalFileSystem(), uri)


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartition(min(1 + n // TASK_ROWS, max(TASKS, TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)), "path")


def _entries(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, int | None]]:
    """Names and lengths (null: a folder) of what lies in a folder, without what Spark's readers leave out; a stream where that is possible."""
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                if not _hidden(entry.name):
                    yield entry.name, None if entry.is_dir() else entry.stat().st_size
    else:
        for info in system.get_file_info(fs.FileSelector(folder)):
            if not _hidden(info.base_name):
                yield info.base_name, None if info.type == fs.FileType.Directory else info.size


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _lister(folder: str, glob: str) -> Callable:
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        names, sizes = [], []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for name, size in _entries(system, f"{root.rstrip('/')}/{path}"):
                    if size is None or fnmatch.fnmatchcase(name, glob):
                        names.append(f"{path}/{name}" if path else name)
                        sizes.append(size)
                    if len(names) == BATCH_NAMES:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["path", "length"])
                        names, sizes = [], []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["path", "length"])

    return entries


def listed(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """folder, path below it, and length of the files of such names below a folder."""
    folder, staged, kind = folder.rstrip("/"), new_folder(spark, "listing"), "path string, length long"
    level, left, levels = spark.createDataFrame([("",)], "path string"), 1, []
    while left:
        levels.append(f"{staged}/{len(levels)}")
        _dealt(level, left).mapInArrow(_lister(folder, glob), kind).write.parquet(levels[-1])
        level = spark.read.schema(kind).parquet(levels[-1]).filter("length is null").select("path")
        left = level.count()
    return spark.read.schema(kind).parquet(*levels).filter("length is not null").select(F.lit(folder).alias("folder"), "path", "length")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, fs.FileSystem, str]]:
    """folder and path of rows, with the file system and the name to open there."""
    systems: dict = {}
    for batch in batches:
        for folder, path in zip(batch.column("folder").to_pylist(), batch.column("path").to_pylist()):
            if folder not in systems:
                systems[folder] = file_system(folder)
            system, root = systems[folder]
            yield folder, path, system, f"{root.rstrip('/')}/{path}"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(held, pa.binary())], ["path", "content"])

    paths, held, size = [], [], 0
    for folder, path, system, name in _opened(batches):
        with system.open_input_stream(name) as f:
            content = f.read()
        if held and size + len(content) > BATCH_BYTES or len(held) == BATCH_NAMES:
            yield batch()
            paths, held, size = [], [], 0
        paths.append(f"{folder}/{path}")
        held.append(content)
        size += len(content)
    yield batch()


def contents(files: DataFrame) -> DataFrame:
    """path and content of listed files."""
    return _dealt(files.select("folder", "path"), files.count()).mapInArrow(_read, "path string, content binary")


def _text(system: fs.FileSystem, name: str) -> io.TextIOWrapper:
    return io.TextIOWrapper(system.open_input_stream(name), encoding="utf-8-sig", errors="replace")


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = []
        for _, _, system, name in _opened(iter([batch])):
            with _text(system, name) as f:
                heads.append(f.readline().rstrip("\n"))
        yield pa.RecordBatch.from_arrays([batch.column("folder"), batch.column("path"), pa.array(heads, pa.string())], ["folder", "path", "header"])


def headed(files: DataFrame) -> DataFrame:
    """folder, path and first line (header) of listed files, staged.  Files without a byte have none and are left out."""
    spark, files = files.sparkSession, files.filter("length > 0")
    staged, kind = new_folder(spark, "headers"), "folder string, path string, header string"
    _dealt(files.select("folder", "path"), files.count()).mapInArrow(_first, kind).write.parquet(staged)
    return spark.read.schema(kind).parquet(staged)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lines, pa.string())], ["path", "line"])

    paths, lines, size = [], [], 0
    blank = "".join(map(chr, range(33)))
    for folder, path, system, name in _opened(batches):
        with _text(system, name) as f:
            own = (x for line in f if (x := line.rstrip("\n")).strip(blank))
            next(own, None)
            for line in own:
                paths.append(f"{folder}/{path}")
                lines.append(line)
                size += len(line)
                if len(lines) == BATCH_LINES or size > BATCH_BYTES:
                    yield batch()
                    paths, lines, size = [], [], 0
    yield batch()


def lines_below(files: DataFrame) -> DataFrame:
    """path and line: the lines of listed files that are not blank, but for the first of each file."""
    return _dealt(files.select("folder", "path"), files.count()).mapInArrow(_lines, "path string, line string")
