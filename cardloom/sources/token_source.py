"""Page files as a table of tokens: a data source for spark.read, with one task for each range of files.

The reader is a function from (doc, page, content) to the tokens of a page: (text, confidence, bbox) each.  Filters on doc and page are pushed
into the source and decide which files are opened, so a job for some pages reads those alone.  That needs
spark.sql.python.filterPushdown.enabled, which read_pages sets in the session.
A page on which the reader fails has one row without text, with the error beside it.  Folders are listed, and files read, by
pyarrow.fs, which reaches the common shared file systems."""

from __future__ import annotations

import importlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from cardloom.sources.tokens import TOKEN_TABLE


def read_pages(spark: SparkSession, folder: str, reader: str | None = None, pattern: str | None = None) -> DataFrame:
    """The token table of the page files below a folder.  reader: module:function; pattern: of file names, with the page in its first group."""
    spark.dataSource.register(PageTokens)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {k: v for k, v in (("path", folder), ("reader", reader), ("pattern", pattern)) if v is not None}
    return spark.read.format("page_tokens").options(**options).load()


#: Bytes and files of a task, at most (a larger file is a task alone).
TASK_BYTES, TASK_FILES = 64 << 20, 256


@dataclass
class Files(InputPartition):
    """doc, page and path of the files of a task."""

    files: list[tuple[str, int, str]]


def text_lines(doc: str, page: int, content: bytes) -> Iterator[tuple[str, float, list]]:
    """A reader for synthetic pages: each line of the content is 'x y text', as a token 40 wide and 12 high."""
    for line in content.decode().splitlines():
        x, y, text = line.split(" ", 2)
        x0, y0 = float(x), float(y)
        yield text, 0.99, [[x0, y0], [x0 + 40, y0], [x0 + 40, y0 + 12], [x0, y0 + 12]]


class PageTokens(DataSource):
    """Options: path (a folder), reader (module:function), pattern (of file names, the page in its first group)."""

    @classmethod
    def name(cls) -> str:
        return "page_tokens"

    def schema(self) -> str:
        return TOKEN_TABLE

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"], self.options.get("reader", f"{__name__}:text_lines"), self.options.get("pattern", r"page(\d+)\.\w+"))


class PageReader(DataSourceReader):
    def __init__(self, path: str, reader: str, pattern: str) -> None:
        self.path, self.reader_name, self.pattern = path, reader, pattern
        self.wanted: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of doc and page with constants are all this source can decide; it decides them wholly."""
        for f in filters:
            if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, IsNotNull)) and f.attribute in (("doc",), ("page",)):
                self.wanted.append(f)
            else:
                yield f

    def _asked(self, doc: str, page: int) -> bool:
        own = {("doc",): doc, ("page",): page}
        tests = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b}
        return all(isinstance(f, IsNotNull) or f.value is not None and tests[type(f)](own[f.attribute], f.value) for f in self.wanted)

    def partitions(self) -> list[Files]:
        """Files in order of path, in tasks of bounded size; the name of the folder is the doc."""
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", self.path)) if re.match(r"\w+:", self.path) else (fs.LocalFileSystem(), self.path)
        out, held, size = [], [], 0
        for info in sorted(system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)), key=lambda x: x.path):
            found = re.fullmatch(self.pattern, info.base_name)
            doc = info.path.rsplit("/", 2)[-2] if "/" in info.path else ""
            if info.type != fs.FileType.File or not found or not self._asked(doc, int(found[1])):
                continue
            if held and (size + info.size > TASK_BYTES or len(held) == TASK_FILES):
                out.append(Files(held))
                held, size = [], 0
            held.append((doc, int(found[1]), info.path))
            size += info.size
        return [*out, Files(held)] if held else out or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        from pyarrow import fs

        module, _, function = self.reader_name.partition(":")
        tokens_of = getattr(importlib.import_module(module), function)
        system = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", self.path))[0] if re.match(r"\w+:", self.path) else fs.LocalFileSystem()
        for doc, page, path in partition.files:
            try:
                with system.open_input_file(path) as f:
                    found = list(tokens_of(doc, page, f.read()))
            except Exception as e:  # noqa: BLE001  whatever a reader raises concerns one page
                yield doc, page, 0, None, 0.0, None, f"{type(e).__name__}: {e}"
                continue
            for seq, (text, confidence, bbox) in enumerate(found):
                yield doc, page, seq, text, confidence, bbox, None
