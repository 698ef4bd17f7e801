"""URL filters (operator 8): allow and block entries in a trie over reversed host labels and path segments, broadcast to all
executors; the longest entry that fits an url decides, whether it allows or blocks.

An entry fits its host, all subdomains, and every path that starts with its own path.  Longest means the most host labels,
then the longest path.  An url that no entry fits gets the default verdict (allow: a list blocks what it names).

Defined results.  Null url, or one without "://": host and path are empty and no entry fits.  Empty table: no rows.  Repeated
rows are judged each.  Further columns are ignored.  Very long urls: only as many labels and segments are walked as entries have.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Entries that may be broadcast; a longer list raises.
MAX_RULES = 200_000


@dataclass
class _Node:
    """labels: the next host label (from the right); segments: the next whole path segment; ends: what entries leave over
    of a last, unfinished segment, with their verdicts; sizes: the lengths of these, longest first."""

    labels: dict[str, _Node] = field(default_factory=dict)
    segments: dict[str, _Node] = field(default_factory=dict)
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)


class RuleTrie:
    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        """rules: (verdict, host, path); the path starts with a slash, or is empty to fit any url of the host."""
        self.root, self.empty = _Node(), True
        for n, (verdict, host, path) in enumerate(rules):
            if n >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules; they are not small enough to broadcast")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.labels.setdefault(label, _Node())
            *whole, last = path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, _Node())
            found = node.ends.get(last)
            if found is None or verdict == "block":  # of two equal entries the stricter holds
                node.ends[last] = (host + path, verdict)
            if len(last) not in node.sizes:
                node.sizes = sorted([*node.sizes, len(last)], reverse=True)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    @staticmethod
    def _path(node: _Node, path: str) -> tuple[str, str] | None:
        best, at = None, 0
        while True:
            if node.ends:
                stop = path.find("/", at)
                segment = path[at:] if stop < 0 else path[at:stop]
                # one look-up for each length that entries have here, however many entries there are
                best = next((node.ends[segment[:n]] for n in node.sizes if segment[:n] in node.ends), best)
            stop = path.find("/", at)
            node = node.segments.get(path[at:stop]) if stop >= 0 and node.segments else None
            if node is None:
                return best
            at = stop + 1


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z in lower case; empty for null and for urls without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """The id, host, path, rule (null where no entry fits) and verdict of every row."""
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))
    ids = pages.select(F.col(id_column)).schema[0]
    rows = pages.select(F.col(id_column), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            found = [match(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            rule = pa.array([x and x[0] for x in found], pa.string())
            verdict = pa.array([x[1] if x else default for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], [*batch.schema.names, "rule", "verdict"])

    return rows.mapInArrow(judge, f"`{id_column}` {ids.dataType.simpleString()}, host string, path string, rule string, verdict string")
