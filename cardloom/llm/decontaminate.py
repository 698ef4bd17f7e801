"""Benchmark decontamination (operator 6): pigeonhole edit matching of test items inside documents.

An item of n normalised characters may differ from its place in a document by k = n // CHARS_PER_ERROR edits.  It is split into
k + 1 pieces (an item of under LEAST_CHARS characters is one piece that must be found between word borders); by the pigeonhole principle a place within the budget holds one piece unchanged.  All pieces are looked for at once
(Aho-Corasick), and every hit is verified around its diagonal by Myers' bit-parallel edit distance.  Normalised: lower case, and
runs of anything but letters and digits are one space.

The benchmark is a stated query set: its items are taken in blocks of about BLOCK_CHARS characters (one, for any usual benchmark),
dealt by a hash and dealt again where a block turns out above twice that, and each block is broadcast and run against all documents, which are read whole and never shuffled.

Defined results.  Null and empty texts match nothing.  Items without a letter or digit match nothing, and those with a
null item_id are searched like others.  Repeated rows are searched each; of one item's overlapping places in a document the best is
kept, the first of ties.  Empty tables: no rows.  Further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import trim_memory, with_small_batches

CHARS_PER_ERROR = 18
#: Normalised characters below which an item has no error budget and is found only as whole words.
LEAST_CHARS = 24
#: Characters of items in a block: an automaton of so many takes some 200 MB of a Python worker.
BLOCK_CHARS = 2_000_000

_GAP = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")


def normalised(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


class Pattern:
    """An item, its error budget, and what Myers' algorithm needs of it."""

    def __init__(self, text: str) -> None:
        self.text, self.size = text, len(text)
        self.budget = self.size // CHARS_PER_ERROR if self.size >= LEAST_CHARS else 0
        self.masks = self._masks(text)
        self.back = self._masks(text[::-1])

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        out: dict[str, int] = {}
        for i, c in enumerate(text):
            out[c] = out.get(c, 0) | 1 << i
        return out

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece) of the budget + 1 pieces."""
        n = self.budget + 1
        cuts = [self.size * i // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]

    def best_end(self, text: str, masks: dict[str, int], free_start: bool) -> tuple[int, int]:
        """The least edit distance of the whole pattern to a part of text, and the first end of such a part.  The part may begin
        anywhere, or (not free_start) at the beginning only."""
        full, high = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        best, end = score, 0
        for i, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
            up = (up << 1) & full if free_start else ((up << 1) | 1) & full
            down = (down << 1) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            if score < best:
                best, end = score, i
        return best, end

    def place(self, text: str) -> tuple[int, int, int] | None:
        """(distance, start, end) of the best part of text within the budget."""
        distance, end = self.best_end(text, self.masks, True)
        if distance > self.budget:
            return None
        _, length = self.best_end(text[:end][::-1], self.back, False)
        return distance, end - length, end


class Matcher:
    def __init__(self, items: list[tuple[int | None, str]]) -> None:
        import ahocorasick

        self.items = [(i, Pattern(t)) for i, t in items if t]
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, pattern) in enumerate(self.items):
            for offset, piece in pattern.pieces():
                where.setdefault(piece, []).append((n, offset))
        self.tree = ahocorasick.Automaton()
        for piece, places in where.items():
            self.tree.add_word(piece, (len(piece), places))
        if where:
            self.tree.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the places of items in a normalised text, without overlapping ones of one item."""
        if not self.items:
            return []
        hits: dict[int, set[int]] = {}
        for stop, (size, places) in self.tree.iter(text):
            for n, offset in places:
                hits.setdefault(n, set()).add(stop + 1 - size - offset)
        out = []
        for n, starts in hits.items():
            item, pattern = self.items[n]
            k = pattern.budget
            found: list[tuple[int, int, int]] = []
            last = None
            if pattern.size < LEAST_CHARS:
                borders = (x for x in sorted(starts) if (not x or text[x - 1] == " ") and text[x + pattern.size : x + pattern.size + 1] in ("", " "))
                out += [(item, 0, x, x + pattern.size) for x in borders]
                continue
            for start in sorted(starts):  # where the item would begin without insertions and deletions before the piece
                if last is not None and start - last <= k:
                    continue  # the wider margin of the last window covers it
                last = start
                low = max(0, start - 2 * k - 1)
                if place := pattern.place(text[low : start + pattern.size + 3 * k + 1]):
                    found.append((place[0], low + place[1], low + place[2]))
            kept: list[tuple[int, int, int]] = []
            for x in sorted(found):
                if all(x[1] >= y[2] or x[2] <= y[1] for y in kept):
                    kept.append(x)
            out += [(item, *x) for x in kept]
        return out


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where in a text the part start:end of its normalised form lies."""
    at, first, last = 0, None, 0
    lowered = text.lower()
    for word in _WORD.finditer(lowered):
        size = word.end() - word.start()
        if first is None and at + size > start:
            first = word.start() + max(0, start - at)
        if at < end:
            last = word.start() + min(size, end - at)
        else:
            break
        at += size + 1
    first = first or 0
    if len(lowered) != len(text):  # a letter became two: find the letters of the text that these come from
        ends = list(accumulate(len(c.lower()) for c in text))
        first, last = bisect_right(ends, first), bisect_left(ends, last) + 1 if last else 0
    return first, last


def _blocks(benchmark: DataFrame) -> Iterator[list]:
    """The items in blocks of about BLOCK_CHARS characters."""
    size = F.coalesce(F.length("text"), F.lit(0))
    total = benchmark.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    dealt = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-total // BLOCK_CHARS)))).alias("block"))
    for r in dealt.groupBy("block").agg(F.sum(size).alias("chars"), F.count("*").alias("items")).orderBy("block").collect():  # one row per block
        own = dealt.filter(F.col("block") == r["block"])
        parts = -(-r["chars"] // BLOCK_CHARS) if r["chars"] > 2 * BLOCK_CHARS and r["items"] > 1 else 1
        for part in range(parts):
            yield own.filter(F.pmod(F.xxhash64("text", F.lit("again")), F.lit(parts)) == part).select("item_id", "text").distinct().collect()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, start, end (characters of the text) and budget of every place of an item in a document."""
    spark = docs.sparkSession
    rows = with_small_batches(docs).select(F.col("doc_id").cast("long"), "text")
    out = None
    for own in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(sorted({(r["item_id"], normalised(r["text"])) for r in own}, key=lambda x: (x[0] is None, x[0] or 0, x[1])))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            budget = {n: p.budget for n, p in matcher.items}
            for batch in batches:
                found: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if text:
                        for item, distance, start, end in matcher.find(normalised(text)):
                            found.append((doc, item, distance, *original_span(text, start, end), budget[item]))
                if found:
                    columns = list(zip(*found))
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "distance", "start", "end", "budget"])
            del matcher
            trim_memory()

        part = rows.mapInArrow(search, "doc_id long, item_id long, distance int, start long, end long, budget int")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, distance int, start long, end long, budget int")
