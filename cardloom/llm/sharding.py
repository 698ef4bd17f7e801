"""Sharding (operator 9): indivisible groups, sorted by size, enter the tightest remaining-capacity bin through a balanced tree.

Groups are documents of equal text, and no group is ever split.  Where best-fit-decreasing puts a group depends on its size alone,
so the driver gets the different sizes with the number of groups of each, places them as runs - a bin that takes one of several equal groups
takes as many as fit - and the groups of a size are handed out to its runs by their number among these.  Two numbers per
different size reach the driver; of more than MAX_SIZES sizes, rounded ones do.  For a fixed number of shards, a group above the fair
share of what is left gets a shard alone, and the capacity of the others is the smallest (found by bisection) at which
best-fit-decreasing needs no more shards than there are: apart from such groups, sizes come out near equal.

Defined results.  Null text counts as empty: size 8, crc32 0, one group with the empty texts.  Repeated rows are rows of their
own, in the shard of their group.  Empty table: no rows.  Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import bounded_rows, spread_join, staged

#: Different sizes of groups that the driver takes (some 500 bytes each there).  Where there are more, sizes are rounded up to multiples of a
#: power of two for placing.
MAX_SIZES = 500_000
#: Keys with the number of their cells up to which these are broadcast.
BROADCAST_KEYS = 100_000
#: Rows of a cell, which one task numbers, about.
CELL_ROWS = 20_000


class RoomTree:
    """A balanced search tree (AA tree) of bins by (remaining capacity, bin): insert, and take out the tightest that has room."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root = None  # nodes are [key, level, left, right]

    def insert(self, key: tuple[int, int]) -> None:
        self.root = self._insert(self.root, key)

    def pop_tightest(self, room: int) -> tuple[int, int] | None:
        """The smallest key with at least so much room, taken out; None if there is none."""
        node, found = self.root, None
        while node:
            if node[0] >= (room, -1):
                found, node = node[0], node[2]
            else:
                node = node[3]
        if found is not None:
            self.root = self._delete(self.root, found)
        return found

    @staticmethod
    def _skew(n):
        if n and n[2] and n[2][1] == n[1]:
            left = n[2]
            n[2], left[3] = left[3], n
            return left
        return n

    @staticmethod
    def _split(n):
        if n and n[3] and n[3][3] and n[1] == n[3][3][1]:
            right = n[3]
            n[3], right[2] = right[2], n
            right[1] += 1
            return right
        return n

    def _insert(self, n, key):
        if n is None:
            return [key, 1, None, None]
        side = 2 if key < n[0] else 3
        n[side] = self._insert(n[side], key)
        return self._split(self._skew(n))

    def _delete(self, n, key):
        if key < n[0]:
            n[2] = self._delete(n[2], key)
        elif key > n[0]:
            n[3] = self._delete(n[3], key)
        elif n[2] is None:
            return n[3]
        elif n[3] is None:
            return n[2]
        else:
            heir = n[3]
            while heir[2]:
                heir = heir[2]
            n[0] = heir[0]
            n[3] = self._delete(n[3], heir[0])
        lower = min(n[2][1] if n[2] else 0, n[3][1] if n[3] else 0) + 1
        if lower < n[1]:
            n[1] = lower
            if n[3] and n[3][1] > lower:
                n[3][1] = lower
        n = self._skew(n)
        n[3] = self._skew(n[3])
        if n[3]:
            n[3][3] = self._skew(n[3][3])
        n = self._split(n)
        n[3] = self._split(n[3])
        return n


#: Runs of equal items: size, and how many have it.
Runs = list[tuple[int, int]]


def best_fit_decreasing(runs: Runs, capacity: int, most: float = math.inf) -> list[list[tuple[int, int]]] | None:
    """For each run, in decreasing order of size, the (bin, how many) that its items go to; None as soon as more than so many bins are
    needed.  An item above the capacity has a bin alone."""
    tree, bins, out = RoomTree(), 0, []
    for size, count in runs:
        placed = []
        while count:
            if found := tree.pop_tightest(size):
                room, b = found
            else:
                if bins >= most:
                    return None
                room, b, bins = max(capacity, size), bins, bins + 1
            taken = min(count, room // size)  # the tightest bin stays the tightest until it has no room for another
            placed.append((b, taken))
            count -= taken
            tree.insert((room - taken * size, b))
        out.append(placed)
    return out


def level_shards(runs: Runs, shards: int) -> list[list[tuple[int, int]]]:
    """Bins 0 to shards-1 for the items of the runs (largest first).  An item above the fair share of what is left has a bin alone, the last
    ones first; the rest goes into the other bins at the smallest capacity at which best-fit-decreasing needs no more of them."""
    total = sum(size * count for size, count in runs)
    alone: list[list[tuple[int, int]]] = []
    rest = list(runs)
    while rest and shards > 1 and rest[0][0] * shards > total:
        size, count = rest[0]
        own = []
        while count and shards > 1 and size * shards > total:
            shards, total, count = shards - 1, total - size, count - 1
            own.append((shards, 1))
        alone.append(own)
        if count:
            rest[0] = (size, count)
            break
        rest.pop(0)
    placed = _leveled(rest, shards, total)
    if len(alone) + len(rest) > len(runs):  # some of one size alone, the others not
        placed[0] = alone.pop() + placed[0]
    return alone + placed


def _leveled(runs: Runs, shards: int, total: int) -> list[list[tuple[int, int]]]:
    if not runs:
        return []
    low = max(-(-total // shards), runs[0][0])
    high, best = low, best_fit_decreasing(runs, low, shards)
    while best is None:
        low, high = high + 1, high + max(1, high // 200)
        best = best_fit_decreasing(runs, high, shards)
    while high - low > max(1, high // 20_000):
        mid = (low + high) // 2
        if (found := best_fit_decreasing(runs, mid, shards)) is None:
            low = mid + 1
        else:
            high, best = mid, found
    return _spread(runs, best, shards)


def _spread(runs: Runs, placed: list[list[tuple[int, int]]], shards: int) -> list[list[tuple[int, int]]]:
    """placed, with bins that were left empty taking about half of the fullest bin of more than one item.  Few large items may need fewer
    bins at a capacity than there are."""
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for run, parts in enumerate(placed):
        for b, n in parts:
            held[b][run] = held[b].get(run, 0) + n
    load = [sum(runs[r][0] * n for r, n in own.items()) for own in held]
    for empty in [b for b in range(shards) if not held[b]]:
        full = max((b for b in range(shards) if sum(held[b].values()) > 1), key=lambda b: (load[b], -b), default=None)
        if full is None:
            break
        for run in sorted(held[full], key=lambda r: -runs[r][0]):
            size, n = runs[run][0], held[full][run]
            moved = min(n, max(0, (load[full] - load[empty]) // (2 * size)) or (not held[empty]))
            if moved and sum(held[full].values()) > moved:
                held[empty][run] = moved
                held[full][run] -= moved
                load[full], load[empty] = load[full] - moved * size, load[empty] + moved * size
    return [[(b, own[run]) for b, own in enumerate(held) if own.get(run)] for run in range(len(runs))]


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def shard_documents(docs: DataFrame, shards: int = 24, row_overhead: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document; slots are gapless from 0 in each shard, in an order of hashes."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.sha2(text.cast("binary"), 256)
    rows = staged(
        docs.select(
            F.col("doc_id"), (text_bytes(F.col("text")) + row_overhead).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.conv(F.substring(sha, 1, 15), 16, 10).cast("long").alias("_g1"), F.conv(F.substring(sha, 16, 15), 16, 10).cast("long").alias("_g2"), F.monotonically_increasing_id().alias("_row"),
        ),
        "sizes",
    )
    groups = staged(rows.groupBy("_g1", "_g2").agg(F.sum("size").alias("_bytes"), F.count("*").alias("k")), "groups")
    sizes, step = staged(groups.groupBy("_bytes").agg(F.count("*").alias("n")), "group-sizes"), 1
    stepped = lambda: F.ceil(F.col("_bytes") / step) * step
    while sizes.select(stepped()).distinct().count() > MAX_SIZES:
        step *= 2
    if step > 1:
        groups = groups.withColumn("_bytes", stepped())
    known = sorted(((r["_bytes"], r["n"]) for r in bounded_rows(sizes.groupBy(stepped().alias("_bytes")).agg(F.sum("n").alias("n")), MAX_SIZES, "the list of different sizes")), reverse=True)
    placed = level_shards(known, shards)
    runs = []
    for (size, _), parts in zip(known, placed):
        starts = 0
        for b, n in parts:
            runs.append((size, starts, starts + n, b))
            starts += n
    table = spark.createDataFrame(runs, "_bytes long, _from long, _to long, _shard int")
    cells = numbered(groups, "_bytes", [F.col("_g1"), F.col("_g2")])
    # a cell has one size and about CELL_ROWS groups, so no task gets all groups of a common size
    reach = cells.groupBy("_bytes", "_part").agg(F.min("_number").alias("_first"), F.max("_number").alias("_last"))
    met = reach.join(table, "_bytes").filter("_first < _to and _last >= _from").select("_bytes", "_part", "_from", "_to", "_shard")
    homes = cells.join(met, ["_bytes", "_part"]).filter("_number >= _from and _number < _to").select("_g1", "_g2", "k", F.col("_shard").alias("shard"))
    at = spread_join(rows, homes, ["_g1", "_g2"], rows.count()).select("doc_id", "size", "text_crc32", "shard", "_row")
    return numbered(at, "shard", [F.col("_row")]).select("doc_id", "size", "text_crc32", "shard", F.col("_number").alias("slot"))


def numbered(rows: DataFrame, key: str, distinct: list[Column]) -> DataFrame:
    """rows with _part and _number, gapless from 0 under each key, without a sort of a whole key: rows are dealt to cells by a hash
    of columns that tell them apart, numbered inside, and each cell starts where the cells of its key before it end."""
    rows = staged(rows, "numbered")
    counts = staged(rows.groupBy(key).agg(F.count("*").alias("_k")).withColumn("_parts", F.ceil(F.col("_k") / CELL_ROWS)), "parts")
    hashed = rows.withColumn("_hash", F.xxhash64(*distinct))
    if counts.count() <= BROADCAST_KEYS:
        parts = hashed.join(F.broadcast(counts.drop("_k")), key)
    else:
        parts = spread_join(hashed, counts, key, rows.count(), "_k")
    dealt = staged(parts.withColumn("_part", F.pmod("_hash", "_parts").cast("int")).drop("_hash", "_parts"), "dealt")
    cells = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    starts = cells.withColumn("_start", F.sum("_n").over(Window.partitionBy(key).orderBy("_part")) - F.col("_n")).drop("_n")
    number = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*distinct)) - 1
    return dealt.withColumn("_own", number).join(starts, [key, "_part"]).withColumn("_number", F.col("_start") + F.col("_own")).drop("_own", "_start")
