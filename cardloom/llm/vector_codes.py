"""Vector code compression (operator 13): parts of a vector become numbers of codebook entries, with nearest entries found by
segment-mean lower bounds.

Components become integers, floor(SCALE * x), and a vector is cut into PARTS equal consecutive parts, each with a codebook of its own.
The nearest entry of a part (squared Euclidean distance, ties to the lower index) is found coarse to fine: on each level a part and an
entry are cut into blocks, whose sums and residual norms bound the distance from below,
    |x - c|^2 >= sum over blocks of (sum_x - sum_c)^2 / n + (|residual of x| - |residual of c|)^2,
entries whose bound exceeds the exact distance to the entry of the least coarse bound are dropped, and the survivors of the finest level
get exact integer distances.  Bounds are floats lowered by more than their rounding, so that no nearest entry is dropped.

Spark makes one pass over the vectors for each round: tasks assign their rows and give back a sum and a count per entry, at most PARTS *
ENTRIES rows a task, which are summed by key; the codebooks themselves, a constant number of entries, go to the driver and back.

Defined results.  A null vector and one with a null or non-finite component are dropped.  The width of the table is that of the kept
vector with the smallest vec_id; vectors of another width are dropped too, and so are empty ones.  A width that PARTS does not divide is
filled up with zeros, which change no distance.  Components count as at most limit(width) in absolute value (2^27 for 64
components), so that sums of squares fit into 64 bits.  Repeated rows and repeated vec_ids: each row is a vector of its own; among equal
vec_ids those with the smaller vector come first, null vec_ids last.  Under ENTRIES kept vectors: as many entries as vectors.  No kept
vector: no rows.  Null labels are one label.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import spread_join, staged, trim_memory

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors whose parts are compared with the entries at once.
BLOCK_ROWS = 4096
#: Different labels up to which their sums are broadcast.
BROADCAST_LABELS = 100_000


def limit(width: int, parts: int = PARTS) -> int:
    """The largest absolute value of a component for which neither an error over all parts nor a block's sum squared leaves 63 bits."""
    each = -(-width // parts)
    bits = min((61 - math.ceil(math.log2(max(1, each * parts)))) // 2, 31 - math.ceil(math.log2(each)) - 1)
    return 1 << max(1, bits)


def quantized(vectors: np.ndarray, parts: int = PARTS, scale: int = SCALE) -> np.ndarray:
    """Integers of finite vectors (rows of equal width), as rows x parts x components of a part."""
    rows, width = vectors.shape
    each = -(-width // parts)
    most = limit(width, parts)
    out = np.zeros((rows, parts * each), np.int64)
    with np.errstate(over="ignore"):
        out[:, :width] = np.floor(np.clip(vectors.astype(np.float64) * scale, -most, most))
    return out.reshape(rows, parts, each)


def levels(each: int) -> list[np.ndarray]:
    """Where the blocks of a part begin, from one block to blocks of two components."""
    counts, n = [], 1
    while not counts or (n <= each // 2 and n < each):
        counts.append(np.unique(np.arange(n) * each // n))
        n *= 2
    return counts


class Bounds:
    """Sums and residual norms of the blocks of parts (rows x components) on one level."""

    def __init__(self, x: np.ndarray, starts: np.ndarray) -> None:
        self.size = np.diff(np.append(starts, x.shape[1]))
        self.sums = np.add.reduceat(x, starts, axis=1)
        squares = np.add.reduceat(x * x, starts, axis=1)
        self.norms = np.sqrt((squares * self.size - self.sums * self.sums).astype(np.float64) / self.size)

    def below(self, rows, other: Bounds, entries) -> np.ndarray:
        """Lower bounds of the distances of rows to entries (index arrays that broadcast), never above the true ones."""
        gap = np.abs(self.norms[rows] - other.norms[entries]) - 1e-12 * (self.norms[rows] + other.norms[entries])
        between = (self.sums[rows] - other.sums[entries]).astype(np.float64)
        return (between * between / self.size + np.square(np.maximum(gap, 0))).sum(axis=-1) * (1 - 1e-12)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of x (rows x components) the index of its nearest entry, the exact squared distance, and how many exact distances
    were needed in all."""
    rows = np.arange(len(x))
    at = levels(x.shape[1])
    own, other = Bounds(x, at[0]), Bounds(entries, at[0])
    coarse = own.below(rows[:, None], other, np.arange(len(entries))[None, :])
    first = coarse.argmin(axis=1)
    most = np.square(x - entries[first]).sum(axis=1)
    row, entry = np.nonzero(coarse <= most[:, None])
    for starts in at[1:]:
        own, other = Bounds(x, starts), Bounds(entries, starts)
        keep = own.below(row, other, entry) <= most[row]
        row, entry = row[keep], entry[keep]
    exact = np.square(x[row] - entries[entry]).sum(axis=1)
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))  # every row keeps its nearest entry at least
    least = np.minimum.reduceat(exact, begin)
    hit = np.flatnonzero(exact == np.repeat(least, np.diff(np.append(begin, len(row)))))
    hit = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
    return entry[hit], least, len(row) + len(x)


@dataclass(frozen=True)
class Codebooks:
    """entries: parts x entries x components, integers.  width: components of a vector."""

    entries: np.ndarray
    width: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers of entries (rows x parts), summed distances, and how many exact distances that took."""
        codes, error, exact = np.zeros(x.shape[:2], np.uint8), np.zeros(len(x), np.int64), 0
        for part in range(x.shape[1]):
            own, distance, some = nearest(np.ascontiguousarray(x[:, part]), self.entries[part])
            codes[:, part] = own
            error += distance
            exact += some
        return codes, error, exact

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The integer vectors that codes (rows x parts) stand for."""
        return np.concatenate([self.entries[p][codes[:, p]] for p in range(codes.shape[1])], axis=1)[:, : self.width]


def kept_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector has components, all of them finite."""
    x = F.col(column)
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return vectors.filter(x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, bad))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal width as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def fit(kept: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """The codebooks of all kept vectors; None without any."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number has to fit into a byte")
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), column).select(column).limit(entries).collect()
    if not seeds:
        return None
    width = len(seeds[0][0])
    # seeds of another width give way to the next vectors of the right one
    if any(len(r[0]) != width for r in seeds):
        seeds = kept.filter(F.size(column) == width).orderBy(F.col("vec_id").asc_nulls_last(), column).select(column).limit(entries).collect()
    books = Codebooks(quantized(np.array([r[0] for r in seeds], np.float64), parts).transpose(1, 0, 2).copy(), width)
    rows = kept.filter(F.size(column) == width).select(F.col(column).cast("array<double>").alias("x"))
    for _ in range(rounds):
        shared = kept.sparkSession.sparkContext.broadcast(books)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            total, count = np.zeros(own.entries.shape, np.int64), np.zeros(own.entries.shape[:2], np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    x = quantized(_matrix(batch.column(0).slice(at, BLOCK_ROWS)), own.entries.shape[0])
                    codes, _, _ = own.assign(x)
                    for part in range(x.shape[1]):
                        np.add.at(total[part], codes[:, part], x[:, part])
                        count[part] += np.bincount(codes[:, part], minlength=count.shape[1])
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(total[part, entry].tolist(), pa.list_(pa.int64())), pa.array(count[part, entry], pa.int64())], ["part", "entry", "total", "n"])
            trim_memory()

        seen = rows.mapInArrow(sums, "part int, entry int, total array<bigint>, n bigint").select("part", "entry", "n", F.posexplode("total").alias("place", "total"))
        fresh = books.entries.copy()
        # one row per component of an entry, whatever the number of vectors; decimals, as sums over many vectors leave 64 bits
        for r in seen.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
            fresh[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = Codebooks(fresh, width)
    return books


def encode(kept: DataFrame, books: Codebooks | None, column: str = "embedding") -> DataFrame:
    """vec_id, label, code (binary, one byte a part), error and n_exact (exact distances needed) of every kept vector of the books' width."""
    shape = "vec_id long, label string, code binary, error long, n_exact long"
    spark = kept.sparkSession
    if books is None:
        return spark.createDataFrame([], shape)
    shared = spark.sparkContext.broadcast(books)

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                codes, error, exact = own.assign(quantized(_matrix(some.column(2)), own.entries.shape[0]))
                code = pa.array([r.tobytes() for r in codes], pa.binary())
                share = np.full(len(codes), exact // max(1, len(codes)), np.int64)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), code, pa.array(error, pa.int64()), pa.array(share, pa.int64())], ["vec_id", "label", "code", "error", "n_exact"])
        trim_memory()

    rows = kept.filter(F.size(column) == books.width)
    return rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col(column).cast("array<double>")).mapInArrow(codes_of, shape)


def hex_code(code: str = "code") -> Column:
    return F.lower(F.hex(code))


def with_label_errors(encoded: DataFrame) -> DataFrame:
    """encoded with label_error, the errors of all rows of the same label.  Sums are made before the shuffle, and go to the rows: by
    broadcast, or by a join that splits hot labels."""
    rows = staged(encoded.select("*", F.coalesce("label", F.lit("")).alias("_l"), F.col("label").isNull().alias("_n")), "codes")
    sums = staged(rows.groupBy("_l", "_n").agg(F.sum("error").alias("label_error"), F.count("*").alias("_k")), "labels")
    if sums.count() <= BROADCAST_LABELS:
        out = rows.join(F.broadcast(sums.drop("_k")), ["_l", "_n"])
    else:
        out = spread_join(rows, sums, ["_l", "_n"], rows.count(), "_k")
    return out.drop("_l", "_n")


def compressed_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, code (binary), error, n_exact, label_error and codebooks_sha256 of every kept vector, with the fixed parameters."""
    kept = kept_vectors(vectors)
    books = fit(kept)
    return with_label_errors(encode(kept, books)).withColumn("codebooks_sha256", F.lit(books.sha256 if books else None).cast("string"))
