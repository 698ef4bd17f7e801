"""Search by postings: a table of three-character pieces beside the registry, so that a query reads the rows that may match and not all.

An index is a folder with three tables: `rows` (the registry with a row number, in slices by a hash of its source key, so that the rows of a part
lie together), `postings` (piece, slice, row; in buckets by a hash of the piece, sorted by it inside), and `pieces` (in how many
rows a piece occurs).  A query looks up the counts of its words' pieces, reads the postings of the RAREST of each word, and keeps
the rows that hold all of those; the literal check then decides, as in a scan, so the rows are the same whatever the pieces say.  Words
of under three characters have no pieces: they narrow nothing, and a query of such words alone scans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.operators.search import matches, query_words
from cardloom.schema import SEARCH_FIELDS, SOURCE_KEY

#: Characters of a piece, slices of rows and buckets of postings.
PIECE, SLICES, BUCKETS = 3, 64, 64
#: Pieces of a word that are looked up: its rarest.
RAREST = 4
#: Rows that may match up to which their numbers go to the rows by broadcast.
BROADCAST_ROWS = 1_000_000


def haystack(fields: tuple[str, ...]) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))


def pieces_of(text: Column) -> Column:
    """The different pieces of a text, but for those with a space, which no word has."""
    last = F.greatest(F.length(text) - PIECE + 1, F.lit(0))
    every = F.transform(F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")), lambda i: F.substr(text, i, F.lit(PIECE)))
    return F.array_distinct(F.filter(every, lambda p: ~F.contains(p, F.lit(" "))))


def bucket(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")


def build(registry: DataFrame, folder: str, fields: tuple[str, ...] = SEARCH_FIELDS, key: str = SOURCE_KEY) -> SearchIndex:
    """Write the index of a registry to a new folder."""
    spark = registry.sparkSession
    numbered = registry.withColumns({"_row": F.monotonically_increasing_id(), "_slice": F.pmod(F.xxhash64(key), F.lit(SLICES)).cast("int")})
    numbered.write.partitionBy("_slice").parquet(f"{folder}/rows")
    index = SearchIndex(spark, folder, registry.schema, tuple(fields))
    rows = index.table("rows")  # a row keeps the number it was written with
    held = rows.select("_row", "_slice", F.explode(pieces_of(haystack(fields))).alias("piece"))
    # sliced by the piece and the rows' slice: a piece of nearly all rows is not one task
    held.withColumn("bucket", bucket(F.col("piece"))).repartition("bucket", "_slice").sortWithinPartitions("bucket", "piece").write.partitionBy("bucket").parquet(f"{folder}/postings")
    index.table("postings").groupBy("bucket", "piece").agg(F.count("*").alias("n")).sortWithinPartitions("bucket", "piece").write.partitionBy("bucket").parquet(f"{folder}/pieces")
    return index


def _word_pieces(word: str) -> list[str]:
    return sorted({word[i : i + PIECE] for i in range(len(word) - PIECE + 1)})


@dataclass(frozen=True)
class SearchIndex:
    spark: SparkSession
    folder: str
    schema: T.StructType
    fields: tuple[str, ...] = SEARCH_FIELDS

    def table(self, name: str) -> DataFrame:
        own = {"postings": "_row long, _slice int, piece string, bucket int", "pieces": "piece string, n long, bucket int"}
        rows = T.StructType([*self.schema.fields, T.StructField("_row", T.LongType()), T.StructField("_slice", T.IntegerType())])
        return self.spark.read.schema(own.get(name, rows)).parquet(f"{self.folder}/{name}")

    def _of_pieces(self, name: str, pieces: list[str]) -> DataFrame:
        """Rows of postings or pieces: buckets are pruned by folder, row groups by the sorted piece."""
        table = self.table(name)
        buckets = [r[0] for r in self.spark.createDataFrame([(p,) for p in pieces], "p string").select(bucket(F.col("p"))).distinct().collect()]
        return table.filter(F.col("bucket").isin(buckets) & F.col("piece").isin(pieces))

    def candidates(self, query: str | None) -> DataFrame | None:
        """_slice, _row of the rows that hold the rarest pieces of all words of the query; None if no word has a piece."""
        words = {w: _word_pieces(w) for w in query_words(query) if len(w) >= PIECE}
        if not words:
            return None
        every = sorted({p for ps in words.values() for p in ps})
        counts = {r["piece"]: r["n"] for r in self._of_pieces("pieces", every).select("piece", "n").collect()}  # those of the query alone
        chosen = sorted({p for ps in words.values() for p in sorted(ps, key=lambda p: (counts.get(p, 0), p))[:RAREST]})
        held = self._of_pieces("postings", chosen).groupBy("_slice", "_row").agg(F.count("*").alias("k"))
        return held.filter(F.col("k") == len(chosen)).select("_slice", "_row")

    def search(self, query: str | None, filters: tuple[Column, ...] = ()) -> DataFrame:
        """The rows that a scan with the same query and filters finds.  Without a word and without a filter: none."""
        rows = self.table("rows")
        narrow = self.candidates(query)
        if narrow is None and not query_words(query) and not filters:
            rows = rows.limit(0)
        elif narrow is not None:
            small = narrow.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
            rows = rows.join(F.broadcast(narrow) if small else narrow, ["_slice", "_row"], "left_semi")  # slices without candidates are not read
        return rows.filter(reduce(lambda a, b: a & b, filters, matches(query, self.fields))).drop("_row", "_slice")

    def report(self, queries: list[str]) -> DataFrame:
        """query, candidates, found and total: how far the pieces narrow each of some queries.  candidates is null for a scan."""
        total = self.table("rows").count()
        out = []
        for q in queries:
            narrow = self.candidates(q)
            out.append((q, None if narrow is None else narrow.count(), self.search(q).count(), total))
        return self.spark.createDataFrame(out, "query string, candidates long, found long, total long")
