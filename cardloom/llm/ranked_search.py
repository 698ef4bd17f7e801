"""Ranked lexical search (operator 11): Fagin's threshold algorithm over impact-sorted lists, with a forward index for random access.

One pass over the texts writes the forward index: of each document its number of terms, and the numbers and frequencies of those terms
that the items ask for.  Document frequencies, N and L are sums over it.  A second pass reads the index in blocks of documents: each block
gets a list per term, sorted by falling impact (the score that one occurrence of the term in an item adds), and each item reads its
lists round-robin, a slice of each in turn.  Documents met for the first time are scored in full from the forward index.  The sum of the
impacts at which the lists have arrived bounds the score of every document not yet met, and an item is done with a block once that
threshold is strictly below its kth score so far, so that no document of equal score is missed.  The k best of an item go from block to
block of a task; those of the tasks meet in two steps, so that no task gets more than a bounded number of rows per item at first.

Items are searched in blocks of about BLOCK_CHARS characters, each against all documents.

Defined results.  A text without a term (null, empty) is no document, an item without one has no rows.  Repeated rows and repeated
doc_ids are documents of their own; of equal scores the smaller doc_id comes first, null doc_ids last.  Repeated rows of the items
are items of their own, with the same results.  No documents, or no items: no rows.  Long texts are counted whole, in slices.
Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import staged, trim_memory, with_small_batches

#: Fixed values of the contract.
LENGTH_WEIGHT, SATURATION, UNIT = 25, 12, 1_000_000_000
#: Best documents of an item.
BEST = 20
#: Characters of the items of a block, about; their terms are what a task holds in memory.
BLOCK_CHARS = 4_000_000
#: What an item counts for besides its characters.
ROW_CHARS = 100
#: Entries (documents x terms) of a block of the index.
BLOCK_ENTRIES = 2_000_000
#: Bytes of text whose terms are counted at once.
SLICE_BYTES = 4_000_000
#: Entries of a list that are read in the first turn; later turns read twice as many as the one before.
FIRST_SLICE = 32
#: Tasks whose best documents meet in the first step.
MEETING_TASKS = 256

#: Bytes of terms as they are, A-Z in lower case, and all others as spaces; bytes of UTF-8 beyond ASCII belong to terms.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs in a text."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    if len(raw) <= SLICE_BYTES:
        return Counter(raw.split())
    out: Counter[bytes] = Counter()
    at = 0
    while at < len(raw):
        stop = raw.find(b" ", at + SLICE_BYTES)
        stop = len(raw) if stop < 0 else stop
        out.update(raw[at:stop].split())
        at = stop
    return out


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """(item_id, text) of the items in blocks of about BLOCK_CHARS characters."""
    own = items.filter("text <> ''").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = own.agg(F.coalesce(F.sum(F.length("text") + ROW_CHARS), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    if blocks == 1:
        yield own.collect()
        return
    dealt = staged(own.select("item_id", "text", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block")), "items")
    for block in range(blocks):
        yield dealt.filter(F.col("block") == block).select("item_id", "text").collect()


def forward_index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers) and counts of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, totals, terms, counts, cuts = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                met = term_counts(text.as_py())
                if met:
                    ids.append(doc)
                    totals.append(met.total())
                    for word in met.keys() & known.keys():
                        terms.append(known[word])
                        counts.append(met[word])
                    cuts.append(len(terms))
            if ids:
                at = pa.array(cuts, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (terms, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(totals, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])
        trim_memory()

    return with_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, n long, terms array<int>, counts array<int>")


def term_weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Integer weights of terms by the number of documents that hold them (0 for none)."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) if df else 0 for df in frequencies], np.int64)


def impacts(counts: np.ndarray, lengths: np.ndarray, weights: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What one occurrence in an item adds: of entries with counts, lengths of their documents and weights of their terms."""
    if len(lengths) and LENGTH_WEIGHT * int(lengths.max()) * documents >= 1 << 63:
        share = np.array([LENGTH_WEIGHT * int(n) * documents // terms for n in lengths], np.int64)
    else:
        share = LENGTH_WEIGHT * lengths * documents // terms
    m = 100 - LENGTH_WEIGHT + share
    return weights * (UNIT * counts // (1000 * counts + SATURATION * m))


class Block:
    """Impact-sorted lists and forward index of some documents."""

    def __init__(self, doc: np.ndarray, cuts: np.ndarray, terms: np.ndarray, impact: np.ndarray) -> None:
        """doc: ids.  Entries cuts[i]:cuts[i + 1] of terms and impact are those of the ith document."""
        self.doc, self.cuts, self.terms, self.impact = doc, cuts, terms, impact
        owner = np.repeat(np.arange(len(doc), dtype=np.int32), np.diff(cuts))
        order = np.lexsort((-impact, terms))
        self.list_doc, self.list_impact = owner[order], impact[order]
        self.met, begin = np.unique(terms[order], return_index=True)
        self.begin = np.append(begin, len(order))

    def lists(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of terms begin and end."""
        if not len(self.met):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.met, wanted), len(self.met) - 1)
        there = self.met[at] == wanted
        return np.where(there, self.begin[at], 0), np.where(there, self.begin[at + 1], 0)

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Random access: full scores of documents, by how often an item asks for each term."""
        size = self.cuts[docs + 1] - self.cuts[docs]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.cuts[docs] - (ends - size), size)
        sums = np.concatenate([[0], np.cumsum(asked[self.terms[at]] * self.impact[at])])
        return sums[ends] - sums[ends - size]

    def search(self, terms: np.ndarray, times: np.ndarray, asked: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents (places) that may be among the k best of an item and their scores, and how many entries were read.  floor: the kth
        score so far; documents below it may be left out."""
        at, stop = self.lists(terms)
        at, stop, times = at[at < stop].copy(), stop[at < stop], times[at < stop]
        seen = np.zeros(len(self.doc), bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        width, read = FIRST_SLICE, 0
        while len(at):
            ends = np.minimum(at + width, stop)
            some = np.unique(np.concatenate([self.list_doc[a:b] for a, b in zip(at.tolist(), ends.tolist())]))
            read += int((ends - at).sum())
            some = some[~seen[some]].astype(np.int64)
            seen[some] = True
            places, scores = np.concatenate([places, some]), np.concatenate([scores, self.scores(some, asked)])
            if len(scores) >= k:
                floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                keep = scores >= floor
                places, scores = places[keep], scores[keep]
            going = ends < stop
            at, stop, times = ends[going], stop[going], times[going]
            threshold = int((times * self.list_impact[at]).sum())  # no document that was not met has more
            if threshold < floor or not threshold:
                break
            width *= 2
        keep = (scores >= floor) & (scores > 0)
        return places[keep], scores[keep], read


def _blocks(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, terms: int) -> Iterator[Block]:
    """The documents of a task in blocks."""
    held: list[pa.RecordBatch] = []

    def made() -> Block:
        whole = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        ids, n, own, counts = (c.combine_chunks() for c in whole.columns)
        numbers = own.flatten().to_numpy()
        size = own.value_lengths().to_numpy().astype(np.int64)
        doc = np.ma.masked_array(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        impact = impacts(counts.flatten().to_numpy().astype(np.int64), np.repeat(n.to_numpy(), size), weights[numbers], documents, terms)
        return Block(doc, np.concatenate([[0], np.cumsum(size)]), numbers, impact)

    entries = 0
    for batch in batches:
        held.append(batch)
        entries += len(batch.column(2).flatten()) + batch.num_rows
        if entries >= BLOCK_ENTRIES:
            yield made()
            entries = 0
    if held:
        yield made()


def _best(docs: np.ma.MaskedArray, scores: np.ndarray, k: int) -> tuple[np.ma.MaskedArray, np.ndarray]:
    order = np.lexsort((docs.data, np.ma.getmaskarray(docs), -scores))[:k]
    return docs[order], scores[order]


def search_items(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score and n_read (entries of lists that the task of this document read for the item) of the k best
    documents of each item."""
    spark = docs.sparkSession
    shape = "item long, item_id long, doc_id long, score long, n_read long"
    out = None
    for number, own in enumerate(_item_blocks(items)):
        asked = [(r["item_id"], term_counts(r["text"])) for r in own]
        numbers = {word: n for n, word in enumerate(sorted({w for _, met in asked for w in met}))}
        if not numbers:
            continue
        wanted = [(number << 32 | i, item, np.array([numbers[w] for w in met], np.int64), np.array(list(met.values()), np.int64)) for i, (item, met) in enumerate(asked) if met]
        index = staged(forward_index(docs, numbers), "forward-index")
        total = index.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        found = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term of the items
        frequencies = np.zeros(len(numbers), np.int64)
        for r in found:
            frequencies[r["term"]] = r["count"]
        shared = spark.sparkContext.broadcast((wanted, term_weights(frequencies, total["documents"]), total["documents"], total["terms"]))

        def rank(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            wanted, weights, documents, terms = shared.value
            best: dict[int, tuple[np.ma.MaskedArray, np.ndarray]] = {}
            read = dict.fromkeys((x[0] for x in wanted), 0)
            scratch = np.zeros(len(weights), np.int64)
            for block in _blocks(batches, weights, documents, terms):
                for item, _, own, times in wanted:
                    scratch[own] = times
                    held = best.get(item)
                    floor = int(held[1][-1]) if held is not None and len(held[1]) == k else 0
                    places, scores, some = block.search(own, times, scratch, k, floor)
                    scratch[own] = 0
                    read[item] += some
                    if len(places):
                        docs_ = block.doc[places]
                        if held is not None:
                            docs_, scores = np.ma.concatenate([held[0], docs_]), np.concatenate([held[1], scores])
                        best[item] = _best(docs_, scores, k)
                del block
                trim_memory()
            for item, item_id, *_ in wanted:
                if item in best:
                    docs_, scores = best[item]
                    many = len(scores)
                    ids = pa.array(docs_.data, pa.int64(), mask=np.ma.getmaskarray(docs_))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * many, pa.int64()), pa.array([item_id] * many, pa.int64()), ids, pa.array(scores, pa.int64()), pa.array([read[item]] * many, pa.int64())],
                        ["item", "item_id", "doc_id", "score", "n_read"],
                    )

        part = index.mapInArrow(rank, shape)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], shape)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    met = out.withColumn("meeting", F.floor(F.spark_partition_id() / MEETING_TASKS))
    first = met.withColumn("rank", F.row_number().over(Window.partitionBy("item", "meeting").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score", "n_read")
