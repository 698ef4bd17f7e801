"""The corpus pipeline: language ID, quality rules, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as Parquet in the shared folder
and hands the next one what it reads back.  All but the last return the columns of documents, with the rows the stage keeps.

A stage rejects doc_ids, and drops their rows without shuffling the texts while the rejected ids are few (a checked count).

Each stage works on all that the one before kept.  Empty, null and very long texts, ties, repeated rows, empty tables and further
columns have in each stage the result that its operator's module defines; clashing columns are dropped, as only those of documents
are read.

Defined results.  Repeated doc_ids: a doc_id is rejected if all its rows are; of rows with one doc_id and one text the duplicate
stage keeps one.  Rows without a doc_id cannot be named by a verdict and stay.  Empty tables: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import staged, table
from cardloom.llm.decontaminate import contaminated
from cardloom.llm.language_id import UNKNOWN, fit, predict
from cardloom.llm.ngram_join import ngram_components
from cardloom.llm.packing import pack_documents
from cardloom.llm.quality_rules import quality_verdicts
from cardloom.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text is rejected if no language has at least this share of its posterior label mass.
LEAST_SCORE = 0.5


#: Rejected doc_ids (8 bytes each) up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_IDS = 1_000_000


def _matched(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs with (left_semi) or without (left_anti) the rows whose doc_id is in ids, in the columns of documents."""
    ids = staged(ids.filter("doc_id is not null").select(F.col("doc_id").alias("_id")), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.select(*COLUMNS).join(ids, F.col("doc_id") == F.col("_id"), how)


def _drop(docs: DataFrame, verdicts: DataFrame, bad: Column) -> DataFrame:
    """docs without the doc_ids of which all verdicts are bad."""
    return _matched(docs, verdicts.groupBy("doc_id").agg(F.min(bad.cast("int")).alias("_bad")).filter("_bad = 1"), "left_anti")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters - null and empty ones among them - and those of which no language has the larger part.  The model
    learns from the labels of docs; without any, all texts are rejected."""
    model = fit(docs)
    return _drop(docs, predict(docs, model), (F.col("lang_pred") == UNKNOWN) | (F.col("score") < LEAST_SCORE))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what fails the base rules - null and empty texts among it - and outliers of its language and source."""
    return _drop(docs, quality_verdicts(docs), ~F.col("kept"))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component: the one with the smallest doc_id, once.  Empty texts are linked with nothing
    and stay; of rows that share doc_id and text one stays."""
    kept = _drop(docs, ngram_components(docs, 75), F.col("doc_id") != F.col("component_id"))
    twice = staged(docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    if twice.isEmpty():
        return kept
    return _matched(kept, twice, "left_anti").unionByName(_matched(kept, twice, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item within its error budget.  Items so short that they have none - a word or two,
    which say nothing about a leak - reject nothing."""
    return _matched(docs, contaminated(docs, table(spark, sf_dir, "benchmark")).filter("budget > 0").select("doc_id").distinct(), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens: a row per piece.  Null texts are packed as empty ones."""
    return pack_documents(docs, tokenizer_path(), 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Learned models, connected components and packing are beyond SQL; tests/llm/test_pipeline.py compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
