"""Per-document page bookkeeping: carried headers, metadata for pages read again, and which saved images are still needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carried_header(pages: DataFrame, doc: str, page: str, columns: list[str]) -> DataFrame:
    """Each column completed by its first known value in the document."""
    w = Window.partitionBy(doc).orderBy(page).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pages.withColumns({c: F.coalesce(F.col(c), F.first(c, ignorenulls=True).over(w)) for c in columns})


def metadata_for(wanted: DataFrame, records: DataFrame, doc: str, page: str, order: str, columns: list[str]) -> DataFrame:
    """wanted (doc, page) with metadata of the first record on that page, else of the document's first record."""
    meta = F.struct(*columns)
    own = records.groupBy(doc, page).agg(F.min_by(meta, order).alias("_own"))
    any_ = records.groupBy(doc).agg(F.min_by(meta, order).alias("_any"))
    out = wanted.join(own, [doc, page], "left").join(any_, doc, "left").withColumn("_meta", F.coalesce("_own", "_any"))
    return out.select(*wanted.columns, *[F.col("_meta")[c].alias(c) for c in columns])


def merged_page_types(old: Column, new: Column) -> Column:
    """Page classes of two readings; the newer one wins."""
    return F.map_zip_with(old, new, lambda k, a, b: F.coalesce(b, a))


def image_name(path: Column) -> Column:
    """struct<page, card> of an image named pageN_cardM or pageN; null for others."""
    file = F.element_at(F.split(path, "/"), -1)
    page = F.regexp_extract(file, r"page(\d+)", 1).try_cast("long")
    return F.when(page.isNotNull(), F.struct(page.alias("page"), F.regexp_extract(file, r"_card(\d+)", 1).try_cast("long").alias("card")))


def image_verdicts(images: DataFrame, records: DataFrame, doc: str = "doc") -> DataFrame:
    """images (doc, path) with keep: crops of invalid records, and pages that have one.  Nothing is deleted here."""
    bad = records.filter(~F.col("valid")).select(doc, "page", "card").distinct()
    pages = bad.select(doc, "page").distinct().withColumn("_page", F.lit(True))
    named = images.withColumn("_at", image_name(F.col("path"))).withColumns({"page": F.col("_at.page"), "card": F.col("_at.card")}).drop("_at")
    out = named.join(bad.withColumn("_crop", F.lit(True)), [doc, "page", "card"], "left").join(pages, [doc, "page"], "left")
    keep = F.when(F.col("card").isNull(), F.col("_page")).otherwise(F.col("_crop"))
    return out.select(*images.columns, F.coalesce(keep, F.lit(False)).alias("keep"))


def not_done(jobs: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """Jobs whose key the ledger doesn't have."""
    return jobs.join(ledger.select(*key).distinct(), key, "left_anti")
